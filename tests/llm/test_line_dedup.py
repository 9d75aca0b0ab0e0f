import random

import pytest
from pyspark.sql import functions as F

from quillstone.llm import common
from quillstone.llm.line_dedup import drop_lines
from tests.llm.cases import CLASH, docs

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_chars=10, least_docs=2):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = lambda k: len(holders.get(k, ())) >= least_docs and i != min(holders[k], key=order)
        kept = [x for x in lines if not gone(key(x))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [10**6, 0])
@pytest.mark.parametrize("least_docs", [2, 3])
def test_equals_brute_force(spark, monkeypatch, few, least_docs):
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    rng = random.Random(2)
    pool = ["a common line here", "A Common LINE here ", "\ta common line here\x0b", "ÄÖÜ is a line ä", "äöü is a line ä", "short", "", " ", "ninechars", "tencharsxx", "TENCHARSXX\r", "\U0001f600" * 10, "\U0001f600" * 9 + "x"]
    texts = [None, "", "\n", "\n\n", "a common line here\n\nsecond line of it"]
    texts += ["\n".join(rng.choice(pool) if rng.random() < 0.6 else f"line of its own {rng.randrange(40)}" for _ in range(rng.randint(0, 9))) for _ in range(120)]
    texts += ["\n".join(f"long text, line {k % 700}" for k in range(1500)), "\n".join(f"LONG text, line {k}" for k in range(600)), "x" * 200_000, "x" * 200_000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[7] = ids[8] = ids[9] = None
    ids[20], ids[21], texts[22], ids[22] = ids[30], ids[30], texts[23], ids[23]
    got = drop_lines(docs(spark, texts, ids, CLASH).repartition(4), least_docs=least_docs, broadcast_rows=few).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(list(zip(ids, texts)), least_docs=least_docs)


def test_a_line_in_a_third_of_all_rows(spark):
    texts = [f"a line in every third\nits own line {k}" if k % 3 == 0 else f"only its own line {k}" for k in range(900)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in drop_lines(docs(spark, texts)).collect()}
    assert got[0] == (texts[0], 0) and got[3] == ("its own line 3", 1) and got[4] == (texts[4], 0)
    assert sum(n for _, n in got.values()) == 299


def test_main_path_runs_no_python(spark):
    plan = drop_lines(docs(spark, ["a line that is long", "a line that is long"]).withColumn("text", F.concat("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_rows(spark):
    assert drop_lines(docs(spark, [])).count() == 0
