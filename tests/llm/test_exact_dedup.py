import hashlib
import random
import re

from quillstone.llm.exact_dedup import exact_dedup
from tests.llm.cases import CLASH, docs


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "\t\n", " ", "a  b", "a\nb", "a b", "A b", "x" * 100_000, "x" * 100_000 + " "]
    texts += ["".join(rng.choices("ab \n\x0b\x0c\r", k=rng.randint(0, 5))) for _ in range(300)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3] = ids[5] = None
    ids[20], texts[20] = ids[21], texts[21]
    for bound in (10**6, 3):
        got = exact_dedup(docs(spark, texts, ids, CLASH).repartition(5), bound).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(list(zip(ids, texts)))


def test_no_rows(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
