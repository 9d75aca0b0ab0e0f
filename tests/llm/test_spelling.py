import random
import re
import zlib
from collections import Counter

import pytest

from quillstone.llm import common, spelling
from quillstone.llm.spelling import count_words, group_spellings
from tests.llm.cases import CLASH, docs

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, slip):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slip and h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts):
    form, out = {}, []
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = (best if best and counts[best] >= 2 * n else None, len(others))
    for w, n in counts.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        out.append((w, form[w][0], root, n, form[w][1], counts.get(form[w][0])))
    return sorted(out)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()))


@pytest.mark.parametrize("few", [10**6, 0])
def test_documents_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    rng = random.Random(9)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(25)] + ["Straße", "straÞe", "thorn×thorn", "wordword", "ﬂuent"]
    texts = [" ".join(rng.choice(base) + rng.choice(["", ",", "1", "\n"]) for _ in range(40)) for _ in range(60)] + [None, "", "1234", "tiny", "WordWord wordword WORDWORD"]
    ids = [*range(len(texts) - 2), None, None]
    for slip in (None, 3):
        counts = plain_counts(list(zip(ids, texts)), slip)
        words = count_words(docs(spark, texts, ids, CLASH).repartition(3), slip=slip)
        assert dict(map(tuple, words.collect())) == counts
        assert rows(group_spellings(words, broadcast_rows=few)) == brute(counts)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aÿ"])
def test_dense_words_equal_brute_force(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(250)} | {"a" * k for k in range(1, 9)}
    counts = {w: rng.choice([3, 4, 8, 9, 40, 90]) for w in words}
    got = group_spellings(spark.createDataFrame(list(counts.items()), "word string, n int").repartition(5))
    assert rows(got) == brute(counts)


def test_long_chains_of_forms(spark):
    counts = {"a" * (5 + k): 2**k * 3 for k in range(20)}
    assert rows(group_spellings(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_very_long_words(spark):
    long = "xy" * 60_000
    counts = {long: 9, long[:70_000] + "z" + long[70_000:]: 3, long[:-1] + "q": 4, "xyxyx": 3}
    got = rows(group_spellings(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert {r[0]: (r[1], r[4]) for r in got} == {long: (None, 2), long[:70_000] + "z" + long[70_000:]: (long, 1), long[:-1] + "q": (long, 1), "xyxyx": (None, 0)}


def test_a_word_of_a_third_of_all_rows(spark):
    texts = ["common common common"] * 50 + [f"single{chr(97 + k % 26)} commom" for k in range(100)]
    counts = plain_counts(list(enumerate(texts)), None)
    assert rows(group_spellings(count_words(docs(spark, texts)))) == brute(counts)


def test_light_steps_are_few(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcdef", k=8)) for _ in range(500)})
    frame = spark.createDataFrame([(k, w, 3) for k, w in enumerate(words)], "id long, word string, n long")
    steps = frame.select("id", "word").mapInArrow(spelling._steps, "id long, d int, node long, step int").collect()
    fans = {}
    for r in steps:
        fans.setdefault(r.node, Counter())[r.step] += 1
    light = Counter(r.id for r in steps if len(fans[r.node]) > 1 and (fans[r.node][r.step], r.step) != max((n, s) for s, n in fans[r.node].items()))
    assert max(light.values()) <= 9  # log2(500)


def test_no_rows(spark):
    assert group_spellings(count_words(docs(spark, []))).count() == 0
