import random
from collections import Counter

import numpy as np
import pyarrow as pa

from quillstone.llm import common
from quillstone.llm.common import table
from quillstone.llm.minhash import REGISTERS, bags, near_duplicates, overlap, signatures
from quillstone.llm.textops import text_slices
from tests.llm.cases import CLASH, docs


def bag(t):
    w = (t or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


def brute(rows):
    group = {i: i for i, _ in rows}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    held = [(i, bag(t)) for i, t in rows]
    for k, (i, a) in enumerate(held):
        for j, b in held[:k]:
            if jaccard(a, b) >= 0.8:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {i: root(i) for i, _ in rows}


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 6))) for _ in range(400)]
    texts = [None, "", " \n", "one", "one", "One", "one two three", "one two three", "one two four"] + ["x"] * 3
    while len(texts) < n:
        t = rng.choices(vocabulary, k=rng.choice([6, 20, 60, 200]))
        if rng.random() < 0.6 and len(texts) > 20:
            t = texts[rng.randrange(12, len(texts))].split()
            for _ in range(rng.choice([0, 1, 2, 3])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            t = t + t[:10] * 3
        texts.append(" ".join(t))
    return texts


def test_signatures_estimate_the_weighted_jaccard(spark):
    rng = random.Random(4)
    w = [str(rng.randrange(10**6)) for _ in range(300)]
    one, two = " ".join(w + w[:60] * 3), " ".join(w[30:] + w[:60])
    _, _, data, offsets = next(text_slices(pa.array([one, two])))
    s = signatures(*bags(data, offsets), 2)
    want = jaccard(bag(one), bag(two))
    assert abs(np.mean(s[0] == s[1]) - want) < 4 * (want * (1 - want) / REGISTERS) ** 0.5
    assert np.isclose(overlap(pa.array([one]), pa.array([two]))[0], want)


def test_classes_equal_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        got = near_duplicates(docs(spark, texts, schema=CLASH)).collect()
        want = brute(list(enumerate(texts)))
        assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(texts)
        sizes = Counter(want.values())
        assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_a_third_of_the_rows_in_one_class(spark, monkeypatch):
    """The leader of that class has hundreds of pairs, which are dealt out."""
    monkeypatch.setattr(common, "SPREAD_ROWS", 16)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:k] + [f"x{n}"] + base[k + 1 :]) for n in range(200) for k in [rng.choice([0, 1, 58, 59])]]
    texts += [" ".join(rng.choices([f"v{k}" for k in range(900)], k=50)) for _ in range(400)]
    classes = {r.doc_id: r.class_id for r in near_duplicates(docs(spark, texts)).collect()}
    assert classes == brute(list(enumerate(texts)))
    assert sum(c == 0 for c in classes.values()) == 200


def test_recall_of_similar_pairs(spark):
    """Queries: every row whose id is divisible by 50, against all rows; found: in the same class."""
    rows = [(r.doc_id, bag(r.text)) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    classes = {r.doc_id: r.class_id for r in near_duplicates(table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    at = {}
    for i, b in rows:
        for s in b:
            at.setdefault(s, set()).add(i)
    held = dict(rows)
    pairs = [(i, j) for i, b in rows if i % 50 == 0 for j in set().union(*(at[s] for s in b)) if i != j and jaccard(b, held[j]) >= 0.8]
    assert len(pairs) >= 3 and all(classes[i] == classes[j] for i, j in pairs)


def test_null_ids_repeated_rows_and_no_rows(spark):
    got = near_duplicates(docs(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None, ""], [7, 7, None, None, 3])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size, r.kept) for r in got) == [
        ("3", "3", 1, True), ("7", "7", 3, True), ("7", "7", 3, True), ("None", "7", 3, False), ("None", "None", 1, True)
    ]
    got = near_duplicates(docs(spark, [None, "", " ", "a b c", ""], [None, None, None, None, 4])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size, r.kept) for r in got) == [("4", "4", 1, True)] + [("None", "None", 1, True)] * 4
    assert near_duplicates(docs(spark, [])).count() == 0
