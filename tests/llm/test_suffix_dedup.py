import hashlib
import random

import numpy as np

from quillstone.llm import suffix_dedup
from quillstone.llm.suffix_dedup import MATCH, remove_repeats
from tests.llm.cases import CLASH, docs


def brute(rows):
    """(doc_id, text) in order of id: every window of MATCH bytes that starts earlier too."""
    seen, out = set(), []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - MATCH + 1):
            w = raw[s : s + MATCH]
            if w in seen:
                gone[s : s + MATCH] = b"\1" * MATCH
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(rng.randint(8, 60)) for _ in range(6)]
    texts = [None, "", " ", "a" * 99, "a" * 100, "a" * 101, "ab" * 400, "xyz" * 50, passages[0][:150]]
    while len(texts) < n:
        parts = [rng.choice(passages) if rng.random() < 0.4 else prose(rng.randint(1, 60)) for _ in range(rng.randint(1, 4))]
        t = rng.choice([" ", ""]).join(parts)
        if rng.random() < 0.3 and texts[-1]:
            t = texts[rng.randrange(9, len(texts))] if len(texts) > 9 else t
            k = rng.randrange(len(t) + 1)
            t = t[:k] + rng.choice(["", "!", "zz"]) + t[k:]
        texts.append(t)
    return texts


def check(got, rows):
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str)
    want = brute(rows)
    assert [g for g, w in zip(got, want) if g != w] == [] and len(got) == len(want)


def test_equals_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        ids = list(range(len(texts)))
        random.Random(seed).shuffle(ids)
        check(remove_repeats(docs(spark, texts, ids, CLASH).repartition(5)), sorted(zip(ids, texts)))


def test_large_groups_go_window_by_window(spark):
    texts = corpus(3)
    check(remove_repeats(docs(spark, texts), group_rows=3), list(enumerate(texts)))


def test_long_text_in_overlapping_parts(spark, monkeypatch):
    rng = random.Random(5)
    t = "".join(rng.choice("abcdefgh") for _ in range(5000))
    for size in (700, 1000):
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", size)
        import pyarrow as pa

        whole = t + t[100:900] + t
        parts = set()
        real = suffix_dedup.text_slices
        monkeypatch.setattr(suffix_dedup, "text_slices", lambda c, most=size: real(c, most))
        for b in suffix_dedup._anchors(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([whole])], names=list("abc"))])):
            parts |= {p for p, s in zip(b.column("pos").to_pylist(), b.column("kind").to_pylist())}
        monkeypatch.setattr(suffix_dedup, "text_slices", real)
        data = np.frombuffer(whole.encode(), np.uint8)
        assert parts == set(suffix_dedup.find_anchors(data, np.array([0, len(data)]))[1].tolist())


def test_multikey_quicksort_is_a_stable_sort(monkeypatch):
    rng = np.random.default_rng(3)
    for segment in (1, 4, 2048):
        monkeypatch.setattr(suffix_dedup, "SEGMENT_ROWS", segment)
        for n in (0, 1, 2, 50, 3000):
            rows = rng.integers(0, 3, (n, 20), dtype=np.uint8)
            rows[: n // 2, :17] = 1
            want = sorted(range(n), key=lambda i: bytes(rows[i]))
            assert suffix_dedup.multikey_quicksort(suffix_dedup._words(rows)).tolist() == want


def test_a_passage_in_a_third_of_the_rows(spark, monkeypatch):
    rng = random.Random(21)
    noise = lambda k: "".join(rng.choices("abcdefghij ", k=k))
    passage = noise(400)
    texts = [noise(rng.randint(0, 300)) + (passage[rng.randint(0, 90) :] if k % 3 == 0 else "") + noise(rng.randint(0, 200)) for k in range(90)]
    for rows, block in ((50_000, 20_000), (10, 20)):
        monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", block)
        check(remove_repeats(docs(spark, texts).repartition(6), rows), list(enumerate(texts)))


def test_an_id_with_different_texts(spark):
    rng = random.Random(2)
    a, b = ("".join(rng.choices("abcdefgh", k=300)) for _ in range(2))
    got = remove_repeats(docs(spark, [a, b, a[:200], b], [1, 1, 0, 1])).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in got) == sorted([(0, 0, sha(a[:200])), (1, 200, sha(a[200:])), (1, 0, sha(b)), (1, 0, sha(b))])


def test_repeated_rows_null_ids_and_no_rows(spark):
    t = "".join(random.Random(9).choices("abcdefgh", k=300))
    got = remove_repeats(docs(spark, [t, t, t, t + "q"], [4, 4, None, None])).collect()
    by = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed) for r in got)
    assert by == [(False, 4, 300, 0), (False, 4, 300, 0), (True, None, 300, 300), (True, None, 301, 300)]
    assert remove_repeats(docs(spark, [])).count() == 0
