import random
from itertools import combinations

import numpy as np

from quillstone.llm import decontamination
from quillstone.llm.decontamination import MASKS, SHORT_MASKS, SHORT_SUBSTITUTED, SPAN, SUBSTITUTED, WINDOW, contaminated
from tests.llm.cases import CLASH, docs


def test_masks_find_every_window_within_the_tolerance():
    for wrong in combinations(range(WINDOW), SUBSTITUTED):
        assert any(
            all(o + k not in wrong for k, bit in enumerate(m) if bit == "1") for m in MASKS for o in range(WINDOW - SPAN + 1)
        )


def test_short_masks_find_every_item_with_one_token_replaced():
    assert SHORT_SUBSTITUTED == 1
    for length in range(SPAN, WINDOW):
        for wrong in range(length):
            assert any(all(k != wrong for k, bit in enumerate(m) if bit == "1") for m in SHORT_MASKS)


def test_short_items(spark):
    w = [f"w{k}" for k in range(12)]
    bench = spark.createDataFrame([(n, " ".join(w[:n])) for n in (1, 2, 6, 7, 8, 10, 12)], "item_id long, text string")
    swapped = lambda n, *at: " ".join("x" if k in at else t for k, t in enumerate(w[:n]))
    texts = ["a " + " ".join(w[:6]) + " b", swapped(10, 4), swapped(10, 0, 9), swapped(8, 7), swapped(12, 0), swapped(6, 3), "w0w1 W0 ", ""]
    got = sorted((r.doc_id, r.item_id, r.matched) for r in contaminated(docs(spark, texts), bench).collect())
    assert [x[:2] for x in got] == sorted(brute(enumerate(texts), [(n, " ".join(w[:n])) for n in (1, 2, 6, 7, 8, 10, 12)]))
    assert {(0, 6, 6), (1, 10, 9), (3, 8, 7), (4, 12, 11), (6, 1, 1)} <= set(got) and not any(i == 2 and j == 10 for i, j, _ in got)


def brute(texts, items):
    """All windows of all alignments, a matrix of equal tokens for each document and item."""
    number, out = {}, set()
    coded = lambda t: np.array([number.setdefault(w, len(number)) for w in (t or "").lower().split()], np.int32)
    held = [(j, coded(u)) for j, u in items]
    for i, t in texts:
        d = coded(t)
        for j, b in held:
            w = min(WINDOW, len(b))
            if not w or len(d) < w:
                continue
            same = (d[:, None] == b[None, :]).astype(np.int8)
            rows, columns = len(d) - w + 1, len(b) - w + 1
            if sum(same[k : k + rows, k : k + columns] for k in range(w)).max() >= w - (SUBSTITUTED if w == WINDOW else SHORT_SUBSTITUTED if w >= SPAN else 0):
                out.add((i, j))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["the", "of", "and"] + ["".join(rng.choices("abcdeé", k=4)) for _ in range(60)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    items = [(k, " ".join(prose(rng.choice([1, 2, 5, 8, 10, 13, 20, 40])))) for k in range(25)] + [(90, None), (91, ""), (92, "the " * 30)]
    texts = [None, "", "the", "the " * 40]
    for _ in range(150):
        t = prose(rng.randint(0, 60))
        if rng.random() < 0.7:
            u = items[rng.randrange(25)][1].split()
            a = rng.randrange(len(u))
            u = u[a:] if rng.random() < 0.3 else u
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                u[rng.randrange(len(u))] = rng.choice(vocabulary)
            t = t + u + prose(rng.randint(0, 20))
        texts.append((" " if rng.random() < 0.9 else "\n ").join(t).title())
    frame = docs(spark, texts, schema=CLASH)
    bench = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, pos string")
    want = brute(enumerate(texts), items)
    for bound in (10**6, 0):
        got = contaminated(frame, bench, bound).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 30


def test_a_vocabulary_that_fills_the_screen_and_texts_of_many_blocks(spark, monkeypatch):
    """More than 20,000 benchmark tokens, with a screen that passes almost all and with one that passes few."""
    rng = random.Random(12)
    items = [(k, " ".join(f"t{rng.randrange(10**6)}" for _ in range(rng.choice([13, 30, 400])))) for k in range(180)]
    assert len({w for _, t in items for w in t.split()}) > 20_000
    texts = []
    for _ in range(5):
        t = []
        for _ in range(6):
            u = items[rng.randrange(180)][1].split()
            a = rng.randrange(len(u))
            t += [f"w{rng.randrange(9)}" for _ in range(rng.randrange(500))] + u[a : a + rng.choice([9, 13, 200])]
        texts.append(" ".join(t))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(enumerate(texts), items)
    for bits in (22, 10):
        monkeypatch.setattr(decontamination, "SCREEN_BITS", bits)
        got = contaminated(docs(spark, texts), bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 10


def test_a_long_text_of_one_word(spark):
    bench = spark.createDataFrame([(1, "the " * 30), (2, "the " * 12 + "end")], "item_id long, text string")
    got = contaminated(docs(spark, ["the " * 20_000, "the " * 11]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.window_matches, r.matched) for r in got) == [(0, 1, 13, 30), (0, 2, 12, 12)]


def test_null_ids_repeats_and_no_rows(spark):
    item = " ".join(f"w{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    got = contaminated(docs(spark, [item, item, item, "clean"], [3, 3, None, 4]), bench).collect()
    assert sorted(map(str, ((r.doc_id, r.item_id, r.matched) for r in got))) == sorted(map(str, [(3, 1, 20), (3, None, 20), (None, 1, 20), (None, None, 20)]))
    assert contaminated(docs(spark, []), bench).count() == 0
    assert contaminated(docs(spark, [item]), bench.limit(0)).count() == 0
