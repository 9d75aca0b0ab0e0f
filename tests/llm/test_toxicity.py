import numpy as np

from quillstone.llm.common import table
from quillstone.llm.labelled import load, training_rows
from quillstone.llm.toxicity import STRIDE, WINDOW, Network, fit_toxicity, lanes, score_toxicity, windows_of
from quillstone.llm.textops import word_spans
from tests.llm.cases import CLASH, docs


def test_gradients_equal_differences():
    net = Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data = np.frombuffer(b"one two idiot three four five six", np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    words, index, mask = lanes(data, starts, ends, np.array([0, 2]), np.array([5, 4]))
    weight, cache = np.array([1.0, 0.5]), {}
    net.forward(words, index, mask, cache)
    for k, g in net.gradients(words, index, cache, weight).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        value, sides = net.p[k][at], []
        for step in (1e-3, -1e-3):
            net.p[k][at] = value + step
            sides.append((net.forward(words, index, mask) * weight).sum())
        net.p[k][at] = value
        assert np.isclose((sides[0] - sides[1]) / 2e-3, g[at], rtol=1e-3, atol=1e-6), k


def test_windows_overlap_and_cover_every_word():
    rows = np.repeat([0, 2, 3], [1, 200, WINDOW])
    first, size, row = windows_of(rows, 5)
    for r, start, n in ((0, 0, 1), (2, 1, 200), (3, 201, WINDOW)):
        mine = [(f, f + s) for f, s, w in zip(first, size, row) if w == r]
        assert mine[0][0] == start and mine[-1][1] == start + n
        assert all(b[0] - a[0] == STRIDE and b[0] < a[1] for a, b in zip(mine, mine[1:]))
    assert not set(row.tolist()) & {1, 4}


def auc(scores, labels):
    rank = np.argsort(np.argsort(scores)) + 1
    n = labels.sum()
    return (rank[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_held_out_ranking_and_recall(spark, tmp_path):
    """A model that flags nothing has recall 0 and an AUC of 0.5; the labels hold noise, so that neither can be 1."""
    full = "/root/testdata/sf0.1"
    labels, frame = table(spark, full, "labels"), table(spark, full, "documents")
    model = fit_toxicity(frame, labels, path=f"{tmp_path}/model")
    assert all((x == y).all() for x, y in zip(model.values(), load(spark, f"{tmp_path}/model").values()))
    chosen = frame.join(labels, "doc_id", "left_semi")
    scored = score_toxicity(chosen, None, model=model).join(labels, "doc_id").collect()
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in scored)
    tested = [r for r in scored if r.held_out]
    y, p, s = (np.array([r[k] for r in tested]) for k in ("toxic", "predicted", "score"))
    assert auc(s, y) > 0.9
    assert (p & y).sum() / y.sum() > 0.6 and (p & (1 - y)).sum() / (1 - y).sum() < 0.05


def test_every_window_is_scored_and_the_worst_counts(spark):
    net, rng = Network(2), np.random.default_rng(4)
    vocabulary = ["idiot", "é", "x" * 30, "the", "of", "a-b"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 5, WINDOW, WINDOW + 1, 3 * WINDOW, 1_000)]
    got = score_toxicity(docs(spark, texts), None, model=net.p).collect()
    for r in got:
        words = texts[r.doc_id].split()
        worst = -np.inf
        for at in range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE):  # one window at a time
            data = np.frombuffer(" ".join(words[at : at + WINDOW]).encode(), np.uint8)
            starts, ends, _ = word_spans(data, np.array([0, len(data)]))
            worst = max(worst, net.forward(*lanes(data, starts, ends, np.array([0]), np.array([len(starts)])))[0])
        assert np.isclose(r.score, 1 / (1 + np.exp(-worst)), rtol=1e-4)


def test_repeated_ids_train_on_the_same_text_in_any_order(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    rows = docs(spark, ["bad", "good", "fine"], [1, 1, 3])
    one, two = (training_rows(x, labels, "toxic", 9, 99).collect() for x in (rows, rows.orderBy("text").repartition(3)))
    assert sorted(one) == sorted(two) and len(one) == len({r.labelled_id for r in one})


def test_nulls_empty_texts_repeats_and_no_rows(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    frame = docs(spark, ["a b", "c", None, "", "x " * 5000, "a b"], [1, 2, 3, None, 4, 1], CLASH)
    rows = score_toxicity(frame, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (None, 3)} == {0.0}
    assert score_toxicity(docs(spark, []), labels).count() == 0
