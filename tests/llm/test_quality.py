import zlib

import numpy as np

from quillstone.llm.common import table
from quillstone.llm import quality
from quillstone.llm.labelled import training_rows
from quillstone.llm.quality import calibration, features, score_quality, train
from tests.llm.cases import CLASH, docs

SF = "/root/testdata/sf0.01"


def test_shapes_ignore_letters_but_not_case_or_marks():
    def grams(t):
        data = np.frombuffer(t.encode(), np.uint8)
        return set(features(data, np.array([0, len(data)]))[1].tolist())

    assert len(grams("Then") ^ grams("This")) == 2  # the words themselves
    assert len(grams("THE!!") & grams("the")) == 0


def test_order_of_words_counts():
    def grams(t):
        data = np.frombuffer(t.encode(), np.uint8)
        return set(features(data, np.array([0, len(data)]))[1].tolist())

    # the same words and shapes, and no repeats: four pairs and three triples of words have changed
    one, other = grams("red fox dog cat"), grams("cat dog fox red")
    assert len(one - other) == 5 and len(other - one) == 5


def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    scored = score_quality(table(spark, SF, "documents"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    tested = [r for r in scored if r.held_out]
    assert np.mean([r.predicted == r.quality for r in tested]) > 0.96
    assert np.mean([r.predicted == 0 for r in tested if r.quality == 0]) > 0.7
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in scored)


def plain(rows):
    """FTRL-proximal and the dot product, a coordinate at a time."""
    z, n = {}, {}
    grams = lambda t: [(int(i), np.float32(v)) for i, v in zip(*features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[1:])] + [("bias", np.float32(0.3))]

    def weight(i):
        a = z.get(i, 0.0)
        return 0.0 if abs(a) <= quality.L1 else -(a - np.sign(a) * quality.L1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    dot = lambda t: sum(weight(i) * float(v) for i, v in grams(t))
    trained = np.array([k for k in range(len(rows)) if k % quality.SLICE != quality.SLICE - 1])
    rng = np.random.default_rng(11)
    for _ in range(quality.EPOCHS):
        for k in rng.permutation(trained):
            text, label = rows[k]
            error = 1 / (1 + np.exp(-dot(text))) - label
            for i, v, w in [(i, float(v), weight(i)) for i, v in grams(text)]:
                g = error * v
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / quality.ALPHA * w
                n[i] = n.get(i, 0.0) + g * g
    kept = [k for k in range(len(rows)) if k % quality.SLICE == quality.SLICE - 1]
    slope, shift = calibration(np.array([dot(rows[k][0]) for k in kept]), np.array([rows[k][1] for k in kept]))
    return lambda t: 1 / (1 + np.exp(-(slope * dot(t) + shift)))


def test_weights_and_scores_equal_a_plain_version(spark):
    frame, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = [(r.text, r.label) for r in training_rows(frame, labels, "quality", 30, 4000).orderBy("labelled_id").collect()]
    score = plain(rows)
    some = frame.where("doc_id % 25 = 0")
    model = {"weights": train(rows)}
    got = {r.doc_id: r.score for r in score_quality(some, None, model=model).collect()}
    assert len(got) == 40
    for r in some.collect():
        assert abs(got[r.doc_id] - score(r.text or "")) < 1e-3


def test_calibration_finds_slope_and_shift():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1.5 * x + 0.7)))).astype(int)
    slope, shift = calibration(x, y)
    share = np.log(y.mean() / (1 - y.mean()))  # both labels weigh the same
    assert abs(slope - 1.5) < 0.1 and abs(shift - (0.7 - share)) < 0.15
    assert calibration(x[y == 1], y[y == 1]) == (1.0, 0.0) and calibration(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def test_nulls_empty_texts_repeats_and_no_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0)], "doc_id long, quality int")
    frame = docs(spark, ["a b", "c", None, "", "x" * 50000, "a b"], [1, 2, 3, None, 4, 1], CLASH)
    rows = score_quality(frame, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(frame, none).collect()} == {0.5}
    assert score_quality(docs(spark, []), none).count() == 0
