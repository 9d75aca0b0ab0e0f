import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.operators import lexical, vectors
from quillstone.plans import stages

DIM = 6
SCHEMA = "id long, vector array<float>"


def plain(rows, queries, top_k):
    """Every distance of every query."""
    held = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == DIM and None not in v and np.isfinite(v).all()]
    found = {}
    for q, v in queries:
        near = sorted((float(np.sqrt(((np.array(v, np.float32).astype(float) - x) ** 2).sum())), i) for i, x in held)[:top_k]
        found[q] = [(i, round(d, 9)) for d, i in near]
    return found


def listed(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    return found


@pytest.fixture(scope="module")
def rows():
    """Three dense places, one of them far out, a vector that a third of the rows have, ids that come twice, and rows that are no vectors."""
    rng = np.random.default_rng(5)
    places = np.array([[0.0] * DIM, [1.0] * DIM, [1e4] * DIM])
    some = [(i, (places[i % 3] + rng.normal(size=DIM) * 0.3).astype(np.float32).tolist()) for i in range(400)]
    some += [(1000 + i, [0.5] * DIM) for i in range(200)]
    some += [(7, [0.25] * DIM), (8, some[8][1])]
    return some + [(900, None), (901, [0.0] * 5), (902, [0.0] * 5 + [None]), (903, [0.0] * 5 + [float("nan")]), (904, [float("inf")] + [0.0] * 5), (None, [0.0] * DIM), (905, [])]


@pytest.fixture(scope="module")
def index(spark, rows):
    return vectors.VectorIndex(spark, DIM).build(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="module")
def queries(rows):
    return [(i, v) for i, v in rows[:400] if i % 5 == 0] + [(1000, [0.5] * DIM), (1001, [0.5] * DIM), (2000, [-3.0, 9.0, 0.0, 0.0, 0.0, 2.0])]


def asked(spark, queries):
    return spark.createDataFrame(queries, "query_id long, vector array<float>")


def test_exact_search_is_brute_force(spark, index, rows, queries):
    for k in (1, 10, 250):
        # row 8 is there twice with one vector: a point names an id once
        want = plain({(i, tuple(v) if v else None) for i, v in rows}, queries, k)
        assert listed(index.search(asked(spark, queries), k, exact=True)) == want


def test_measured_search_finds_nine_of_ten(spark, index, rows, queries):
    want = plain({(i, tuple(v) if v else None) for i, v in rows}, queries, 10)
    got = listed(index.search(asked(spark, queries), 10))
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert 1 <= index._table("probes").first().probes <= index._table("lists").count()


def test_all_lists_are_an_exact_search(spark, index, queries):
    wide = index.search(asked(spark, queries), 10, probes=vectors.MOST_LISTS)
    assert listed(wide) == listed(index.search(asked(spark, queries), 10, exact=True))


def test_blocks_change_nothing(spark, index, rows, queries, monkeypatch):
    monkeypatch.setattr(vectors, "POINT_BLOCK", 3)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 2)
    assert listed(index.search(asked(spark, queries), 10, exact=True)) == plain({(i, tuple(v) if v else None) for i, v in rows}, queries, 10)


def test_every_row_is_indexed(index, rows):
    good = [r for r in rows if r[0] is not None and r[0] not in range(900, 906)]
    held = index._table("points")
    assert held.agg(F.sum("n")).first()[0] == len(good)
    assert index._table("codes").count() == held.count() == len({tuple(v) for _, v in good})


def test_error_bounds_hold(spark, index):
    centroids = index._centroids()
    for r in index._table("codes").join(index._table("points"), "point").collect():
        decoded = centroids[r.list] + np.frombuffer(r.code, np.int8) * r.scale
        x = np.array(r.vector, np.float64)
        assert np.linalg.norm(x - decoded) <= r.error + 1e-11 * np.linalg.norm(x)
        assert np.linalg.norm(x - centroids[r.list]) <= r.reach + 1e-11 * np.linalg.norm(x)


def test_no_rows_few_rows_no_queries(spark, index):
    none = vectors.VectorIndex(spark, DIM).build(spark.createDataFrame([], SCHEMA))
    one = asked(spark, [(1, [0.0] * DIM)])
    for exact in (False, True):
        assert none.search(one, 5, exact=exact).count() == 0
        assert index.search(asked(spark, []), 5, exact=exact).count() == 0
        assert index.search(asked(spark, [(1, None), (2, [1.0])]), 5, exact=exact).count() == 0
    few = vectors.VectorIndex(spark, DIM).build(spark.createDataFrame([(3, [1.0] * DIM), (2, [1.0] * DIM)], SCHEMA))
    assert [(r.id, r.rank) for r in few.search(one, 5).orderBy("rank").collect()] == [(2, 1), (3, 2)]


def test_number_of_neighbours_has_bounds(spark, index):
    for k in (0, -1, vectors.MOST_K + 1):
        with pytest.raises(ValueError):
            index.search(asked(spark, []), k)


def test_whole_index_is_read_again(spark, rows, tmp_path, queries):
    frame = spark.createDataFrame(rows, SCHEMA)
    first = vectors.VectorIndex(spark, DIM, str(tmp_path / "v")).build(frame)
    again = vectors.VectorIndex(spark, DIM, str(tmp_path / "v")).build(frame)
    assert first.stages.made and not again.stages.made
    assert listed(again.search(asked(spark, queries), 3)) == listed(first.search(asked(spark, queries), 3))


def test_nearest_others_leave_the_row_out(spark):
    # three copies: row 9's own id is not among the first three
    found = spark.createDataFrame([(9, 1, 1), (9, 2, 2), (9, 3, 3), (2, 1, 1), (2, 2, 2), (2, 9, 3)], "query_id long, id long, rank int")
    got = {(r.query_id, r.id, r.rank) for r in vectors.nearest_others(found, 2).collect()}
    assert got == {(9, 1, 1), (9, 2, 2), (2, 1, 1), (2, 9, 2)}


def test_fusion(spark):
    rank = lambda rows: spark.createDataFrame(rows, "query_id long, id long, rank int")
    fused = vectors.fuse({"a": rank([(1, 10, 1), (1, 11, 2), (1, 11, 5)]), "b": rank([(1, 11, 1), (1, 12, 2), (2, 5, 1)])}, top_k=2)
    got = {(r.query_id, r.id, r["rank"], r.a, r.b, round(r.score, 9)) for r in fused.collect()}
    assert got == {(1, 11, 1, 2, 1, round(1 / 62 + 1 / 61, 9)), (1, 10, 2, 1, None, round(1 / 61, 9)), (2, 5, 1, None, 1, round(1 / 61, 9))}
    assert vectors.fuse({"a": rank([])}).count() == 0


def test_many_searches_equal_single_ones(spark):
    words = ["tax", "cat", "dog", "law", "fox"]
    rng = np.random.default_rng(3)
    texts = [(i, "en web", " ".join(rng.choice(words, 1 + i % 9, p=[0.6, 0.1, 0.1, 0.1, 0.1]))) for i in range(60)] + [(60, None, None), (61, "", "")]
    chunks = spark.createDataFrame(texts, "chunk_id long, context string, text string")
    posted, sizes = lexical.postings(chunks, stemmed=False).cache(), lexical.lengths(chunks).cache()
    asks = [(1, ["fox", "law"]), (2, ["fox", "law"]), (3, ["tax"]), (4, ["tax", "tax", "dog"]), (5, ["none"]), (6, [])]
    many = lexical.search_many(posted, sizes, spark.createDataFrame(asks, "query_id long, terms array<string>"), 10).collect()
    for q, terms in asks:
        want = lexical.scores(posted, sizes, terms).withColumn("score", F.round("score", 9)).orderBy(F.desc("score"), "chunk_id").limit(10)
        assert [(r.chunk_id, r.score) for r in sorted((r for r in many if r.query_id == q), key=lambda r: r["rank"])] == [tuple(r) for r in want.collect()]
    written = stages.Stages(spark)
    held, _ = written.keep("posted", lambda: lexical.chunk_terms(chunks, False, False))
    again = lexical.search_many(held, None, spark.createDataFrame(asks, "query_id long, terms array<string>"), 10, stats=lexical.index_stats(sizes))
    assert sorted(again.collect()) == sorted(many)
    # all postings were read before, and only those of the queries' terms are read for the ranks
    assert not [f for f in again.inputFiles() if "/posted/" in f]
    assert not [f for f in lexical.rarest_terms(held, chunks).inputFiles() if "/posted/" in f]


def test_rarest_terms(spark):
    chunks = spark.createDataFrame([(1, "", "a b c d d"), (2, "", "a b c"), (3, "", "a b"), (4, "z", "a"), (5, "z", "q")], "chunk_id long, context string, text string")
    posted = lexical.postings(chunks, stemmed=False)
    got = {r.query_id: r.terms for r in lexical.rarest_terms(posted, chunks.where("chunk_id <> 3"), 2).collect()}
    assert got == {1: ["c", "b"], 2: ["c", "b"], 4: ["a"]}
