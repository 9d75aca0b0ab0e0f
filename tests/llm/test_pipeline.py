import re
import zlib

import pytest

import corpus_pipeline
from quillstone.llm.common import table
from quillstone.llm.labelled import training_rows
from tests.llm import test_decontamination, test_minhash
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, docs

SF = "/root/testdata/sf0.001"


def ids(frame):
    return sorted((r.doc_id is None, r.doc_id) for r in frame.select("doc_id").collect())


def test_stages_equal_brute_force(spark):
    frame = table(spark, SF, "documents")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        steps.append(frame.cache())
        frame = steps[-1]
    clean, exact, near, apart, last = steps
    assert [f.columns for f in steps[:4]] == [table(spark, SF, "documents").columns] * 4
    first = {}
    for r in sorted(clean.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert ids(exact) == sorted((False, i) for i in first.values())
    rows = [(r.doc_id, r.text) for r in exact.collect()]
    classes = test_minhash.brute(sorted(rows))
    assert ids(near) == sorted((False, i) for i, c in classes.items() if i == c)
    rows = [(r.doc_id, r.text) for r in near.collect()]
    hit = {i for i, _ in test_decontamination.brute(rows, [tuple(r) for r in table(spark, SF, "benchmark").collect()])}
    assert ids(apart) == sorted((False, i) for i, _ in rows if i not in hit)
    assert ids(last) == ids(apart) and all(r.round_trip for r in last.collect())


def test_rows_without_ids_are_judged_by_themselves(spark):
    item = table(spark, SF, "benchmark").first().text
    frame = docs(spark, ["one two three", "a", "a", item, None, "", "a"], [1, None, None, None, None, 2, 3], DOCS)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        frame = stage(spark, frame, SF)
    assert sorted(str((r.doc_id, r.text)) for r in frame.collect()) == ["(1, 'one two three')", "(2, '')", "(3, 'a')"]


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    item = table(spark, SF, "benchmark").first().text
    rows = [(5, "A"), (5, "B"), (3, "B"), (5, "A"), (7, "C"), (9, "C"), (9, item), (9, "D"), (-1, "E")]
    frame = docs(spark, [t for _, t in rows], [i for i, _ in rows], DOCS)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        frame = stage(spark, frame, SF)
    assert frame.columns == DOCS.names
    assert sorted((r.doc_id, r.text) for r in frame.collect()) == [(-1, "E"), (3, "B"), (5, "A"), (7, "C"), (9, "D")]


def test_rows_without_ids_in_all_stages(spark):
    frame = docs(spark, ["one two three", None, "", "plain words here"], [None, None, 2, None], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
    assert sorted(str((r.doc_id, r.n_tokens > 0, r.round_trip)) for r in frame.collect()) == ["(2, False, True)", "(None, True, True)", "(None, True, True)"]


@pytest.mark.parametrize("rows", [0, 3])
def test_empty_table_and_clashing_columns(spark, rows):
    frame = docs(spark, ["a b", "c d", "c d"][:rows], [1, 2, 3][:rows], DOCS)
    frame = frame.withColumns({c: F.lit(k) for k, c in enumerate(("__row_key", "__row", "__id", "h", "count"))})
    columns = frame.columns
    for _, stage in corpus_pipeline.STAGES[:4]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
    assert sorted((r.doc_id, r["__row_key"]) for r in frame.collect()) == [(1, 0), (2, 0)][:rows]


def test_repeated_rows_keep_one_by_the_hash_of_all_columns(spark):
    frame = docs(spark, ["A", "A", "A"], [5, 5, 5], DOCS).withColumn("source", F.expr("uuid()")).cache()
    kept = [corpus_pipeline.exact(spark, x, SF).collect() for x in (frame, frame.repartition(3), frame.orderBy("source"))]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]


def test_more_rejected_rows_than_are_broadcast(spark, monkeypatch):
    frame = docs(spark, ["A", "B", "A", "A"], [5, 6, 7, 8], DOCS)
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_KEYS", 1)
    assert sorted(r.doc_id for r in corpus_pipeline.exact(spark, frame, SF).collect()) == [5, 6]


def test_a_repeated_id_changes_no_other_training_row(spark, monkeypatch):
    """Labels and the held-out fold go by the documents' own ids, also where an id stands for two texts."""
    seen = []

    def fit(docs, labels):
        seen.append({tuple(r) for r in training_rows(docs, labels, "toxic", 5_000, 1 << 12).collect()})
        return {}

    monkeypatch.setattr(corpus_pipeline, "fit_toxicity", fit)
    monkeypatch.setattr(corpus_pipeline, "score_toxicity", lambda docs, labels, model: docs.selectExpr("doc_id", "0 AS predicted"))
    frame = table(spark, SF, "documents")
    again = frame.where("doc_id = 3").withColumn("text", F.lit("another text under the same id"))
    kept = [corpus_pipeline.toxicity(spark, x, SF).count() for x in (frame, frame.unionByName(again))]
    plain, repeated = seen
    assert kept == [frame.count(), frame.count() + 1] and len(plain) > 20
    assert {r for r in plain if r[0] != 3} == {r for r in repeated if r[0] != 3}
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert all(labels[i] == y and texts[i] == t and zlib.crc32(str(i).encode()) % 5 for i, t, y in plain)


def test_short_benchmark_items_reject_no_documents(spark, tmp_path):
    spark.createDataFrame([(1, "one two"), (2, "one two three four five")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs(spark, ["one two is here", "and one two three four five", "else"], schema=DOCS)
    assert ids(corpus_pipeline.decontamination(spark, frame, str(tmp_path))) == [(False, 0), (False, 2)]
