"""The corpus pipeline: stages over `documents`, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import drop_scratch, gapless_rank, scratch_scope, table, write_scratch
from quillstone.llm.decontamination import contaminated
from quillstone.llm.exact_dedup import exact_dedup
from quillstone.llm.minhash import near_duplicates
from quillstone.llm.pieces import encode_documents
from quillstone.llm.toxicity import fit_toxicity, score_toxicity

#: Ranges of ids within which rows are numbered where an id stands for different texts.
RANGES = 200
#: Keys of rejected rows, of 8 bytes each, up to which they are broadcast, so that the documents stay where they are.
BROADCAST_KEYS = 1_000_000
#: Tokens that a benchmark item has at least for documents that hold it to be rejected: a shorter one is a common phrase.
ITEM_TOKENS = 5


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that names a row within a stage by its id and text, and that column's name.

    It is the id or, if an id stands for different texts, the rank of (id, hash of the text), so that
    smaller ids keep smaller keys. Rows without id have a number from the text, after all real ids.
    """
    key = "__row_key"
    while key in docs.columns:
        key += "_"
    stand_in = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    number = F.col("doc_id").cast("long")
    texts = docs.select(number.alias("__id"), F.xxhash64("text").alias("__text")).where("__id is not null")
    if not texts.groupBy("__id").agg(F.min("__text").alias("a"), F.max("__text").alias("b")).where("a <> b").limit(1).count():
        return docs.withColumn(key, F.coalesce(number, stand_in)), key
    cuts = sorted(set(texts.select(F.percentile_approx("__id", [k / RANGES for k in range(1, RANGES)])).first()[0]))
    bucket = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("__id")))
    ranks, _ = write_scratch(gapless_rank(texts.distinct(), [], bucket, ["__id", "__text"], "__rank"), "keys")
    named = docs.withColumn(f"{key}i", number).withColumn(f"{key}t", F.xxhash64("text"))
    found = named.join(ranks, (F.col(f"{key}i") == F.col("__id")) & (F.col(f"{key}t") == F.col("__text")), "left")
    return found.withColumn(key, F.coalesce("__rank", stand_in)).drop(f"{key}i", f"{key}t", "__id", "__text", "__rank"), key


def _judged(docs: DataFrame, key: str) -> DataFrame:
    """What an operator gets: the key as doc_id, and the text."""
    return docs.select(F.col(key).alias("doc_id"), "text")


def _without(docs: DataFrame, key: str, rejected: DataFrame) -> DataFrame:
    """docs, with all their columns but the key, without the rows whose key is rejected."""
    gone, _ = write_scratch(rejected.select(F.col("doc_id").alias(key)).distinct(), "rejected")
    few = gone.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(gone) if few else gone, key, "left_anti").drop(key)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.

    The model is trained by the documents' own ids, by which labels and the held-out fold go, not by the
    keys that rows have within the stage; the rows are scored by their text alone.
    """
    rows, key = _keyed(docs)
    model = fit_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _without(rows, key, score_toxicity(_judged(rows, key), None, model=model).where("predicted = 1"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each text; of rows that repeat an id and its text, the one with the smallest hash of all columns."""
    rows, key = _keyed(docs)
    if rows.groupBy(key).count().where("count > 1").limit(1).count():
        rows = rows.groupBy(key).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row")).select(key, "__row.*")
    return _without(rows, key, exact_dedup(_judged(rows, key)).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    rows, key = _keyed(docs)
    return _without(rows, key, near_duplicates(_judged(rows, key)).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item of at least ITEM_TOKENS tokens."""
    rows, key = _keyed(docs)
    found = contaminated(_judged(rows, key), table(spark, sf_dir, "benchmark"))
    return _without(rows, key, found.where(F.col("item_tokens") >= ITEM_TOKENS))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the remaining documents: doc_id, n_tokens, ids, round_trip."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", pieces),
]
#: The classifier and the encoder can't be put in SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's own tables, and the one it has read, go once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        kept: list[str] = []
        with scratch_scope(spark, kept):
            docs, path = write_scratch(stage(spark, docs, sf_dir), name)
            kept.append(path)
        if before:
            drop_scratch(spark, before)
        before = path
    return docs
