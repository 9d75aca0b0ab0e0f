"""Bounded samples of labelled documents for the classifiers, and where these are trained."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import drop_scratch, write_scratch

Parameters = dict[str, np.ndarray]
_MODEL = "name string, kind string, shape array<int>, data binary"


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0 by 5; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, each: int, most_bytes: int) -> DataFrame:
    """(labelled_id, text, label) of at most `each` rows of either label and texts of at most `most_bytes` bytes.

    Only labelled rows outside the held-out fold count. The ids are chosen in hash order from
    `labels` alone, so what is broadcast and what is returned is bounded by 2 * each rows whatever
    the tables hold. An id that is labelled twice has the larger label; of the texts of an id that
    has several, the one with the smallest hash counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = F.xxhash64("labelled_id")
    chosen = [known.where(F.col("label") == v).orderBy(order, "labelled_id").limit(each) for v in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    return (
        docs.select(F.col("doc_id").cast("long").alias("labelled_id"), F.coalesce("text", F.lit("")).alias("text"))
        .where(F.octet_length("text") <= most_bytes)
        .join(picked, "labelled_id")
        .groupBy("labelled_id")
        .agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("x"))
        .select("labelled_id", "x.text", "x.label")
    )


def trained(rows: DataFrame, fit: Callable[[list[tuple[str, int]]], Parameters], path: str | None = None) -> Parameters:
    """What fit() gives for training_rows(), in the order of their ids.

    It runs in one task, which another executor repeats if its own is lost, so that the driver holds
    the parameters alone; the rows are bounded and so is the task. path: where the model stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            found = pa.Table.from_batches(parts).sort_by("labelled_id")
            made = fit(list(zip(found["text"].to_pylist(), found["label"].to_pylist())))
            columns = zip(*[(k, x.dtype.str, list(x.shape), np.ascontiguousarray(x).tobytes()) for k, x in made.items()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()))], names=["name", "kind", "shape", "data"]
            )

    model = rows.select("labelled_id", "text", "label").repartition(1).mapInArrow(run, _MODEL)
    if path:
        model.write.mode("overwrite").parquet(path)
        return load(rows.sparkSession, path) or fit([])
    made, scratch = write_scratch(model, "model")
    got = load(rows.sparkSession, scratch)
    drop_scratch(rows.sparkSession, scratch)
    return got or fit([])


def load(spark: SparkSession, path: str) -> Parameters:
    """The parameters of a model written by trained(); none if it had no rows to be trained on."""
    return {r.name: np.frombuffer(bytes(r.data), r.kind).reshape(r["shape"]) for r in spark.read.schema(_MODEL).parquet(path).collect()}
