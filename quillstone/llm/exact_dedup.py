"""Exact deduplication by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, drop_scratch, join_groups, write_scratch


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed or carriage return as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def exact_dedup(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the 128-bit MD5 of the normalised text, without texts; only those that share
    their MD5 with another row are grouped again by MD5 and text, which compares bytes and tells
    colliding texts apart. Copies meet on the map side, so a group with a third of all rows costs one
    row for each map task. The groups go back to their members over (MD5, SHA-256). Up to
    `broadcast_rows` shared hashes are broadcast; beyond, all texts go through the second grouping.

    Null text counts as empty. Null ids never stay unless a group has no other (keep_id is null
    then). Rows that repeat the id that stays are all marked kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("norm")).withColumn("h", F.unhex(F.md5("norm")))
    rows, _ = write_scratch(keyed.select("doc_id", "h", F.unhex(F.sha2("norm", 256)).alias("s")), "exact")
    twice, twice_path = write_scratch(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "exact")
    few = twice.count() <= broadcast_rows
    members = keyed.join(F.broadcast(twice), "h", "left_semi") if few else keyed
    groups = members.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups, _ = write_scratch(groups.where("group_size > 1").select("h", F.unhex(F.sha2("norm", 256)).alias("s"), "keep_id", "group_size"), "exact")
    drop_scratch(spark, twice_path)
    found = join_groups(rows, groups, ["h", "s"], "group_size", rows.count(), groups.count() <= broadcast_rows)
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.lower(F.hex("s")).alias("text_sha256"),
    )
