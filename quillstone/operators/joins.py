"""Joins in which no task gets the rows of a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.plans.stages import Stages

#: A key with more than one in so many of the rows is hot; there are fewer of them.
HOT_KEYS = 1_000
#: Rows of one key up to which keep_few() broadcasts; they have some 100 bytes.
BROADCAST_ROWS = 200_000


def keep_few(keys: DataFrame, n: int) -> DataFrame:
    """A table of n keys, broadcast where these are few, so that what is joined with it stays where it is."""
    return F.broadcast(keys) if n <= BROADCAST_ROWS else keys


def join_hot(rows: DataFrame, values: DataFrame, keys: Sequence[str], how: str = "left", total: int | None = None, hot_keys: int | None = None) -> DataFrame:
    """rows joined (left or inner) with values, which has few rows for each key.

    Keys are counted by their 64-bit hashes; of those with more than a thousandth of all rows the values are broadcast
    and the rows stay where they are, all others are shuffled. rows are read several times, so they should be a
    written table; total is their number, if it is known.
    """
    keys = list(keys)
    types = {f.name: f.dataType for f in rows.schema}
    hashed = lambda frame: F.xxhash64(*[F.col(k).cast(types[k]) for k in keys])
    counts = rows.groupBy(hashed(rows).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count() if total is None else total
    if not total:
        return rows.join(values, keys, how)
    hot = [r[0] for r in counts.where(F.col("_n") * (hot_keys or HOT_KEYS) > total).select("_h").collect()]
    if not hot:
        return rows.join(values, keys, how)
    near = rows.where(hashed(rows).isin(hot)).join(F.broadcast(values.where(hashed(values).isin(hot))), keys, how)
    return near.unionByName(rows.where(~hashed(rows).isin(hot)).join(values, keys, how))


def repeated(rows: DataFrame, *columns: str) -> DataFrame | None:
    """(hash) of what several rows have in these columns, or None where nothing repeats; only 8 bytes a row are shuffled for it."""
    counts = rows.groupBy(F.xxhash64(*columns).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    found, n = Stages(rows.sparkSession).keep("repeated", lambda: counts.where("n > 1").select("hash"), n=F.count(F.lit(1)))
    return found if n["n"] else None


def marked(rows: DataFrame, found: DataFrame | None, *columns: str) -> DataFrame:
    """rows with `again`: whether these columns' hash is among those of repeated()."""
    if found is None:
        return rows.withColumn("again", F.lit(False))
    named = found.select(F.col("hash").alias("_h"), F.lit(True).alias("_again"))
    return rows.withColumn("_h", F.xxhash64(*columns)).join(named, "_h", "left").withColumn("again", F.coalesce("_again", F.lit(False))).drop("_h", "_again")
