"""What the operators of this subpackage share: table access, scratch tables, gapless ranks, components."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Rows in one Arrow batch handed to Python; slices() bounds the bytes that are expanded at once.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table of at most so many rows is broadcast where its rows have a fixed size of some 100 bytes.
BROADCAST_ROWS = 200_000
#: A key with more than one in so many of the rows is hot; there can't be more than so many of them.
HOT_KEYS = 1_000
#: Rows of one key that meet its value in one task where the value is a whole text.
SPREAD_ROWS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local master, where all run on one machine, may leave it unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        where = "/tmp/checkpoints"
    return where.rstrip("/")


_left: dict[str, SparkSession] = {}


def write_scratch(df: DataFrame, label: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """Cuts the lineage: the rows as a Parquet table in the shared folder, and its path for drop_scratch()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillstone-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _left[path] = spark
    return spark.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _left.pop(path, None)


@atexit.register
def _drop_left() -> None:
    for path, spark in list(_left.items()):
        try:
            drop_scratch(spark, path)
        except Exception:  # the session has ended before the interpreter
            return


@contextmanager
def scratch_scope(spark: SparkSession, keep: list[str]) -> Iterator[None]:
    """Drops the scratch tables that the block has written, but for those whose paths it puts into keep."""
    before = set(_left)
    yield
    drop_scratch(spark, *[p for p in list(_left) if p not in before and p not in keep])


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of steps whose results have been written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def set_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds, for every operator that hands texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def gapless_rank(df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[str], out: str) -> DataFrame:
    """Adds a rank from 0 without gaps within `by`, ordered by (bucket, order).

    No window spans a whole group: rows are numbered within (by, bucket), and bucket counts, at
    most one row for each (by, bucket), are summed up and broadcast as offsets. `bucket` must take
    a bounded number of values and spread the rows.
    """
    df = df.withColumn("_bucket", bucket)
    keys = [*by, "_bucket"]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket") if by else Window.partitionBy(F.lit(0)).orderBy("_bucket")
    offsets = counts.select(*[F.col(k).alias(f"_o_{k}") for k in keys], (F.sum("_n").over(before) - F.col("_n")).alias("_offset"))
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    joined = numbered.join(F.broadcast(offsets), same)
    return joined.withColumn(out, F.col("_rn") + F.col("_offset")).drop("_bucket", "_rn", "_offset", *[f"_o_{k}" for k in keys])


def hash_bucket(key: Column, bits: int = 10) -> Column:
    """The top bits of a 64-bit hash: buckets in the hash's own (unsigned) order."""
    return F.shiftrightunsigned(key, 64 - bits)


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int, small: bool = False, how: str = "left") -> DataFrame:
    """rows joined (left or inner) with groups, which has one row for each (non-null) key and the number `size` of the key's rows.

    No task gets more than a fixed share of the rows by a key: the keys with more than one in HOT_KEYS
    of all `total` rows, of which there are less than HOT_KEYS, are broadcast and their rows stay where
    they are; the others are shuffled. small: groups has at most BROADCAST_ROWS rows and is broadcast whole.
    """
    own = [c for c in groups.columns if c not in keys]
    named = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *own)
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_g_{k}"))
    clean = lambda frame: frame.drop(*[f"_g_{k}" for k in keys])
    if small:
        return clean(rows.join(F.broadcast(named), same, how))
    many = F.col(size) * HOT_KEYS > total
    hot, rest = F.broadcast(named.where(many)), named.where(~many | F.col(size).isNull())
    near = rows.join(hot, same)
    far = rows.join(hot.select([f"_g_{k}" for k in keys]), same, "left_anti").join(rest, same, how)
    return clean(near).unionByName(clean(far))


def join_spread(rows: DataFrame, values: DataFrame, key: str, by: str, counted: DataFrame | None = None, per: int | None = None, few: int = BROADCAST_ROWS) -> DataFrame:
    """rows joined with values, which has one large value for each key, so that at most about `per` rows of one key meet in a task.

    The rows of a key with more of them are dealt by the hash of `by`, and its value goes to each deal: one copy for
    `per` rows, not one for each. counted has the same keys as rows, for which it stands where these cost more
    to be read twice. The keys dealt are at most a `per`-th of the rows and are broadcast up to `few`.
    """
    per = per or SPREAD_ROWS
    many = (rows if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > per).select(key, F.floor(F.col("_rows") / per).cast("int").alias("_deals"))
    many, _ = write_scratch(many, "deals")
    dealt = F.broadcast(many) if many.count() <= few else many
    at = F.pmod(F.xxhash64(by), F.coalesce("_deals", F.lit(0)) + 1).cast("int")
    left = rows.join(dealt, key, "left").withColumn("_deal", at).drop("_deals")
    right = values.join(dealt, key, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), F.coalesce("_deals", F.lit(0))))).drop("_deals")
    return left.join(right, [key, "_deal"]).drop("_deal")


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and two sums of hashes: equal for equal sets."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", F.lit(7), "u").cast("decimal(20,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """Connected components as rows (node, root), root the smallest node; only nodes with an edge.

    Alternating large-star and small-star rounds over edge tables in the shared folder; the number
    of rounds grows with the logarithm of the diameter, and nothing but counts and sums reach the
    driver. Minima are found by map-side aggregation and go back to the edges by join_groups(), so
    that a node with very many edges is no task of its own. Rounds end when an edge table has the
    same count and hash sums (two of 64 bits) as the one before.
    """
    spark = edges.sparkSession
    now, path = write_scratch(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), label
    )
    state = _digest(now)
    while True:
        total = 2 * state[0]
        # large star: every larger neighbour of a node is linked to the smallest node of its neighbourhood
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_groups(both.where("v > u"), least, ["u"], "n", total, total <= BROADCAST_ROWS)
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour of a node is linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = (
            join_groups(large, low, ["u"], "n", total, total <= BROADCAST_ROWS)
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new, new_path = write_scratch(small, label)
        drop_scratch(spark, path)
        before, state = state, _digest(new)
        now, path = new, new_path
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
