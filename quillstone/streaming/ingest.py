"""Incremental ingest: new document files become chunks once each, by the batch rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstone.functions.ids import chunk_id, doc_id
from quillstone.plans.stages import Stages

SCHEMA = "url string, version string, text string"
#: Hexadecimal digits of a chunk's id by which the store is divided.
BUCKET_DIGITS = 2
#: Bits of a bucket's filter for one batch, and hashes of an id: up to 100,000 ids in a bucket, one in a hundred is asked for in vain.
BLOOM_BITS, BLOOM_HASHES = 1 << 20, 7


def new_documents(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Documents (url, version, text) of Parquet files as they arrive in a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def chunk_lines(docs: DataFrame) -> DataFrame:
    """A chunk for each line; stateless, so it reads batches and streams alike."""
    rows = docs.where("url is not null and version is not null").select("url", "version", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("chunk_index", "text"))
    url, version = F.col("url"), F.col("version")
    return rows.select(doc_id(url, version).alias("doc_id"), "chunk_index", chunk_id(url, version, F.col("chunk_index")).alias("chunk_id"), "text")


def _bits(chunk_id: Column) -> Column:
    """The (word, bit) pairs of an id in its bucket's filter."""
    at = [F.pmod(F.xxhash64(chunk_id, F.lit(k)), F.lit(BLOOM_BITS)) for k in range(BLOOM_HASHES)]
    return F.array(*[F.struct(F.shiftright(x, 6).cast("int").alias("word"), x.bitwiseAND(F.lit(63)).cast("int").alias("bit")) for x in at])


def blooms(rows: DataFrame) -> DataFrame:
    """(bucket, word, bits): a Bloom filter for each bucket of rows (bucket, chunk_id), without its empty words."""
    one = F.expr("shiftleft(1L, bit)")
    return rows.select("bucket", F.inline(_bits(F.col("chunk_id")))).groupBy("bucket", "word").agg(F.bit_or(one).alias("bits"))


def possible_hashes(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """(batch, bucket, hash) of the rows (bucket, chunk_id) whose id a filter (batch, bucket, word, bits) may have; ids go by their 64-bit hash.

    Two ids of one hash may only be asked for together, so no id that a filter has is left out.
    """
    bits = F.array_distinct(_bits(F.col("chunk_id")))
    asked = rows.select("bucket", F.xxhash64("chunk_id").alias("hash"), bits.alias("bits_of"))
    asked = asked.select("bucket", "hash", F.size("bits_of").alias("asked"), F.inline("bits_of"))
    met = asked.join(filters, ["bucket", "word"]).where(F.getbit("bits", F.col("bit")) == 1)
    return met.groupBy("batch", "bucket", "hash", "asked").agg(F.count(F.lit(1)).alias("met")).where("met >= asked").select("batch", "bucket", "hash")


def possible(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows (bucket, chunk_id) whose id a filter may have, with that batch."""
    named = rows.select("bucket", "chunk_id", F.xxhash64("chunk_id").alias("hash")).distinct()
    return named.join(possible_hashes(rows, filters), ["bucket", "hash"]).select("batch", "bucket", "chunk_id")


def upsert(path: str, seen: list[tuple[int, int, int]] | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a batch's chunks that the store lacks; a batch that runs again writes the same folder anew.

    The store lies by batch and by bucket, the first BUCKET_DIGITS digits of a chunk's id, and has a Bloom filter for each
    bucket of a batch. A batch asks the filters, which have a few bits for each id, and reads only the
    buckets of those batches that may hold one of its ids; the store as a whole is read by none. seen: gets (batch,
    buckets that were read, buckets there are) for each.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = jvm(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        bucket = F.substring("chunk_id", 1, BUCKET_DIGITS).alias("bucket")
        rows, _ = Stages(spark).keep("batch", lambda: chunk_lines(batch).dropDuplicates(["chunk_id"]).select("*", bucket))
        names = [x.getPath().getName() for x in fs.listStatus(jvm(path))] if fs.exists(jvm(path)) else []
        before = [n for n in names if n.startswith("batch=") and int(n.split("=")[1]) < number and fs.exists(jvm(f"{path}/_blooms/{n}/_SUCCESS"))]
        fresh = rows
        if before:
            filters = spark.read.schema("batch int, bucket string, word int, bits long").option("basePath", f"{path}/_blooms").parquet(*[f"{path}/_blooms/{n}" for n in before])
            maybe, _ = Stages(spark).keep("maybe", lambda: possible_hashes(rows, filters))
            # at most a row for each bucket of each batch
            held = [(r.batch, r.bucket) for r in maybe.select("batch", "bucket").distinct().collect()]
            parts = [f"{path}/batch={b}/bucket={k}" for b, k in sorted(held) if fs.exists(jvm(f"{path}/batch={b}/bucket={k}"))]
            if seen is not None:
                seen.append((number, len(parts), filters.select("batch", "bucket").distinct().count()))
            if parts:
                known = spark.read.schema(chunk_lines(batch).schema).parquet(*parts).select("chunk_id")
                known = known.join(maybe.select("hash").distinct(), F.xxhash64("chunk_id") == F.col("hash"), "left_semi")
                fresh = rows.join(known, "chunk_id", "left_anti")
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={number}")
        done = spark.read.schema(rows.schema).parquet(f"{path}/batch={number}")
        blooms(done.select("bucket", "chunk_id")).write.mode("overwrite").parquet(f"{path}/_blooms/batch={number}")

    return write


def start(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return docs.writeStream.foreachBatch(upsert(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
