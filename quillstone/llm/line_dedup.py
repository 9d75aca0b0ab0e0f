"""Deduplication of lines across documents, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, drop_scratch, free_shuffles, join_groups, write_scratch

LEAST_CHARS, LEAST_DOCS = 10, 2
_SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z; other letters stay. Text of ASCII alone takes the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def line_key(line: Column) -> Column:
    """What two lines are compared by: without ASCII white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(_SPACES)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def drop_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, text (of the lines that stay), n_lines, n_dropped.

    Lines are what lies between line feeds; null or empty text is one empty line. Lines whose key (see
    line_key) has at least `least_chars` code points and is found in at least `least_docs` documents
    go, but for those of the smallest doc_id that holds the key, all of which stay. Other lines stay in
    their order. Rows of one id are one document; those without id are together one document, after all
    others. Rows that repeat each get their row. Other columns are ignored.

    A line is its 128-bit hash: texts are not moved to find the shared ones. Hashes are counted on
    the map side first, so a line of a third of all documents costs a row for each map task, and go
    back to their places by join_groups(). Places of lines that go are gathered for each row, at most
    as many as it has lines, and the text is cut between them once, so that many of them cost no more
    than few. A row is named by its id and the hash and length of its text.
    """
    spark = docs.sparkSession
    least_docs = max(2, least_docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("*", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k1"), F.xxhash64("text").alias("k2"), F.octet_length("text").alias("k3"))
    cut = rows.select("doc_id", "k1", "k2", "k3", F.posexplode(_lines(F.col("text"))).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    lines, lines_path = write_scratch(cut.where(F.char_length("key") >= least_chars).select("doc_id", "k1", "k2", "k3", "pos", F.unhex(F.md5("key")).alias("h")), "lines")
    first, last = F.min("doc_id"), F.max("doc_id")
    # two documents at least: two ids, or an id and rows without one
    several = (F.col("first") < F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull())
    counted = lines.groupBy("h").agg(first.alias("first"), last.alias("last"), F.max(F.col("doc_id").isNull()).alias("unnamed"), F.count(F.lit(1)).alias("n"))
    shared, shared_path = write_scratch(counted.where(several).select("h", "first", "n"), "lines")
    n_lines = lines.count()
    if least_docs > 2:
        held = join_groups(lines.select("h", "doc_id"), shared, ["h"], "n", n_lines, shared.count() <= broadcast_rows, "inner").select("h", "doc_id").distinct()
        enough = held.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least_docs).select("h")
        narrow, narrow_path = write_scratch(shared.join(enough, "h"), "lines")
        drop_scratch(spark, shared_path)
        shared, shared_path = narrow, narrow_path
    found = join_groups(lines, shared, ["h"], "n", n_lines, shared.count() <= broadcast_rows, "inner").where(~F.col("doc_id").eqNullSafe(F.col("first")))
    gone = found.groupBy("k1", "k2", "k3").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    gone, _ = write_scratch(gone.select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), F.col("k3").alias("g3"), "gone"), "lines")
    drop_scratch(spark, lines_path, shared_path)
    free_shuffles(spark)
    placed = rows.join(gone, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")) & (F.col("k3") == F.col("g3")), "left")
    none = F.array().cast("array<int>")
    placed = placed.select("doc_id", _lines(F.col("text")).alias("lines"), F.coalesce("gone", none).alias("gone"))
    # what stays lies between one place that goes and the next
    after = lambda j: F.when(j == 0, 0).otherwise(F.get("gone", j - 1) + 1)
    upto = lambda j: F.coalesce(F.get("gone", j), F.size("lines"))
    parts = F.transform(F.sequence(F.lit(0), F.size("gone")), lambda j: F.slice("lines", after(j) + 1, upto(j) - after(j)))
    return placed.select(
        "doc_id", F.array_join(F.flatten(parts), "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped")
    )
