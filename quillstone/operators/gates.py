"""Expectations of a built corpus, and integrity rules that storage does not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def structure_gate(fixtures: DataFrame, chunks: DataFrame) -> DataFrame:
    """(name, passed, missing) of fixtures (name, doc_id, must_contain, must_contain_in_table).

    A needle may span chunks, whose texts are divided by line ends, or the table chunks alone. It is looked for
    in each chunk together with what follows, as many characters as the longest needle has; so a document
    is never put together, however long. Only documents that a fixture names are read. A fixture that
    asserts nothing raises.
    """
    none = F.array().cast("array<string>")
    asked = fixtures.select("name", "doc_id", F.coalesce("must_contain", none).alias("anywhere"), F.coalesce("must_contain_in_table", none).alias("in_table"))
    bare = asked.where((F.size("anywhere") == 0) & (F.size("in_table") == 0)).take(1)
    if bare:
        raise ValueError(f"fixture {bare[0].name} asserts nothing")
    needles = asked.select("doc_id", F.explode(F.concat("anywhere", "in_table")).alias("needle"))
    longest = needles.agg(F.max(F.length("needle"))).first()[0] or 1
    rows = chunks.join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    found = asked.select("name", "doc_id", "anywhere", "in_table")
    for column, own in (("anywhere", rows), ("in_table", rows.where("chunk_type = 'table'"))):
        wanted = asked.select("doc_id", F.explode(column).alias("x")).groupBy("doc_id").agg(F.collect_set("x").alias("needles"))
        hits = with_following(own, longest - 1).join(wanted, "doc_id").select("doc_id", F.explode(F.filter("needles", lambda x: F.contains(F.col("hay"), x))).alias("x"))
        found = found.join(hits.groupBy("doc_id").agg(F.collect_set("x").alias(f"_{column}")), "doc_id", "left")
    lacks = lambda c: F.filter(c, lambda x: (x != "") & ~F.array_contains(F.coalesce(f"_{c}", none), x))
    missing = F.concat(lacks("anywhere"), lacks("in_table"))
    return found.select("name", (F.size(missing) == 0).alias("passed"), missing.alias("missing"))


def with_following(chunks: DataFrame, chars: int) -> DataFrame:
    """(doc_id, hay): each chunk's text, a line end, and the next `chars` characters of the document as far as there are any.

    A chunk adds its line end at least, so as many following chunks suffice, each with as many characters.
    """
    chars = max(1, chars)
    ahead = Window.partitionBy("doc_id").orderBy("chunk_index").rowsBetween(1, chars)
    rest = F.collect_list(F.substring("text", 1, chars)).over(ahead)
    rows = chunks.select("doc_id", "text", rest.alias("rest"))
    tail = F.substring(F.array_join("rest", "\n"), 1, chars)
    return rows.select("doc_id", F.when(F.size("rest") == 0, F.col("text")).otherwise(F.concat_ws("\n", "text", tail)).alias("hay"))


def graph_gate(expectations: DataFrame, known: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, edges, passed, pending) of expectations (name, from_slug, to_slug, min_edges, pending); an unknown slug has no edges."""
    side = lambda s: known.select(F.col("slug").alias(f"{s}_slug"), F.col("doc_id").alias(f"{s}_doc"))
    rows = expectations.join(side("from"), "from_slug", "left").join(side("to"), "to_slug", "left").join(counts, ["from_doc", "to_doc"], "left")
    n = F.coalesce("n", F.lit(0))
    return rows.select("name", n.alias("edges"), (n >= F.col("min_edges")).alias("passed"), F.coalesce("pending", F.lit(False)).alias("pending"))


def all_passed(results: DataFrame) -> DataFrame:
    """One row; pending expectations don't count, and no expectations are all met."""
    rows = results.where(~F.col("pending")) if "pending" in results.columns else results
    return rows.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("passed"))


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def duplicates(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
