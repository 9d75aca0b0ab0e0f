"""Enrichment contexts of chunks: what is pinned, what is missing, what the rest would cost."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions.ids import text_sha256
from quillstone.functions.text import est_tokens, is_suspicious, strip
from quillstone.operators.chunking import context_windows
from quillstone.sources.planning import read_json, write_json


@dataclass(frozen=True)
class Pricing:
    """Limits, lengths (in characters) of the fixed prompts, and prices in USD for a million tokens."""

    chars_per_token: int = 4
    min_cacheable: int = 4096
    output_per_chunk: int = 150
    system_chars: int = 593
    instruction_chars: int = 144
    header_chars: int = 64
    price_in: float = 1.0
    price_out: float = 5.0
    write_factor: float = 2.0
    read_factor: float = 0.1

    def tokens(self, chars: int) -> int:
        return max(1, -(-chars // max(1, self.chars_per_token)))


PIN_FILE = "doc_id string, model string, prompt_version int, generated_at string, contexts map<string,struct<context:string,text_sha256:string,window_index:int>>"


def read_pin_files(spark: SparkSession, glob: str) -> DataFrame:
    """Pin files of one object, or of one a line, as rows; a broken one, or one that is no object, gives none."""
    return read_json(spark, glob, PIN_FILE).where("doc_id is not null")


def save_pin_files(files: DataFrame, path: str) -> None:
    """Replaces a folder of pins, which the rows may be read from; a crash leaves the old ones or the new ones (see write_json)."""
    write_json(files, path)


def pin_rows(files: DataFrame) -> DataFrame:
    """(slug, model, prompt_version, chunk_id, context, text_sha256, window_index) of pin files with a contexts map."""
    return files.select(F.col("doc_id").alias("slug"), "model", "prompt_version", F.explode("contexts").alias("chunk_id", "c")).select(
        "slug", "model", "prompt_version", "chunk_id", "c.context", "c.text_sha256", "c.window_index"
    )


def valid_pins(pins: DataFrame, chunks: DataFrame, model: str, prompt_version: int) -> DataFrame:
    """(chunk_id, context) of pins of this model and prompt version, not blank, whose chunk still has the same text."""
    now = chunks.select("chunk_id", text_sha256(F.col("text")).alias("sha"))
    same = pins.where((F.col("model") == model) & (F.col("prompt_version") == prompt_version)).join(now, "chunk_id")
    context = strip(F.col("context"))
    return same.where((F.col("text_sha256") == F.col("sha")) & (context != "")).select("chunk_id", context.alias("context"))


def with_contexts(chunks: DataFrame, pinned: DataFrame, generate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """chunks with context and origin (pinned, generated, missing). generate gets the chunks without a pin
    and returns (chunk_id, context) or (chunk_id, context, error); blank contexts count as missing. Pins come first.
    With errors there is context_error: what generate says of a chunk that it left without a context."""
    todo = chunks.join(pinned, "chunk_id", "left_anti")
    rows = chunks.join(pinned.select("chunk_id", F.col("context").alias("_pinned")), "chunk_id", "left")
    if generate is None:
        rows = rows.withColumn("_made", F.lit(None).cast("string"))
    else:
        made = generate(todo)
        said = ["error"] if "error" in made.columns else []
        made = made.select("chunk_id", F.nullif(strip(F.col("context")), F.lit("")).alias("_made"), *[F.col(c).alias("_error") for c in said])
        rows = rows.join(made.where(" or ".join(f"{c} is not null" for c in made.columns[1:])), "chunk_id", "left")
    origin = F.when(F.col("_pinned").isNotNull(), "pinned").when(F.col("_made").isNotNull(), "generated").otherwise("missing")
    failed = [F.when(origin == "missing", F.col("_error")).alias("context_error")] if "_error" in rows.columns else []
    return rows.drop("context").select("*", F.coalesce("_pinned", "_made").alias("context"), origin.alias("origin"), *failed).drop("_pinned", "_made", "_error")


def merge_pins(old: DataFrame, new: DataFrame, model: str, prompt_version: int) -> DataFrame:
    """New pins over old ones; old ones of another model or prompt version are discarded."""
    same = old.where((F.col("model") == model) & (F.col("prompt_version") == prompt_version))
    o = same.select("chunk_id", F.struct("context", "text_sha256", "window_index").alias("o"))
    n = new.select("chunk_id", F.struct("context", "text_sha256", "window_index").alias("n"))
    return o.join(n, "chunk_id", "full_outer").select("chunk_id", F.coalesce("n", "o").alias("p")).select("chunk_id", "p.*")


def context_stats(rows: DataFrame, by: str | None = None) -> DataFrame:
    """Counts of pinned, generated and missing contexts."""
    n = lambda what: F.count_if(F.col("origin") == what).alias(what)
    return (rows.groupBy(by) if by else rows.groupBy()).agg(n("pinned"), n("generated"), n("missing"))


def estimate_cost(chunks: DataFrame, target: int = 6000, most: int = 8000, pricing: Pricing | None = None) -> DataFrame:
    """Tokens and USD by document, and in the row with null doc for all documents together.

    In a window whose prefix can be cached, the first chunk writes the prefix and the others read
    it; otherwise each chunk pays for it.
    """
    p = pricing or Pricing()
    windows = context_windows(chunks, target, most, p.chars_per_token)
    prefix = F.col("est_tokens") + p.tokens(p.system_chars) + p.tokens(p.header_chars)
    k, cached = F.size("chunk_indices"), prefix >= p.min_cacheable
    priced = windows.select(
        "doc",
        F.lit(1).alias("windows"),
        k.alias("chunks"),
        cached.cast("int").alias("cacheable_windows"),
        F.when(cached, 0).otherwise(prefix * k).alias("input_tokens"),
        F.when(cached, prefix).otherwise(0).alias("cache_write_tokens"),
        F.when(cached, prefix * (k - 1)).otherwise(0).alias("cache_read_tokens"),
        (k * p.output_per_chunk).alias("output_tokens"),
    )
    zero = F.lit(0)
    own = est_tokens(F.col("text"), p.chars_per_token) + p.tokens(p.instruction_chars)
    texts = chunks.select("doc", *[zero.alias(c) for c in ("windows", "chunks", "cacheable_windows")], own.alias("input_tokens"), *[zero.alias(c) for c in ("cache_write_tokens", "cache_read_tokens", "output_tokens")])
    totals = [F.sum(c).alias(c) for c in priced.columns[1:]]
    summed = priced.unionByName(texts).rollup("doc").agg(*totals)
    usd = (
        F.col("input_tokens") * p.price_in
        + F.col("cache_write_tokens") * (p.price_in * p.write_factor)
        + F.col("cache_read_tokens") * (p.price_in * p.read_factor)
        + F.col("output_tokens") * p.price_out
    ) / 1_000_000
    return summed.withColumn("usd", F.bround(usd, 4))


def coverage(chunks: DataFrame) -> DataFrame:
    """One row: chunks, how many have a context, how many lack one, how many have a suspicious one."""
    empty = F.coalesce(strip(F.col("context")), F.lit("")) == ""
    odd = ~empty & is_suspicious(F.col("context"), F.col("text"))
    return chunks.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~empty).alias("with_context"), F.count_if(empty).alias("empty"), F.count_if(odd).alias("suspicious")
    )


def coverage_flags(chunks: DataFrame) -> DataFrame:
    """(chunk_id, flag) of the chunks that coverage() counts as empty or suspicious."""
    empty = F.coalesce(strip(F.col("context")), F.lit("")) == ""
    flag = F.when(empty, "empty").when(is_suspicious(F.col("context"), F.col("text")), "suspicious")
    return chunks.select("chunk_id", flag.alias("flag")).where("flag is not null")


def usage_total(usage: DataFrame, *counters: str) -> DataFrame:
    return usage.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters])


def shortfall(rows: DataFrame, required: bool) -> Column:
    """error if contexts are required and some are missing, note if some are missing, else null; over context_stats()."""
    return F.when(F.col("missing") > 0, F.lit("error" if required else "note"))
