"""Scalar functions on texts, headings and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Spark's trim() only takes spaces.
_EDGES = r"(?U)\A\s+|\s+\z"
# What boilerplate looks like, its shares, and the line of chunks without a heading.
LINK_LINE = r"\A\[[^\]]+\]\(https?://[^)]+\)\z"
MENU_START, MENU_MARK, MENU_WITHIN = "Code:", "Select Code", 200
LEAST_LINES, LINK_SHARE = 5, 0.85
NO_HEADING = "## (no heading)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def is_boilerplate(text: Column) -> Column:
    """A code-selector menu, or at least five non-blank lines of which 85 % are links and nothing else."""
    t = strip(text)
    lines = F.filter(F.transform(F.split(t, r"\R"), strip), lambda x: x != "")
    links = F.filter(lines, lambda x: x.rlike(LINK_LINE))
    menu = t.startswith(MENU_START) & (F.instr(F.substring(t, 1, MENU_WITHIN), MENU_MARK) > 0)
    listed = (F.size(lines) >= LEAST_LINES) & (F.size(links) >= LINK_SHARE * F.size(lines))
    return F.coalesce(menu | listed, F.lit(False))


def est_tokens(text: Column, chars_per_token: int = 4) -> Column:
    """At least 1, and a token for each started `chars_per_token` characters."""
    return F.greatest(F.lit(1), F.ceil(F.length(text) / max(1, chars_per_token)).cast("int"))


def heading_line(path: Column) -> Column:
    named = F.filter(path, lambda x: strip(x) != "")
    return F.when(F.size(named) > 0, F.concat(F.lit("## "), F.array_join(named, " > "))).otherwise(NO_HEADING)


def render_chunk(path: Column, text: Column) -> Column:
    return F.concat(heading_line(path), F.lit("\n"), text)


def doc_header(title: Column, url: Column) -> Column:
    return F.concat(F.lit("# "), title, F.lit("\nSource: "), url)


def is_suspicious(context: Column, chunk: Column) -> Column:
    """Fewer than 5 or more than 120 words, or a copy of how the chunk begins."""
    words = F.size(F.filter(F.split(context, r"(?U)\s+"), lambda x: x != ""))
    return ~words.between(5, 120) | strip(chunk).startswith(strip(context))


def query_tokens(text: Column) -> Column:
    """The runs of word characters, in any script."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1))


def match_query(text: Column) -> Column:
    """Each token quoted, joined by OR; empty without tokens."""
    return F.array_join(F.transform(query_tokens(text), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")


def prompt_messages(header: Column, window: Column, chunk: Column) -> Column:
    """The JSON of two content blocks, of which only the first, the window, may be cached."""
    first = F.struct(
        F.lit("text").alias("type"),
        F.concat(header, F.lit("\n\n"), window).alias("text"),
        F.struct(F.lit("ephemeral").alias("type")).alias("cache_control"),
    )
    second = F.struct(F.lit("text").alias("type"), chunk.alias("text"), F.lit(None).cast("struct<type:string>").alias("cache_control"))
    return F.to_json(F.array(first, second))
