"""Definitions of sections (anchors) and citations (references) in chunk texts.

Every pattern stays within a line, so that a chunk's row is worked on whole and nothing is shuffled.
(?U) gives digits and word characters the Unicode meaning. chunk_id names a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import strip

# The shapes of standalone headers and of inline citations.
ANCHORS = (
    ("article", r"(?U)\A[ \t]*Article[ \t]+(\d+[a-z]?)[ \t]*\z"),
    ("recital", r"(?U)\A[ \t]*Recital[ \t]+(\d+)[ \t]*\z"),
)
HEADING_ANCHOR = r"(?U)\A(\d+[a-z]?)\.?\z"
REFERENCES = {
    "legal": (
        ("article", r"(?U)\bArticle[ \t]+(\d+[a-z]?)(?:\(\d+\))?"),
        ("recital", r"(?U)\bRecital[ \t]+(\d+)"),
        ("section", r"(?U)(?:§[ \t]*|\bSections?[ \t]+)(\d+(?:[-.]\d+)*)"),
        ("case", r"(?U)\b([A-Z][A-Za-z.&'\-]+(?:[ \t]+[A-Z][A-Za-z.&'\-]+)?[ \t]+v\.[ \t]+[A-Z][A-Za-z.&'\-]+(?:[ \t]+[A-Z][A-Za-z.&'\-]+)?)"),
    ),
    "academic": (
        ("arxiv", r"(?Ui)\barXiv:(\d{4}\.\d{4,5})"),
        ("doi", r"(?Ui)\b(?:doi:[ \t]*)?(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)"),
    ),
}


#: What a text must hold for a kind's pattern to match at all.
HINTS = {"article": ("Article",), "recital": ("Recital",), "section": ("§", "Section"), "case": ("v.",), "arxiv": (":",), "doi": ("10.",)}
#: A whole header line within a text.
_HEADER_LINE = r"(?Umd)^[ \t]*(?:Article[ \t]+\d+[a-z]?|Recital[ \t]+\d+)[ \t]*$"
_ANCHOR = "array<struct<kind:string,value:string,line:int,end:int>>"


def _hinted(text: Column, *kinds: str) -> Column:
    found = F.lit(False)
    for hint in (h for k in kinds for h in HINTS[k]):
        found = found | text.contains(hint)
    return found


def _header(content: Column) -> Column:
    """(kind, value) of a standalone header line, else null."""
    found = F.lit(None).cast("struct<kind:string,value:string>")
    for kind, pattern in reversed(ANCHORS):
        found = F.when(content.rlike(pattern), F.struct(F.lit(kind).alias("kind"), F.regexp_extract(content, pattern, 1).alias("value"))).otherwise(found)
    return found


def _text_anchors(text: Column) -> Column:
    """(kind, value, line, end) of the first header line of each (kind, value); end: characters up to its end."""
    lines = F.split(text, "\n", -1)
    hinted = lambda c: F.when(_hinted(c, "article", "recital"), _header(c))
    marked = F.filter(F.transform(lines, lambda c, i: F.struct(hinted(c).alias("a"), i.alias("line"))), lambda x: x["a"].isNotNull())

    def found(x: Column) -> Column:
        first = F.filter(x["marked"], lambda y, i: F.array_position(F.transform(x["marked"], lambda z: z["a"]), y["a"]) == i + 1)
        upto = lambda line: F.length(F.array_join(F.slice(x["lines"], 1, line + 1), "\n"))
        return F.transform(first, lambda y: F.struct(y["a"]["kind"].alias("kind"), y["a"]["value"].alias("value"), y["line"].alias("line"), upto(y["line"]).alias("end")))

    # as the one element of an array, the marked lines are looked for once, not for each use
    once = F.get(F.transform(F.array(F.struct(marked.alias("marked"), lines.alias("lines"))), found), F.lit(0))
    return F.when(_hinted(text, "article", "recital"), once.cast(_ANCHOR)).otherwise(F.array().cast(_ANCHOR))


def text_anchors(chunks: DataFrame, *keep: str) -> DataFrame:
    """(chunk_id, ..., kind, value, line, end): the first header line of each (kind, value); end: characters up to its end."""
    return chunks.select("chunk_id", *keep, F.inline(_text_anchors(F.col("text"))))


def _heading_anchor(path: Column) -> Column:
    """The number of the section that is the whole last heading, or an empty text or null."""
    return F.regexp_extract(strip(F.get(path, F.size(path) - 1)), HEADING_ANCHOR, 1)


def anchor_list(text: Column, heading_path: Column) -> Column:
    """Text anchors and, with line -1 and end null, the heading's, as an array of (kind, value, line, end)."""
    value = _heading_anchor(heading_path)
    head = F.struct(F.lit("section").alias("kind"), value.alias("value"), F.lit(-1).alias("line"), F.lit(None).cast("int").alias("end"))
    return F.concat(_text_anchors(text), F.when(value != "", F.array(head)).otherwise(F.array()).cast(_ANCHOR))


def heading_anchors(chunks: DataFrame, *keep: str) -> DataFrame:
    """(chunk_id, ..., kind, value): a section whose number is the whole last heading."""
    rows = chunks.select("chunk_id", *keep, F.lit("section").alias("kind"), _heading_anchor(F.col("heading_path")).alias("value"))
    return rows.where("value <> ''")


def anchors(chunks: DataFrame) -> DataFrame:
    """(chunk_id, kind, value), each once."""
    return chunks.select("chunk_id", F.inline(anchor_list(F.col("text"), F.col("heading_path")))).select("chunk_id", "kind", "value").distinct()


def with_anchors(chunks: DataFrame) -> DataFrame:
    """chunks with citation_anchors, a map of kinds to sorted values; chunks without anchors have an empty map."""
    pairs = F.transform(anchor_list(F.col("text"), F.col("heading_path")), lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value")))
    kinds = F.array_sort(F.array_distinct(F.transform("_pairs", lambda x: x["kind"])))
    values = lambda k: F.array_sort(F.array_distinct(F.transform(F.filter("_pairs", lambda x: x["kind"] == k), lambda x: x["value"])))
    made = F.map_from_entries(F.transform(kinds, lambda k: F.struct(k.alias("key"), values(k).alias("value"))))
    return chunks.drop("citation_anchors").withColumn("_pairs", pairs).withColumn("citation_anchors", made).drop("_pairs")


def anchors_map(chunks: DataFrame) -> DataFrame:
    """(chunk_id, citation_anchors) of with_anchors()."""
    return with_anchors(chunks).select("chunk_id", "citation_anchors")


def references(chunks: DataFrame, extractors: Sequence[str] = ("legal", "academic"), *keep: str) -> DataFrame:
    """(chunk_id, ..., kind, value, raw): citations outside header lines, the first of each (kind, value).

    Unknown extractor names are ignored. A case's value is in lower case. A pattern runs once, over
    texts that hold its hint; its group is taken from what it has matched.
    """
    kinds = [x for name in REFERENCES if name in extractors for x in REFERENCES[name]]
    body = chunks.select(
        "chunk_id", *keep, F.when(_hinted(F.col("text"), "article", "recital"), F.regexp_replace("text", _HEADER_LINE, "")).otherwise(F.col("text")).alias("_body")
    )
    none = F.array().cast("array<struct<kind:string,value:string,raw:string>>")
    return body.select("chunk_id", *keep, F.inline(F.concat(none, *[_cited(F.col("_body"), kind, pattern) for kind, pattern in kinds])))


def _cited(body: Column, kind: str, pattern: str) -> Column:
    raws = F.when(_hinted(body, kind), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def one(raw: Column, i: Column) -> Column:
        value = F.regexp_extract(raw, pattern, 1)
        return F.struct((F.lower(value) if kind == "case" else value).alias("value"), i.alias("i"), raw.alias("raw"))

    # sorted by value and place, the first of each value is where the value before differs
    first = lambda s: F.filter(s, lambda x, k: (k == 0) | (F.get(s, k - 1)["value"] != x["value"]))
    kept = F.get(F.transform(F.array(F.array_sort(F.transform(raws, one))), first), F.lit(0))
    return F.transform(kept, lambda x: F.struct(F.lit(kind).alias("kind"), x["value"].alias("value"), x["raw"].alias("raw")))
