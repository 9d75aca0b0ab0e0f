"""Content-derived identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def doc_id(url: Column, version: Column) -> Column:
    """SHA-256 of url and version around a unit separator. Neither may be null: concat then gives null, not a wrong id."""
    return F.sha2(F.concat(url, F.lit(SEPARATOR), version), 256)


def chunk_id(url: Column, version: Column, index: Column) -> Column:
    return F.sha2(F.concat(url, F.lit(SEPARATOR), version, F.lit(SEPARATOR), index.cast("string")), 256)


def text_sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def ascii_json(value: Column) -> Column:
    """The JSON string literal of a text with every character outside printable ASCII as \\uXXXX; null is the literal null."""
    quoted = F.substring(F.to_json(F.array(value)), F.lit(2), F.length(F.to_json(F.array(value))) - 2)

    def escaped(c: Column) -> Column:
        code = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        units = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(4)), lambda i: F.concat(F.lit("\\u"), F.substring(code, i, F.lit(4))))
        return F.when((F.octet_length(c) == 1) & (c != "\x7f"), c).otherwise(F.array_join(units, ""))

    bare = value.rlike(r"\A[ !#-\[\]-~]*\z")  # nothing to escape, as in ids
    plain = ~value.rlike(r"[^\x00-\x7E]")
    safe = F.when(bare, F.concat(F.lit('"'), value, F.lit('"'))).when(plain, quoted).otherwise(F.array_join(F.transform(F.split(quoted, ""), escaped), ""))
    return F.when(value.isNull(), F.lit("null")).otherwise(safe)


def edge_id(source: Column, target: Column, kind: Column, provenance: Column) -> Column:
    """SHA-256 of the compact ASCII JSON list of the four values."""
    parts = [ascii_json(x) for x in (source, target, kind, provenance)]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")), 256)
