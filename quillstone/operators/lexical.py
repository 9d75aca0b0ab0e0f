"""The lexical index: postings of context and text, weighted BM25, and a fingerprint of what is indexed."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.ids import SEPARATOR
from quillstone.operators.joins import join_hot, keep_few, repeated
from quillstone.plans.stages import Stages

K1, B = 1.2, 0.75
WEIGHTS = (1.0, 2.0)
LEAST_IDF = 1e-6
SCHEMA_VERSION = 1
TOKENIZE = "porter unicode61"
#: Hashes in one value of an ordered list: 4 KB, so that an Arrow batch of 10,000 values has 40 MB.
PACKED = 128


class NotBuiltError(RuntimeError):
    """There is no complete index at that place."""


# Fixed value: what a token is made of, by the rule of the unicode61 tokenizer: letters, digits and
# characters of private use, with accents after the first; other marks and the underscore divide.
TOKEN = r"([\p{L}\p{N}\p{Co}][\p{L}\p{N}\p{Co}\x{300}-\x{331}]*)"


def tokens(text: Column) -> Column:
    """The lower-case tokens of a text, see TOKEN."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))


@lru_cache(maxsize=100_000)
def fold(token: str) -> str:
    """Without accents on Latin letters."""
    return "".join(c for c in unicodedata.normalize("NFD", token) if not unicodedata.combining(c))


class _Porter:
    """Porter's stemmer, from the published algorithm (Porter 1980) with its author's later rules bli and logi."""

    DOUBLE = {"bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"}
    # The suffix tables of steps 2 to 4.
    STEP2 = "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
    STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
    STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"

    def __init__(self) -> None:
        pairs = lambda s: sorted((tuple(x.split(":")) for x in s.split()), key=lambda x: -len(x[0]))
        self.step2, self.step3 = pairs(self.STEP2), pairs(self.STEP3)
        self.step4 = sorted(self.STEP4.split(), key=lambda x: -len(x))

    @staticmethod
    def shape(word: str) -> str:
        """v for a vowel, c for a consonant; y is a vowel after a consonant."""
        out = ""
        for i, c in enumerate(word):
            out += "v" if c in "aeiou" or c == "y" and i and out[-1] == "c" else "c"
        return out

    def measure(self, stem: str) -> int:
        return len(re.findall("v+c", self.shape(stem)))

    def cvc(self, word: str) -> bool:
        return self.shape(word)[-3:] == "cvc" and word[-1] not in "wxy"

    def stem(self, w: str) -> str:
        if len(w) <= 2 or not re.fullmatch("[a-z]+", w):
            return w
        for end, put in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
            if w.endswith(end):
                w = w[: len(w) - len(end)] + put
                break
        if w.endswith("eed"):
            if self.measure(w[:-3]) > 0:
                w = w[:-1]
        else:
            for end in ("ed", "ing"):
                if w.endswith(end):
                    if "v" in self.shape(w[: -len(end)]):
                        w = w[: -len(end)]
                        if w.endswith(("at", "bl", "iz")):
                            w += "e"
                        elif len(w) > 1 and w[-1] == w[-2] and self.shape(w)[-1] == "c" and w[-1] not in "lsz":
                            w = w[:-1]
                        elif self.measure(w) == 1 and self.cvc(w):
                            w += "e"
                    break
        if w.endswith("y") and "v" in self.shape(w[:-1]):
            w = w[:-1] + "i"
        for table in (self.step2, self.step3):
            for end, put in table:
                if w.endswith(end):
                    if self.measure(w[: len(w) - len(end)]) > 0:
                        w = w[: len(w) - len(end)] + put
                    break
        for end in self.step4:
            if w.endswith(end):
                stem = w[: len(w) - len(end)]
                if self.measure(stem) > 1 and (end != "ion" or stem[-1:] in ("s", "t")):
                    w = stem
                break
        if w.endswith("e"):
            m = self.measure(w[:-1])
            if m > 1 or m == 1 and not self.cvc(w[:-1]):
                w = w[:-1]
        if w.endswith("ll") and self.measure(w[:-1]) > 1:
            w = w[:-1]
        return w


_porter = _Porter()


def stem(token: str) -> str:
    return _porter.stem(fold(token))


@lru_cache(maxsize=1_000_000)
def _known(token: str) -> str:
    return stem(token)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stemmed(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Lists of tokens to lists of stems: each distinct token of a batch is stemmed once, and remembered."""
    for batch in lists:
        coded = batch.flatten().dictionary_encode()
        stems = pa.array([_known(w) for w in coded.dictionary.to_pylist()], pa.string())
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        yield pa.ListArray.from_arrays(ends, stems.take(coded.indices) if len(coded) else stems.cast(pa.string()))


def terms(text: Column, stemmed: bool = True) -> Column:
    """The terms of a text (null: none) in their order."""
    found = tokens(F.coalesce(text, F.lit("")))
    return _stemmed(found) if stemmed else found


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The values of lists (null: none), the row of each, and its place in its list."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class TermGroups:
    """The (row, term) pairs of two columns of token lists: row, code of the term in names, how often and where it is in either column."""

    row: np.ndarray
    code: np.ndarray
    names: pa.Array
    n: tuple[np.ndarray, np.ndarray]
    places: tuple[pa.Array, pa.Array]

    @classmethod
    def of(cls, context: pa.Array, text: pa.Array, stemmed: bool, by_term: bool = False) -> TermGroups:
        """In order of the rows or, with by_term, of the codes and then of the rows; places ascend."""
        (a, row_a, at_a), (b, row_b, at_b) = _flat(context), _flat(text)
        coded = pa.concat_arrays([a, b]).dictionary_encode()
        names, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        if stemmed:
            stems = pa.array([_known(w) for w in names.to_pylist()], pa.string()).dictionary_encode()
            names, code = stems.dictionary, stems.indices.to_numpy().astype(np.int64)[code]
        row, at = np.r_[row_a, row_b], np.r_[at_a, at_b]
        width = max(1, len(context) if by_term else len(names))
        key = code * width + row if by_term else row * width + code
        order = np.argsort(key, kind="stable")
        key, in_text, at = key[order], order >= len(a), at[order].astype(np.int32)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(key)] if len(key) else starts
        before = np.r_[0, np.cumsum(in_text)]
        n_text = before[ends] - before[starts]
        n_context = ends - starts - n_text
        places = lambda n, values: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(values))
        first, second = np.divmod(key[starts], width)
        row, code = (second, first) if by_term else (first, second)
        return cls(row, code, names, (n_context, n_text), (places(n_context, at[~in_text]), places(n_text, at[in_text])))


def _by_row(groups: TermGroups, rows: int, columns: list[pa.Array], names: list[str]) -> pa.Array:
    """For each row the list of its terms, with columns."""
    ends = pa.array(np.searchsorted(groups.row, np.arange(rows + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([groups.names.take(pa.array(groups.code)), *columns], ["term", *names]))


def _grouped(stemmed: bool, places: bool) -> Callable[[Column, Column], Column]:
    """An Arrow UDF from a chunk's token lists to the list of its terms, with places or with counts."""

    def one(context: pa.Array, text: pa.Array) -> pa.Array:
        found = TermGroups.of(context, text, stemmed)
        if places:
            return _by_row(found, len(context), list(found.places), ["context", "text"])
        return _by_row(found, len(context), [pa.array(n.astype(np.int64)) for n in found.n], ["tf_context", "tf_text"])

    of = "term string, context array<int>, text array<int>" if places else "term string, tf_context long, tf_text long"
    one.__annotations__ = dict.fromkeys(("context", "text", "return"), pa.Array)  # the worker looks for types, not for their names
    return F.arrow_udf(one, f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in of.split(', '))}>>")


def repeated_ids(chunks: DataFrame) -> DataFrame | None:
    """(hash) of the chunk ids that several rows have, or None where no id repeats."""
    return repeated(chunks, "chunk_id")


def chunk_terms(chunks: DataFrame, stemmed: bool, places: bool) -> DataFrame:
    """(chunk_id, length, term, ...) with the places of each term of a chunk in its two fields (context, text) or their number (tf_context, tf_text).

    A chunk's terms are grouped where its row lies, so nothing is shuffled; only the rows of ids that repeat are put together afterwards.
    """
    listed = lambda c: tokens(F.coalesce(F.col(c), F.lit("")))
    lists = chunks.select("chunk_id", listed("context").alias("c"), listed("text").alias("t"))
    made = _grouped(stemmed, places)(F.col("c"), F.col("t"))
    rows = lambda frame: frame.select("chunk_id", (F.size("c") + F.size("t")).cast("long").alias("length"), F.inline(made))
    twice = repeated_ids(chunks)
    if twice is None:
        return rows(lists)
    hashed = lists.withColumn("hash", F.xxhash64("chunk_id"))
    if places:
        together = [F.sort_array(F.flatten(F.collect_list(c))).alias(c) for c in ("context", "text")]
    else:
        together = [F.sum(c).alias(c) for c in ("tf_context", "tf_text")]
    merged = rows(hashed.join(twice, "hash", "left_semi")).groupBy("term", "chunk_id").agg(F.max("length").alias("length"), *together)
    once = rows(hashed.join(twice, "hash", "left_anti"))
    return once.unionByName(merged)


def postings(chunks: DataFrame, stemmed: bool = True) -> DataFrame:
    """(term, chunk_id, tf_context, tf_text). Tokens are stemmed and counted where they lie, within a chunk's row."""
    return chunk_terms(chunks, stemmed, False).select("term", "chunk_id", "tf_context", "tf_text")


def lengths(chunks: DataFrame) -> DataFrame:
    """(chunk_id, length): tokens of context and text, unweighted."""
    size = lambda c: F.size(tokens(F.coalesce(F.col(c), F.lit(""))))
    return chunks.select("chunk_id", (size("context") + size("text")).cast("long").alias("length"))


def index_stats(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("average"))


def scores(posted: DataFrame, sizes: DataFrame, terms: list[str], weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """(chunk_id, score) of the chunks with any of the terms; a term given twice counts twice.

    The few query terms select postings at the scan; their document counts and the corpus size are
    one row each and are broadcast. A chunk's parts are summed in the order of the query's terms, so
    that equal chunks have equal scores to the last bit.
    """
    hits = posted.where(F.col("term").isin(sorted(set(terms))))
    return _scored(hits, hits.join(sizes, "chunk_id"), index_stats(sizes), terms, weights)


def _scored(hits: DataFrame, sized: DataFrame, stats: DataFrame, terms: list[str], weights: tuple[float, float]) -> DataFrame:
    """scores() from the terms' postings, the same with their chunks' lengths, and index_stats()."""
    asked = hits.sparkSession.createDataFrame(list(enumerate(terms)), "nth int, term string")
    known = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    f = F.col("tf_context") * weights[0] + F.col("tf_text") * weights[1]
    raw = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(raw <= 0, LEAST_IDF).otherwise(raw)
    share = f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / F.col("average")))
    idfs = asked.join(known, "term").crossJoin(stats).select("term", "nth", idf.alias("idf"), "average")
    rows = sized.join(F.broadcast(idfs), "term").select("chunk_id", F.struct("nth", (F.col("idf") * share).alias("part")).alias("x"))
    parts = rows.groupBy("chunk_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return parts.select("chunk_id", F.aggregate("xs", F.lit(0.0), lambda acc, x: acc + x["part"]).alias("score"))


def _may_stem_to(token: Column, wanted: list[str]) -> Column:
    """False only for tokens of which no wanted term is the stem: a stem differs from an ASCII token's beginning in its last two characters at most."""
    starts = sorted({t[:-2] for t in wanted})
    found = F.octet_length(token) != F.length(token)
    for start in starts:
        found = found | token.startswith(start)
    return found


def matches(chunks: DataFrame, wanted: list[str], stemmed: bool = True) -> tuple[DataFrame, DataFrame]:
    """(chunk_id, length, term, tf_context, tf_text) of the wanted terms, and index_stats() of all chunks, from one pass over the texts. There is at least one wanted term.

    Every text is split into tokens once; only tokens that may have a wanted stem are stemmed. What is found is written, so it is
    read again without the texts. Rows that share an id are one chunk as far as they have wanted terms: their counts and lengths are added.
    """
    listed = lambda c: tokens(F.coalesce(F.col(c), F.lit("")))
    may = (lambda x: _may_stem_to(x, wanted)) if stemmed else (lambda x: x.isin(wanted))
    lists = chunks.select("chunk_id", listed("context").alias("c"), listed("text").alias("t"))
    rows = lists.select("chunk_id", (F.size("c") + F.size("t")).cast("long").alias("length"), F.filter("c", may).alias("c"), F.filter("t", may).alias("t"))
    times = lambda c, term: F.size(F.filter(c, lambda x: x == term)).cast("long")
    if stemmed:
        found = F.filter(_grouped(True, False)(F.col("c"), F.col("t")), lambda x: x["term"].isin(wanted))
    else:
        each = [F.struct(F.lit(t).alias("term"), times("c", t).alias("tf_context"), times("t", t).alias("tf_text")) for t in wanted]
        found = F.filter(F.array(*each), lambda x: x["tf_context"] + x["tf_text"] > 0)
    spark, seen = chunks.sparkSession, Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"))
    some = counted.where(F.size("c") + F.size("t") > 0).select("chunk_id", "length", found.alias("found"))
    held, _ = Stages(spark).keep("matches", lambda: some.where(F.size("found") > 0))
    n, total = seen.get["n"], seen.get["tokens"]
    stats = spark.createDataFrame([(n, total / n if n else None)], "n long, average double")
    twice = repeated(held, "chunk_id")
    if twice is None:
        return held.select("chunk_id", "length", F.inline("found")), stats
    whole = held.groupBy("chunk_id").agg(F.sum("length").alias("length"), F.flatten(F.collect_list("found")).alias("found"))
    together = [F.sum(c).alias(c) for c in ("tf_context", "tf_text")]
    return whole.select("chunk_id", "length", F.inline("found")).groupBy("chunk_id", "length", "term").agg(*together), stats


def query_phrases(text: str, stemmed: bool = True) -> list[list[str]]:
    """A query's words, each as the list of its tokens: a word with underscores is a phrase, since these divide tokens but not words."""
    of = lambda c: unicodedata.category(c)
    kept = "".join(c if of(c)[0] in "LN" or of(c) == "Co" or "\u0300" <= c <= "\u0331" or c == "_" else " " for c in text.lower())
    marks = "".join(map(chr, range(0x300, 0x332)))
    found = [[t for t in (x.lstrip(marks) for x in word.split("_")) if t] for word in kept.split()]
    return [[stem(t) for t in word] if stemmed else word for word in found if word]


def query_terms(text: str, stemmed: bool = True) -> list[str]:
    """The tokens of a query by the rule of tokens()."""
    return [t for word in query_phrases(text, stemmed) for t in word]


def search(posted: DataFrame, sizes: DataFrame, text: str, top_k: int = 50, stemmed: bool = True, weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """(chunk_id, score), best first, ties by chunk_id; no rows for a query without tokens."""
    if top_k < 0:
        raise ValueError("top_k is negative")
    found = scores(posted, sizes, query_terms(text, stemmed), weights)
    return found.orderBy(F.desc("score"), "chunk_id").limit(top_k)


def search_chunks(chunks: DataFrame, text: str, top_k: int = 50, stemmed: bool = True, weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """search() of one query in chunks that have no postings, see matches()."""
    if top_k < 0:
        raise ValueError("top_k is negative")
    terms = query_terms(text, stemmed)
    if not terms:
        return chunks.select("chunk_id", F.lit(0.0).alias("score")).limit(0)
    hits, stats = matches(chunks, sorted(set(terms)), stemmed)
    return _scored(hits, hits, stats, terms, weights).orderBy(F.desc("score"), "chunk_id").limit(top_k)


def rarest_terms(posted: DataFrame, chosen: DataFrame, number: int = 3, least_df: int = 2) -> DataFrame:
    """(query_id, terms): of each chunk of chosen (chunk_id), the rarest terms of its text that least_df chunks hold, ties by term.

    posted should be a written table; it is read once for the chosen chunks' terms, which are written, and once for the counts.
    Chunks without such terms get no row.
    """
    stages, one = Stages(posted.sparkSession), F.count(F.lit(1))
    named, n = stages.keep("chosen", lambda: chosen.select("chunk_id").distinct(), n=one)
    held = posted.where(F.col("tf_text") > 0).join(keep_few(named, n["n"]), "chunk_id", "left_semi").select("chunk_id", "term")
    rows, n = stages.keep("own", lambda: held, n=one)
    known, _ = stages.keep("known", lambda: posted.groupBy("term").agg(one.alias("df")).where(F.col("df") >= least_df))
    nth = F.row_number().over(W.partitionBy("chunk_id").orderBy("df", "term"))
    rare = join_hot(rows, known, ["term"], "inner", total=n["n"]).withColumn("nth", nth).where(F.col("nth") <= number)
    listed = F.array_sort(F.collect_list(F.struct("nth", "term")))
    return rare.groupBy(F.col("chunk_id").alias("query_id")).agg(F.transform(listed, lambda x: x["term"]).alias("terms"))


def search_many(
    posted: DataFrame, sizes: DataFrame | None, queries: DataFrame, top_k: int = 50, weights: tuple[float, float] = WEIGHTS, digits: int = 9, stats: DataFrame | None = None
) -> DataFrame:
    """(query_id, chunk_id, score, rank): search() for many queries (query_id, terms), whose scores are rounded before they rank.

    Queries of equal terms are answered once. A query's rows are those of its terms' postings, so common terms cost as much
    for each query here as they do in a search; a term's postings may lie in any number of tasks. posted should be a written table;
    it is read once, and the postings of the queries' terms are written. If it has `length`, sizes may be None and stats is index_stats().
    """
    stages, one = Stages(posted.sparkSession), F.count(F.lit(1))
    asked, _ = stages.keep("asked", lambda: queries.where(F.size("terms") > 0).select("query_id", "terms", F.md5(F.array_join("terms", SEPARATOR)).alias("query")))
    words, _ = stages.keep("words", lambda: asked.select("query", "terms").distinct().select("query", F.posexplode("terms").alias("nth", "term")))
    terms, n = stages.keep("terms", lambda: words.select("term").distinct(), n=one)
    hits, n = stages.keep("hits", lambda: posted.join(keep_few(terms, n["n"]), "term", "left_semi"), n=one)
    known = hits.groupBy("term").agg(one.alias("df"))
    raw = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(raw <= 0, LEAST_IDF).otherwise(raw).alias("idf")
    counts = index_stats(sizes) if stats is None else stats
    weighed, _ = stages.keep("weighed", lambda: words.join(known, "term").crossJoin(F.broadcast(counts)).select("query", "nth", "term", idf, "average"))
    f = F.col("tf_context") * weights[0] + F.col("tf_text") * weights[1]
    share = f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / F.col("average")))
    met = join_hot(hits, weighed, ["term"], "inner", total=n["n"])
    met = met if "length" in posted.columns else met.join(sizes, "chunk_id")
    parts = met.groupBy("query", "chunk_id").agg(F.array_sort(F.collect_list(F.struct("nth", (F.col("idf") * share).alias("part")))).alias("xs"))
    scored = parts.select("query", "chunk_id", F.round(F.aggregate("xs", F.lit(0.0), lambda acc, x: acc + x["part"]), digits).alias("score"))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "chunk_id"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= top_k)
    lists, _ = stages.keep("lists", lambda: best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "chunk_id", "score"))).alias("found")))
    return join_hot(asked.select("query_id", "query"), lists, ["query"], "inner").select("query_id", F.inline("found")).select("query_id", "chunk_id", "score", "rank")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = 0
    for batch in batches:
        starts = range(0, batch.num_rows, PACKED)
        lists = [b"".join(batch.column(1).slice(i, PACKED).to_pylist()) for i in starts]
        places = [place + k for k in range(len(lists))]
        place += len(lists)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(starts, pa.int32())), pa.array(places, pa.int64()), pa.array(lists, pa.binary())], names=["range", "place", "hashes"])


def packed_hashes(chunks: DataFrame) -> DataFrame:
    """(range, place, hashes): the rows' SHA-256 in order of chunk_id, up to PACKED of them joined in one value; ranges of ids are sorted in tasks of their own."""
    rows = row_hashes(chunks).select("chunk_id", F.unhex("h").alias("h")).repartitionByRange("chunk_id").sortWithinPartitions("chunk_id", "h")
    return rows.select(F.spark_partition_id().alias("range"), "h").mapInArrow(_pack, "range int, place long, hashes binary")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole, n = hashlib.sha256(), 0
    for batch in batches:
        for packed in batch.column(0):
            whole.update(packed.as_py().hex().encode())
            n += len(packed.as_py()) // 32
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([whole.hexdigest()])], names=["n", "digest"])


def corpus_digest(chunks: DataFrame) -> DataFrame:
    """(n, digest): SHA-256 over the rows' id, context and text in order of chunk_id.

    The rows are hashed where they lie and sorted in ranges. By its nature the value is a hash over one ordered
    list, which goes through one task: 32 bytes a chunk, packed, without ids, and hashed as they
    are read, so that no list is held. bucket_digests() has no such task.
    """
    ordered = packed_hashes(chunks).repartition(1).sortWithinPartitions("range", "place").select("hashes")
    found = ordered.mapInArrow(_digest, "n long, digest string")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("digest"))


def bucket_digests(chunks: DataFrame, digits: int = 4) -> DataFrame:
    """(bucket, n, digest): corpus_digest() of the chunks by the first hexadecimal digits of their id's SHA-256.

    The digits grow with the corpus: a bucket's list is one value, of some 64 characters a chunk.
    """
    return digests_of(row_hashes(chunks), digits)


def row_hashes(chunks: DataFrame, *more: str) -> DataFrame:
    """(chunk_id, h): the SHA-256 of what is indexed of a chunk, with more of its columns."""
    return chunks.select("chunk_id", *more, F.sha2(F.concat_ws(SEPARATOR, "chunk_id", F.coalesce("context", F.lit("")), "text"), 256).alias("h"))


def digests_of(hashes: DataFrame, digits: int = 4) -> DataFrame:
    """bucket_digests() from row_hashes()."""
    bucket = F.substring(F.sha2("chunk_id", 256), 1, digits)
    rows = hashes.select(bucket.alias("bucket"), F.struct("chunk_id", "h").alias("x"))
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), ""), 256).alias("digest")
    )


def fingerprint(chunks: DataFrame, tokenize: str = TOKENIZE, weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """One row: chunk_count, digest of the buckets' digests in order, tokenize, weights, schema_version."""
    return fingerprint_of(row_hashes(chunks), tokenize, weights)


def fingerprint_of(hashes: DataFrame, tokenize: str = TOKENIZE, weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """fingerprint() from row_hashes()."""
    listed = F.array_sort(F.collect_list(F.struct("bucket", "digest")))
    whole = digests_of(hashes).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("chunk_count"), F.sha2(F.array_join(F.transform(listed, lambda x: x["digest"]), ""), 256).alias("digest")
    )
    return whole.select("*", F.lit(tokenize).alias("tokenize"), F.lit(json.dumps(list(weights))).alias("weights"), F.lit(SCHEMA_VERSION).alias("schema_version"))
