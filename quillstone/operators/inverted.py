"""The stored lexical index: segments of positional postings, with changes, phrases and blocks that a search skips.

A segment holds what one build or update has added:

- `postings` (term, block, n, most_context, most_text, least_length, postings): of the chunks of a block with that term, their number,
  what bounds their scores, and for each its number in the block, its length, and the term's places in its context and text; a file
  holds some blocks, sorted by term, so that a search reads its terms alone;
- `docs` (chunk_id, length, h, block, nth): the chunks, the hash of what is indexed of them, and their numbers in their blocks;
- `terms` (term, df): how many of its chunks have a term.

A block is a range of the chunk ids' hashes, the same for all terms and segments. Only texts are shuffled for an index, by their blocks,
and a chunk is a small number in its postings; a number stands for one chunk of a block in all segments. An update adds a segment
of what is new or changed and deletion marks (segment, block, nth) with the counts that go (`terms`, negative)
for what has changed or gone. A version is one row of JSON that lists segments and marks with
their counts; it is written last, so a search sees all of an update or nothing. When marks or
segments are many, merge() writes one segment from the postings, without looking at a text.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstone.operators.lexical import B, K1, LEAST_IDF, TOKENIZE, WEIGHTS, NotBuiltError, TermGroups, chunk_terms, fingerprint, fingerprint_of, query_phrases, repeated_ids, row_hashes, terms

#: Segments, and the share of all chunks that are marked, above which an update merges.
MOST_SEGMENTS, MOST_MARKED = 8, 0.2
#: Chunks that a block has on average, to a factor of 4, as far as the number of blocks, 16**digits, allows.
BLOCK_CHUNKS, MOST_DIGITS = 1024, 4
#: Bytes of texts whose postings are sorted in one task and lie in one file.
FILE_BYTES = 1 << 23
#: Best chunks that are looked up in the table of chunks by a broadcast; more of them, with one score, are joined.
FEW_CHUNKS = 100_000
#: Bounds are raised by this share, more than any rounding.
SLACK = 1e-9
#: Blocks that are named in a filter, which the scan can use; more are joined.
NAMED_BLOCKS = 1000
#: What names a chunk in a search.
_CHUNK = ["segment", "block", "nth"]
_POSTING = pa.struct([("nth", pa.int32()), ("length", pa.int32()), ("context", pa.list_(pa.int32())), ("text", pa.list_(pa.int32()))])
_POSTINGS = (
    "term string, block int, n int, most_context int, most_text int, least_length int, "
    "postings array<struct<nth: int, length: int, context: array<int>, text: array<int>>>"
)


def _post(stemmed: bool, first: int) -> Callable[[pa.Table], pa.Table]:
    """What makes a block's rows of postings from its chunks (block, chunk_id, c, t), whose numbers are from first on, in order of their ids."""

    def post(chunks: pa.Table) -> pa.Table:
        chunks = chunks.sort_by("chunk_id").combine_chunks()
        column = lambda name: chunks.column(name).combine_chunks()
        context, text = column("c"), column("t")
        found = TermGroups.of(context, text, stemmed, by_term=True)
        size = lambda lists: pc.list_value_length(lists).to_numpy()
        length = (size(context) + size(text)).astype(np.int32)[found.row]
        starts = np.flatnonzero(np.r_[True, found.code[1:] != found.code[:-1]]) if len(found.code) else np.zeros(0, np.int64)
        ends = np.r_[starts, len(found.code)].astype(np.int32)
        over = lambda f, values: pa.array(f.reduceat(values, starts).astype(np.int32) if len(starts) else values[:0].astype(np.int32))
        rows = pa.StructArray.from_arrays([pa.array((found.row + first).astype(np.int32)), pa.array(length), *found.places], fields=list(_POSTING))
        return pa.table({
            "term": found.names.take(pa.array(found.code[starts])),
            "block": pa.array(np.full(len(starts), chunks.column("block")[0].as_py(), np.int32)),
            "n": pa.array(np.diff(ends)),
            "most_context": over(np.maximum, found.n[0]),
            "most_text": over(np.maximum, found.n[1]),
            "least_length": over(np.minimum, length),
            "postings": pa.ListArray.from_arrays(pa.array(ends), rows),
        })

    return post


def positional_postings(chunks: DataFrame, stemmed: bool = True) -> DataFrame:
    """(term, chunk_id, length, context, text): the places of each term of a chunk in its two fields, in order."""
    return chunk_terms(chunks, stemmed, True).select("term", "chunk_id", "length", "context", "text")


def phrase_places(hits: DataFrame, phrase: list[str]) -> DataFrame:
    """(segment, block, nth, length, context, text) of the chunks in which the terms of a phrase follow one another in a field, and where: the places of its
    terms, each moved back by its number in the phrase, are intersected."""
    asked = hits.sparkSession.createDataFrame(list(enumerate(phrase)), "at int, term string")
    back = lambda c: F.transform(c, lambda x: x - F.col("at")).alias(c)
    rows = hits.where(F.col("term").isin(sorted(set(phrase)))).join(F.broadcast(asked), "term").select(*_CHUNK, "length", back("context"), back("text"))
    met = rows.groupBy(*_CHUNK).agg(F.first("length").alias("length"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("context", "text")).alias("x")).where(F.col("n") == len(phrase))
    both = lambda c: F.aggregate(F.slice(F.col(f"x.{c}"), 2, len(phrase)), F.get(F.col(f"x.{c}"), F.lit(0)), F.array_intersect).alias(c)
    return met.select(*_CHUNK, "length", both("context"), both("text")).where((F.size("context") > 0) | (F.size("text") > 0))


def score_share(f: Column, length: Column, average: float) -> Column:
    """What a part has of its idf: it grows with the weighted frequency f and falls with the length."""
    return f * (K1 + 1) / (f + K1 * (1 - B + B * length / average))


def idf(n: int, df: int) -> float:
    raw = math.log((n - df + 0.5) / (df + 0.5))
    return raw if raw > 0 else LEAST_IDF


@dataclass
class Report:
    """What the last search read of the blocks that hold one of its terms."""

    blocks: int = 0
    skipped: int = 0


class Index:
    """An index in a folder. invalidate() removes its versions; it is to be built again then."""

    def __init__(self, spark: SparkSession, path: str, tokenize: str = TOKENIZE, weights: tuple[float, float] = WEIGHTS):
        if not re.fullmatch("[a-z0-9_ ]+", tokenize):
            raise ValueError(f"not a tokenizer: {tokenize}")
        self.spark, self.path, self.tokenize, self.weights = spark, path, tokenize, weights
        self.report = Report()

    @property
    def stemmed(self) -> bool:
        return "porter" in self.tokenize.split()

    # versions

    def _at(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _names(self, folder: str) -> list[str]:
        fs, at = self._at(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def _drop(self, name: str) -> None:
        fs, at = self._at(name)
        fs.delete(at, True)

    def _versions(self) -> list[str]:
        return [v for v in self._names("versions") if "_SUCCESS" in self._names(f"versions/{v}")]

    def version(self) -> dict:
        """The current version: segments, marks, digits, fingerprint."""
        found = self._versions()
        if not found:
            raise NotBuiltError(self.path)
        return json.loads(self.spark.read.text(f"{self.path}/versions/{found[-1]}").first()[0])

    def built(self) -> bool:
        return bool(self._versions())

    def invalidate(self) -> None:
        self._drop("versions")

    def _commit(self, version: dict, hashes: DataFrame) -> None:
        """Writes the version, last of all; the one before stays for those that read it, parts that neither lists go."""
        version["fingerprint"] = fingerprint_of(hashes, self.tokenize, self.weights).first().asDict()
        before = self._versions()
        number = int(before[-1]) + 1 if before else 0
        self.spark.createDataFrame([(json.dumps(version),)], "v string").coalesce(1).write.text(f"{self.path}/versions/{number:08d}")
        for old in before[:-1]:
            self._drop(f"versions/{old}")
        named = json.dumps([json.loads(self.spark.read.text(f"{self.path}/versions/{v}").first()[0]) for v in self._versions()])
        for folder in ("segments", "marks"):
            for name in self._names(folder):
                if name not in named:
                    self._drop(f"{folder}/{name}")

    # what a version holds

    def _read(self, version: dict, table: str) -> DataFrame:
        """A table of all segments, with `segment`."""
        frames = [self.spark.read.parquet(f"{self.path}/segments/{s['id']}/{table}").withColumn("segment", F.lit(s["id"])) for s in version["segments"]]
        return reduce(DataFrame.unionByName, frames)

    def _marks(self, version: dict, table: str) -> DataFrame | None:
        frames = [self.spark.read.parquet(f"{self.path}/marks/{m['id']}/{table}") for m in version["marks"]]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _live(self, version: dict, rows: DataFrame) -> DataFrame:
        """rows (segment, block, nth, ...) without those marked as gone; the marks are a bounded share of the index, see merge()."""
        marks = self._marks(version, "chunks")
        return rows if marks is None else rows.join(marks.select(*_CHUNK), _CHUNK, "left_anti")

    def _hits(self, version: dict, wanted: list[str]) -> DataFrame:
        """(segment, block, term, nth, length, context, text) of the chunks with one of the terms."""
        rows = self._read(version, "postings").where(F.col("term").isin(wanted))
        return self._live(version, rows.select("segment", "block", "term", F.inline("postings")))

    def live_docs(self, version: dict | None = None) -> DataFrame:
        """(chunk_id, length, h, block, nth, segment) of the chunks that a search can find."""
        version = version or self.version()
        return self._live(version, self._read(version, "docs"))

    @staticmethod
    def _size(version: dict) -> tuple[int, int]:
        """Chunks and tokens."""
        return tuple(sum(s[k] for s in version["segments"]) - sum(m[k] for m in version["marks"]) for k in ("n", "tokens"))

    # changes

    def _block(self, digits: int) -> Column:
        return F.conv(F.substring(F.sha2("chunk_id", 256), 1, digits), 16, 10).cast("int")

    def _segment(self, postings: DataFrame, docs: DataFrame, end: int = 0) -> dict:
        """Writes a segment of postings, of which a partition has whole blocks, and docs (chunk_id, length, h, block, nth) with numbers up to end or beyond."""
        name = uuid.uuid4().hex
        at = f"{self.path}/segments/{name}"
        postings.sortWithinPartitions("term", "block").write.option("compression", "zstd").parquet(f"{at}/postings")
        docs.select("chunk_id", "length", "h", "block", "nth").write.option("compression", "zstd").parquet(f"{at}/docs")
        counts = self.spark.read.schema(_POSTINGS).parquet(f"{at}/postings").groupBy("term").agg(F.sum("n").alias("df"))
        counts.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{at}/terms")
        n, tokens, last = self.spark.read.parquet(f"{at}/docs").agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.max("nth")).first()
        return {"id": name, "n": n, "tokens": tokens, "end": max(end, -1 if last is None else last) + 1}

    def _of(self, chunks: DataFrame, digits: int, size: int, first: int = 0) -> tuple[DataFrame, DataFrame]:
        """Postings and docs of chunks (chunk_id, context, text) with different ids and size characters, numbered from first on in each block."""
        listed = lambda c: terms(F.col(c), False)
        length = (F.size(listed("context")) + F.size(listed("text"))).cast("long")
        docs = row_hashes(chunks.select("chunk_id", "context", "text", length.alias("length")), "length")
        nth = F.row_number().over(W.partitionBy("block").orderBy("chunk_id")) + F.lit(first - 1)
        docs = docs.withColumn("block", self._block(digits)).withColumn("nth", nth)
        dealt = chunks.select(self._block(digits).alias("block"), "chunk_id", "context", "text").repartition(max(1, math.ceil(size / FILE_BYTES)), "block")
        lists = dealt.select("block", "chunk_id", listed("context").alias("c"), listed("text").alias("t"))
        return lists.groupBy("block").applyInArrow(_post(self.stemmed, first), _POSTINGS), docs

    @staticmethod
    def _one_by_id(chunks: DataFrame) -> DataFrame:
        """Of several rows with one id, the one with the largest hash."""
        return chunks.groupBy("chunk_id").agg(F.max_by(F.struct("context", "text"), F.xxhash64("context", "text")).alias("x")).select("chunk_id", "x.*")

    @staticmethod
    def _measured(chunks: DataFrame) -> tuple[int, int]:
        """Chunks and characters."""
        chars = F.sum(F.length(F.coalesce("context", F.lit(""))).cast("long") + F.length(F.coalesce("text", F.lit(""))))
        return tuple(chunks.agg(F.count(F.lit(1)), F.coalesce(chars, F.lit(0))).first())

    def build(self, chunks: DataFrame) -> None:
        """An index of chunks (chunk_id, context, text) alone, whatever was there before. Of several rows with one id, the one with the largest hash counts."""
        self.invalidate()
        if repeated_ids(chunks) is not None:
            chunks = self._one_by_id(chunks)
        n, size = self._measured(chunks)
        digits = min(MOST_DIGITS, max(1, round(math.log(max(1, n / BLOCK_CHUNKS), 16))))
        segment = self._segment(*self._of(chunks, digits, size))
        self._commit({"segments": [segment], "marks": [], "digits": digits}, self.spark.read.parquet(f"{self.path}/segments/{segment['id']}/docs"))

    def update(self, changed: DataFrame, gone: DataFrame | None = None) -> None:
        """changed chunks (chunk_id, context, text) are added, or stand in place of those with their ids; the chunks of gone (chunk_id) go.

        Only the changed texts are tokenised, and only what is new is written. Of several changed rows with one id, the
        one with the largest hash counts; an id that is gone and changed is changed.
        """
        version = self.version()
        new = self._one_by_id(changed)
        ids = new.select("chunk_id")
        if gone is not None:
            ids = ids.unionByName(gone.select("chunk_id")).distinct()
        lost = self.live_docs(version).join(ids, "chunk_id", "left_semi").select(*_CHUNK, "length")
        name = uuid.uuid4().hex
        lost.write.parquet(f"{self.path}/marks/{name}/chunks")
        lost = self.spark.read.parquet(f"{self.path}/marks/{name}/chunks")
        n, tokens = lost.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        marks = version["marks"]
        if n:
            less = self._gone(self._read(version, "postings").select("segment", "block", "term", "postings.nth"), lost).where("gone is not null")
            less = less.select("term", F.size(F.array_intersect("nth", "gone")).alias("df")).where("df > 0")
            less.groupBy("term").agg((-F.sum("df")).alias("df")).repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/marks/{name}/terms")
            marks = [*marks, {"id": name, "n": n, "tokens": tokens}]
        first = max(s["end"] for s in version["segments"])
        segment = self._segment(*self._of(new, version["digits"], self._measured(new)[1], first))
        version |= {"segments": [*version["segments"], *([segment] if segment["n"] else [])], "marks": marks}
        self._commit(version, self.live_docs(version))
        marked = sum(m["n"] for m in marks)
        if len(version["segments"]) > MOST_SEGMENTS or marked > MOST_MARKED * sum(s["n"] for s in version["segments"]):
            self.merge()

    @staticmethod
    def _gone(rows: DataFrame, marks: DataFrame) -> DataFrame:
        """rows (segment, block, ...) with the numbers of the block's chunks that are marked, `gone`, or null."""
        return rows.join(marks.groupBy("segment", "block").agg(F.collect_set("nth").alias("gone")), ["segment", "block"], "left")

    def merge(self) -> None:
        """One segment of all that is live."""
        version = self.version()
        rows, marks = self._read(version, "postings"), self._marks(version, "chunks")
        kept = F.col("postings") if marks is None else F.filter("postings", lambda x: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), x["nth"]))
        rows = (rows if marks is None else self._gone(rows, marks)).select("term", "block", kept.alias("postings")).where(F.size("postings") > 0)
        files = max(1, sum(s["tokens"] for s in version["segments"]) * 5 // FILE_BYTES)
        whole = rows.repartition(files, "block").groupBy("term", "block").agg(F.array_sort(F.flatten(F.collect_list("postings"))).alias("postings"))
        most = lambda c: F.array_max(F.transform("postings", lambda x: F.size(x[c]))).alias(f"most_{c}")
        whole = whole.select("term", "block", F.size("postings").alias("n"), most("context"), most("text"), F.array_min("postings.length").alias("least_length"), "postings")
        segment = self._segment(whole, self.live_docs(version), max(s["end"] for s in version["segments"]) - 1)
        self._commit(version | {"segments": [segment], "marks": []}, self.spark.read.parquet(f"{self.path}/segments/{segment['id']}/docs"))

    def fingerprint(self, chunks: DataFrame) -> DataFrame:
        return fingerprint(chunks, self.tokenize, self.weights)

    def is_stale(self, chunks: DataFrame) -> bool:
        return not self.built() or self.version()["fingerprint"] != self.fingerprint(chunks).first().asDict()

    # searches

    def _dfs(self, version: dict, wanted: list[str]) -> dict[str, int]:
        rows = self._read(version, "terms").drop("segment")
        less = self._marks({"marks": [m for m in version["marks"]]}, "terms")
        rows = rows if less is None else rows.unionByName(less)
        return {r.term: r.df for r in rows.where(F.col("term").isin(wanted)).groupBy("term").agg(F.sum("df").alias("df")).collect()}

    def _scored(self, rows: DataFrame, asked: DataFrame, average: float) -> DataFrame:
        """(segment, block, nth, score) of rows (phrase, segment, block, nth, length, context, text); parts are summed in the order of the query."""
        f = F.size("context") * self.weights[0] + F.size("text") * self.weights[1]
        parts = rows.join(F.broadcast(asked.withColumnRenamed("nth", "at")), "phrase").select(*_CHUNK, F.struct("at", (F.col("idf") * score_share(f, F.col("length"), average)).alias("part")).alias("x"))
        summed = parts.groupBy(*_CHUNK).agg(F.array_sort(F.collect_list("x")).alias("xs"))
        return summed.select(*_CHUNK, F.aggregate("xs", F.lit(0.0), lambda acc, x: acc + x["part"]).alias("score"))

    def search(self, text: str, top_k: int = 50, prune: bool = True) -> DataFrame:
        """(chunk_id, score), best first, ties by chunk_id. A word of the query with underscores is a phrase; a word given twice counts twice.

        With prune, a query of single terms first scores the chunks of the blocks with the highest bounds; the k-th
        score found there is one that the k-th best reaches at least, and blocks whose bound is lower are not read.
        `report` says how many. A query with a phrase reads its terms' postings whole.
        """
        if top_k < 0:
            raise ValueError("top_k is negative")
        version = self.version()
        phrases = [tuple(p) for p in query_phrases(text, self.stemmed)]
        n, tokens = self._size(version)
        self.report = Report()
        none = self.spark.createDataFrame([], "chunk_id string, score double")
        if not phrases or not top_k or not n or not tokens:
            return none
        average, named = tokens / n, " "
        single = sorted({p[0] for p in phrases if len(p) == 1})
        wanted = sorted({t for p in phrases for t in p})
        df = {(t,): k for t, k in self._dfs(version, wanted).items()}
        hits = self._hits(version, wanted)
        rows = hits.where(F.col("term").isin(single)).withColumn("phrase", F.col("term"))
        for p in sorted({p for p in phrases if len(p) > 1}):
            places = phrase_places(hits, list(p)).withColumn("phrase", F.lit(named.join(p)))
            df[p] = places.count()
            rows = rows.select("phrase", *_CHUNK, "length", "context", "text").unionByName(places.select("phrase", *_CHUNK, "length", "context", "text"))
        known = [(i, named.join(p), idf(n, df[p])) for i, p in enumerate(phrases) if df.get(p, 0) > 0]
        if not known:
            return none
        asked = self.spark.createDataFrame(known, "nth int, phrase string, idf double")
        if prune and all(len(p) == 1 for p in phrases):
            rows = self._pruned(version, rows, asked, average, top_k)
        scored = self._scored(rows, asked, average)
        least = scored.orderBy(F.desc("score")).limit(top_k).agg(F.min("score")).first()[0]
        if least is None:
            return none
        best = scored.where(F.col("score") >= least)
        few = best.count() <= FEW_CHUNKS
        docs = self._read(version, "docs").select(*_CHUNK, "chunk_id")
        named = docs.join(F.broadcast(best) if few else best, _CHUNK).select("chunk_id", "score")
        return named.orderBy(F.desc("score"), "chunk_id").limit(top_k)

    def _pruned(self, version: dict, rows: DataFrame, asked: DataFrame, average: float, top_k: int) -> DataFrame:
        """rows of the blocks that can hold one of the best top_k chunks."""
        most = F.col("most_context") * self.weights[0] + F.col("most_text") * self.weights[1]
        weight = asked.groupBy("phrase").agg(F.sum("idf").alias("idf"))
        single = [r.phrase for r in weight.collect()]
        held = self._read(version, "postings").drop("postings").where(F.col("term").isin(single)).join(F.broadcast(weight), F.col("term") == F.col("phrase"))
        bound = F.sum(F.col("idf") * score_share(most, F.col("least_length"), average)) * (1 + SLACK)
        # a row for each block of each segment: their number is bounded by 16**MOST_DIGITS for each of MOST_SEGMENTS
        bounds = held.groupBy("segment", "block").agg(bound.alias("bound"), F.max("n").alias("n")).orderBy(F.desc("bound"), "segment", "block").collect()
        marked = sum(m["n"] for m in version["marks"])
        # of each of the top_k best blocks, one chunk at least may come near its bound
        first, chunks = 0, 0
        while first < len(bounds) and (chunks < top_k + marked or first < top_k):
            chunks, first = chunks + bounds[first].n, first + 1
        self.report.blocks = len(bounds)
        kept = bounds
        while first < len(bounds):
            best = self._scored(self._within(rows, bounds[:first]), asked, average).orderBy(F.desc("score")).limit(top_k).collect()
            if len(best) == top_k:
                kept = [b for b in bounds if b.bound >= best[-1].score]
            if len(kept) <= 4 * first:
                break
            first *= 4  # marked chunks, or few of the best in each block, have left the score too low
        self.report.skipped = len(bounds) - len(kept)
        return self._within(rows, kept) if len(kept) < len(bounds) else rows

    def _within(self, rows: DataFrame, blocks: list) -> DataFrame:
        if len(blocks) > NAMED_BLOCKS:
            named = self.spark.createDataFrame([(b.segment, b.block) for b in blocks], "segment string, block int")
            return rows.join(F.broadcast(named), ["segment", "block"], "left_semi")
        by: dict[str, list[int]] = {}
        for b in blocks:
            by.setdefault(b.segment, []).append(b.block)
        return rows.where(reduce(lambda a, b: a | b, [(F.col("segment") == s) & F.col("block").isin(k) for s, k in by.items()]))
