"""Near-duplicate detection: BagMinHash signatures of word-shingle bags, banding, verified overlaps.

BagMinHash: each (shingle, weight interval) owns a Poisson process over REGISTERS registers, its
points drawn in ascending time from hashes of the pair, and a register keeps its earliest point.
Counts are discretised over the integers and split hierarchically into the intervals [0, 1),
[1, 2), [2, 4), [4, 8), ...; a point of a wide interval falls on one of its unit cells and counts
if that cell is below the shingle's count. Two bags agree in a register with a probability equal to
their weighted Jaccard similarity. Drawing stops for a shingle once its next point is later than
every register of its document, which keeps the work near the number of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, components, drop_scratch, free_shuffles, join_groups, join_spread, set_batches, write_scratch
from quillstone.llm.textops import U, mix, shingles, text_slices

WORDS, SIMILAR = 5, 0.8
#: At similarity 0.8, 24 bands of 4 registers miss a pair with probability 0.59**24 = 3e-6.
BANDS, BAND_ROWS = 24, 4
REGISTERS = BANDS * BAND_ROWS
#: Times that texts with too many shingles of their own are taken out of mixed buckets.
PEELINGS = 2
_ROW_BITS = 20
_HASH_BITS = 64 - _ROW_BITS
#: Pairs that are compared at once: their shingles are told apart by 56 bits of hash.
_PAIR_BITS = 8


def words_of(text: Column) -> Column:
    """The lower-case words with single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+", " "))


def bags(data: np.ndarray, offsets: np.ndarray, row_bits: int = _ROW_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle of 64 - row_bits bits) keys in ascending order, and their counts."""
    h, rows = shingles(data, offsets, WORDS)
    keys, counts = np.unique(rows.astype(np.uint64) << U(64 - row_bits) | h >> U(row_bits), return_counts=True)
    return keys, counts


def signatures(keys: np.ndarray, counts: np.ndarray, n_rows: int) -> np.ndarray:
    """BagMinHash registers (times of the earliest points) of each row; infinite for rows without shingles."""
    rows = (keys >> U(_HASH_BITS)).astype(np.int64)
    seeds = mix((keys & U((1 << _HASH_BITS) - 1)) + U(0x632BE59BD9B4E019))
    low = np.zeros(len(keys), np.int64)
    parts = [(rows, seeds, np.ones(len(keys)), low, counts)]
    level = 0
    more = np.flatnonzero(counts > 1)
    while len(more):  # the interval [2**level, 2**(level+1)) of each shingle with a larger count
        size = 1 << level
        parts.append((rows[more], mix(seeds[more] + U(level + 1)), np.full(len(more), float(size)), np.full(len(more), size), counts[more]))
        level += 1
        more = more[counts[more] > 1 << level]
    row, seed, rate, base, count = (np.concatenate(x) for x in zip(*parts))
    registers = np.full((n_rows, REGISTERS), np.inf)
    flat, latest = registers.reshape(-1), np.full(n_rows, np.inf)
    time, point = np.zeros(len(row)), 0
    while len(row):
        point += 1
        r = mix(seed + U(point * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log(((r >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (REGISTERS * rate)
        alive = time < latest[row]
        row, seed, rate, base, count, time, r = (x[alive] for x in (row, seed, rate, base, count, time, r))
        r = mix(r)
        cell = base + ((r >> U(32)) % rate.astype(np.uint64)).astype(np.int64)
        use = cell < count
        np.minimum.at(flat, row[use] * REGISTERS + ((r[use] & U(0xFFFFFFFF)) % U(REGISTERS)).astype(np.int64), time[use])
        latest = registers.max(axis=1)
        alive = time < latest[row]
        row, seed, rate, base, count, time = (x[alive] for x in (row, seed, rate, base, count, time))
    return registers


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in text_slices(batch.column(1)):
            keys, counts = bags(data, offsets)
            rows = pa.array((keys >> U(_HASH_BITS)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i).take(rows), pa.array((keys & U((1 << _HASH_BITS) - 1)).view(np.int64)), pa.array(counts.astype(np.int32))],
                names=["gid", "shingle", "n"],
            )


_SIGNED = "doc_id long, gid binary, size int, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in text_slices(batch.column(2)):
            keys, counts = bags(data, offsets)
            held = signatures(keys, counts, j - i).view(np.uint64).reshape(j - i, BANDS, BAND_ROWS)
            band = np.arange(BANDS, dtype=np.uint64)[None, :] * U(0xA0761D6478BD642F)
            for k in range(BAND_ROWS):
                band = mix(band ^ held[:, :, k])
            size = np.bincount((keys >> U(_HASH_BITS)).astype(np.int64), counts, j - i).astype(np.int32)
            some = size > 0
            ends = np.r_[0, np.cumsum(np.where(some, BANDS, 0))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(i, j - i) for k in (0, 1)), pa.array(size), pa.ListArray.from_arrays(pa.array(ends), pa.array(band[some].reshape(-1).view(np.int64)))],
                names=["doc_id", "gid", "size", "bands"],
            )


def overlap(one: pa.Array, two: pa.Array) -> np.ndarray:
    """The weighted Jaccard similarity of each of up to 2**_PAIR_BITS pairs of texts, from their whole bags of 56-bit shingle hashes."""
    out = []
    halves = [list(text_slices(x)) for x in (one, two)]
    n = len(one)
    sides = []
    for half in halves:
        keys, counts = [], []
        for i, _, data, offsets in half:
            k, c = bags(data, offsets, _PAIR_BITS)
            keys.append(k + (U(i) << U(64 - _PAIR_BITS)))
            counts.append(c)
        sides.append((np.concatenate(keys), np.concatenate(counts)))
    (ka, ca), (kb, cb) = sides
    both, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    row = lambda k: (k >> U(64 - _PAIR_BITS)).astype(np.int64)
    shared = np.bincount(row(both), np.minimum(ca[ia], cb[ib]), n)
    total = np.bincount(row(ka), ca, n) + np.bincount(row(kb), cb, n) - shared
    out = np.divide(shared, total, out=np.zeros(n), where=total > 0)
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1 << _PAIR_BITS):
            part = batch.slice(i, 1 << _PAIR_BITS)
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(overlap(part.column(2), part.column(3)))], names=["a", "b", "similarity"]
                )


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, class_id, class_size, n_links, kept.

    A class is a connected component of texts whose bags of lower-case 5-word shingles have a
    weighted Jaccard similarity of at least `similar` (texts of 1 to 4 words: one shingle of all
    words); class_id is its smallest id, kept marks the row with it. n_links counts the verified
    links of the row's text to different texts that the search drew to connect the class.

    Texts with equal words are one node from the start. Buckets of equal bands aren't expanded into
    pairs: a bucket's members are paired with its leader, the text that shares most buckets; members
    that still lie in several classes are paired with the leader of the bucket's largest other
    class, and after that all pairs of different classes that remain in a bucket are verified, so no
    link that could join two classes is left out. What keeps that few is an exact bound: shingles that
    no other text of the mixed buckets has can't be shared, so a text with too many of them has no
    link, and two texts share at most the smaller of what either has left.

    Buckets, classes and copies of one text may hold any share of the rows: what is known of them goes
    back to their rows by join_groups(). Null text counts as empty; rows without words stay alone each,
    with or without an id. Null ids are never a class_id unless no row of the class has another. Rows that repeat the id that stays
    are all kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    set_batches(spark)
    norm = words_of(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"))
    # a row without words is no node and links to nothing, whatever its id
    rows = rows.withColumn("gid", F.when(F.col("norm") != "", F.unhex(F.md5("norm"))))
    signed, _ = write_scratch(rows.select("doc_id", "gid", "norm").mapInArrow(_sign, _SIGNED), "minhash")
    n_rows = signed.count()
    nodes = signed.where("gid is not null").groupBy("gid").agg(F.min(F.struct("size", "bands")).alias("x"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    nodes, nodes_path = write_scratch(nodes.select("gid", "first_id", "copies", "x.size", "x.bands"), "minhash")
    free_shuffles(spark)
    banded = nodes.select("gid", "size", F.explode("bands").alias("band"))
    counted = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members, members_path = write_scratch(join_groups(banded, counted, ["band"], "n", BANDS * nodes.count(), how="inner"), "minhash")
    free_shuffles(spark)
    wanted = members.select("gid").distinct()
    texts, texts_path = write_scratch(rows.select("gid", "norm").join(wanted, "gid", "left_semi").groupBy("gid").agg(F.first("norm").alias("norm")), "minhash")
    scores = members.groupBy("gid").agg(F.sum("n").alias("score"))
    scored, scored_path = write_scratch(members.join(scores, "gid"), "minhash")
    drop_scratch(spark, members_path)
    n_scored = scored.count()
    best = lambda: F.max_by(F.struct("gid", "size", "most"), F.struct("score", "gid"))

    def sides(frame: DataFrame, other: str) -> DataFrame:
        return frame.select(
            F.col("gid").alias("a"), F.col("size").alias("sa"), F.col("most").alias("ma"),
            F.col(f"{other}.gid").alias("b"), F.col(f"{other}.size").alias("sb"), F.col(f"{other}.most").alias("mb"),
        )

    #: Two texts share at most the smaller of what either can share at all.
    shared = F.least("ma", "mb")
    within = shared >= similar * (F.col("sa") + F.col("sb") - shared)

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (a: any text, b: a leader) to links (a, b), each once; bags whose bounds are too low can't be similar.

        A leader has any number of pairs; its text goes once to so many of them, and theirs to it."""
        pairs, path = write_scratch(pairs.where(F.col("a") != F.col("b")).where(within).select("a", "b").distinct(), "minhash")
        paths.append(path)
        text = lambda gid, as_: texts.select(F.col("gid").alias(gid), F.col("norm").alias(as_))
        found = join_spread(join_spread(pairs, text("a", "ta"), "a", "b"), text("b", "tb"), "b", "a", pairs).select("a", "b", "ta", "tb")
        alike = found.mapInArrow(_verify, "a binary, b binary, similarity double").where(F.col("similarity") >= similar)
        return alike.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def kept_apart(placed: DataFrame) -> DataFrame:
        """Members of the buckets that hold several classes."""
        mixed = placed.groupBy("band").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("n")).where("r1 <> r2").select("band", "n")
        rows, path = write_scratch(join_groups(placed.drop("n"), mixed, ["band"], "n", n_scored, how="inner"), "minhash")
        paths.append(path)
        return rows

    def bounded(rows: DataFrame) -> DataFrame:
        """rows with `most`, the shingles that a text can share with any other text in rows: those that two
        of them have. A text that can share less than `similar` of its bag has no link and is dropped."""
        bag = texts.join(rows.select("gid").distinct(), "gid", "left_semi").mapInArrow(_bag_rows, "gid binary, shingle long, n int")
        alone = bag.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"), F.min("gid").alias("gid"), F.min("n").alias("n")).where("texts = 1")
        own = alone.groupBy("gid").agg(F.sum("n").alias("own"))
        rows = rows.drop("most").join(own, "gid", "left").withColumn("most", F.col("size") - F.coalesce("own", F.lit(0))).drop("own")
        return rows.where(F.col("most") >= similar * F.col("size"))

    paths: list[str] = []
    scored = scored.withColumn("most", F.col("size").cast("long"))
    leaders = scored.groupBy("band").agg(best().alias("leader"), F.first("n").alias("of"))
    links, links_path = write_scratch(verified(sides(join_groups(scored, leaders, ["band"], "of", n_scored, how="inner"), "leader")), "minhash")
    paths += [links_path, scored_path, texts_path, nodes_path]
    for step in ("leaders", "rest"):
        classes = components(links, "a", "b", "minhash")
        open_ = kept_apart(scored.join(classes.withColumnRenamed("node", "gid"), "gid", "left").withColumn("root", F.coalesce("root", "gid")))
        for _ in range(PEELINGS):
            open_ = open_ if open_.isEmpty() else kept_apart(bounded(open_))
        if open_.isEmpty():
            break
        if step == "leaders":
            by_class = open_.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), best().alias("leader"))
            top = by_class.groupBy("band").agg(F.max(F.struct("n", "root", "leader")).alias("top"), F.sum("n").alias("of"))
            pairs = sides(join_groups(open_, top, ["band"], "of", n_scored, how="inner").where(F.col("root") != F.col("top.root")), "top.leader")
        else:
            # a pair meets in every bucket that both are in, and counts in the one with the smallest key
            mine = open_.groupBy("gid").agg(F.collect_set("band").alias("bands"))
            full = open_.join(mine, "gid")
            one = full.select("band", F.col("gid").alias("a"), F.col("size").alias("sa"), F.col("most").alias("ma"), F.col("root").alias("ra"), F.col("bands").alias("ba"))
            two = full.select("band", F.col("gid").alias("b"), F.col("size").alias("sb"), F.col("most").alias("mb"), F.col("root").alias("rb"), F.col("bands").alias("bb"))
            first = F.array_min(F.array_intersect("ba", "bb")) == F.col("band")
            pairs = one.join(two, "band").where("ra < rb").where(within).where(first)
        more, more_path = write_scratch(verified(pairs), "minhash")
        paths.append(more_path)
        links = links.unionByName(more).distinct()
    degree = links.select(F.col("a").alias("gid")).unionByName(links.select(F.col("b").alias("gid"))).groupBy("gid").agg(F.count(F.lit(1)).alias("n_links"))
    placed = nodes.select("gid", "first_id", "copies").join(components(links, "a", "b", "minhash").withColumnRenamed("node", "gid"), "gid", "left").join(degree, "gid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "gid")).where("n_links > 0 or copies > 1")
    placed, placed_path = write_scratch(placed, "minhash")
    named = placed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("texts"))
    classed, _ = write_scratch(join_groups(placed, named, ["root"], "texts", placed.count()).select("gid", "copies", "class_id", "class_size", "n_links"), "minhash")
    drop_scratch(spark, placed_path, *paths)
    free_shuffles(spark)
    found = join_groups(signed.select("doc_id", "gid"), classed, ["gid"], "copies", n_rows, classed.count() <= BROADCAST_ROWS)
    single = F.col("class_size").isNull()
    found = found.withColumn("class_id", F.when(single, F.col("doc_id")).otherwise(F.col("class_id")))
    return found.select(
        "doc_id", "class_id", F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
    )
