"""Removal of long byte strings that occur earlier, over a sparse suffix array.

Every window of MATCH bytes picks its smallest GRAM-byte substring (by hash) as its anchor, so two
equal windows have anchors at the same offset, and only suffixes at anchors need sorting: about one
for every 39 bytes. Hashes only choose anchors and candidates; what is removed is decided by bytes.

1. `_anchors`, `_candidates`: anchors whose surroundings or one side of them seem to occur again. Those whose leading
   bytes are common in a sample are all taken.
2. `_contexts`: the candidates' suffixes (MATCH bytes) and what stands before them (LEFT bytes). Equal
   ones within a batch are settled there, so that a common passage is not one key's rows.
3. Sampled splitters range-partition the suffixes by their leading GRAM bytes, so that suffixes that can
   share a window meet in one bucket and none reaches across a boundary between buckets.
4. `_resolve`: each bucket is sorted by multikey quicksort, forwards from the anchors and backwards.
   Longest common prefixes of neighbours number the classes of equal strings of every length; a window
   is a pair of such classes. A group of more than GROUP_ROWS suffixes with equal leading bytes goes window
   by window through a shuffled aggregation of the windows' bytes.
5. `_cut`: spans are merged and cut for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, HOT_KEYS, drop_scratch, free_shuffles, set_batches, write_scratch
from quillstone.llm.textops import SLICE_BYTES, U, mix, prefix_hash, span_hash, text_slices

MATCH, GRAM = 100, 24
LEFT = MATCH - GRAM  # an anchor's largest offset in a window
#: Of a left and a right part that add up to MATCH, one reaches LONG_LEFT or LONG_RIGHT.
LONG_RIGHT, LONG_LEFT = 62, 39
#: Rows of a group that one task compares; larger groups are resolved window by window.
GROUP_ROWS = 50_000
#: Suffixes that are sorted and compared at once, but for groups that are larger, and segments that are sorted directly.
BLOCK_ROWS, SEGMENT_ROWS = 20_000, 2_048

_rng = np.random.default_rng(77)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = (1 << 63) - 1


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over each run of `width` values."""
    span = 1
    while span * 2 <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    return op(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def find_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, position in data, h, c and the two side hashes of each anchor."""
    n = len(data)
    long = np.diff(offsets) >= MATCH
    if n < MATCH or not long.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    c1, c2 = prefix_hash(data), prefix_hash(data, _TABLE, _BASE)
    at = np.arange(n - GRAM + 1)
    h = mix(span_hash(c1, at, at + GRAM)) | U(1)
    least = _slide(h, LEFT + 1, np.minimum)
    step = np.zeros(n + 1, np.int8)
    step[offsets[:-1][long]] += 1
    step[offsets[1:][long] - MATCH + 1] -= 1
    least[np.cumsum(step[: len(least)], dtype=np.int8) <= 0] = 0  # windows that would cross documents
    most = _slide(np.r_[np.zeros(LEFT, np.uint64), least, np.zeros(LEFT, np.uint64)], LEFT + 1, np.maximum)
    p = np.flatnonzero(most == h)
    row = np.searchsorted(offsets, p, "right") - 1
    left, right = np.minimum(LEFT, p - offsets[row]), np.minimum(MATCH, offsets[row + 1] - p)
    c = mix(span_hash(c2, p - left, p + right, _INVERSE) + mix((left * 128 + right).astype(np.uint64)))
    far, near = np.minimum(LONG_RIGHT, right), np.minimum(LONG_LEFT, left)
    side_r = np.where(right >= LONG_RIGHT, (mix(span_hash(c2, p, p + far, _INVERSE)) >> U(49)).astype(np.int64) + 1, 0)
    side_l = np.where(left >= LONG_LEFT, (mix(span_hash(c2, p - near, p + GRAM, _INVERSE)) >> U(49)).astype(np.int64) + 1, 0)
    return row, p, h[p], c, side_r << 16 | side_l


#: kind: 0 may have a partner, 1 has one in its slice, 2 is the first of several in its slice.
_ANCHOR = "kind byte, h long, c long, doc long, tie long, pos int, sides int"
#: One in so many documents tells which leading bytes are so common that their anchors don't fit one task.
SAMPLED = 64


def _pieces(column) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, int]]:
    """Slices of whole rows, and overlapping parts of longer rows: (data, offsets, first row, shift, core start)."""
    for i, j, data, offsets in text_slices(column):
        if len(data) <= SLICE_BYTES:
            yield data, offsets, i, 0, 0
        else:
            for a in range(0, len(data), SLICE_BYTES):
                lo, hi = max(0, a - LEFT), min(len(data), a + SLICE_BYTES + MATCH)
                yield data[lo:hi], np.array([0, hi - lo]), i, lo, a - lo


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for data, offsets, first, shift, core in _pieces(batch.column(2)):
            row, p, h, c, sides = find_anchors(data, offsets)
            if shift or len(data) > SLICE_BYTES:
                keep = (p >= core) & (p < core + SLICE_BYTES)
                row, p, h, c, sides = (x[keep] for x in (row, p, h, c, sides))
            doc, tie, pos = docs[first + row], ties[first + row], p - offsets[row] + shift
            # of equal surroundings within the slice only the first is compared with others, so that a common passage is not one key's rows
            order = np.lexsort((pos, tie, doc, mix(h) ^ c))
            h, c, doc, tie, pos, sides = (x[order] for x in (h, c, doc, tie, pos, sides))
            same = np.r_[False, (h[1:] == h[:-1]) & (c[1:] == c[:-1])] if len(h) else np.zeros(0, bool)
            kind = same.astype(np.int8)
            kind[:-1][same[1:] & ~same[:-1]] = 2
            spread = mix((doc * 1_000_003 + pos).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kind),
                    pa.array(np.where(same, spread, h).view(np.int64)),
                    pa.array(np.where(same, U(0), c).view(np.int64)),
                    pa.array(doc),
                    pa.array(tie),
                    pa.array(pos.astype(np.int32)),
                    pa.array(sides.astype(np.int32)),
                ],
                names=["kind", "h", "c", "doc", "tie", "pos", "sides"],
            )


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, bool]]:
    """Runs of whole groups of a sorted partition, and whether a run is the last one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1], "left"))
        if held and held[0].column(key)[0].as_py() != values[-1] or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]), False
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held), True


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that share h and c with another one, or h and enough bytes on one side, or whose h is common."""
    for t, _ in _groups(batches, "h"):
        order = np.lexsort((t["c"].to_numpy(), t["h"].to_numpy()))
        kind, h, c, doc, tie, pos, sides = (t[k].to_numpy()[order] for k in ("kind", "h", "c", "doc", "tie", "pos", "sides"))
        apart = kind == 1
        same = np.r_[False, (h[1:] == h[:-1]) & (c[1:] == c[:-1])] & ~apart
        chosen = same | (kind > 0)
        chosen[:-1] |= same[1:]
        chosen |= t["common"].to_numpy(zero_copy_only=False)[order].astype(bool)
        first = np.flatnonzero(~same & ~apart)
        for part in (sides >> 16, sides & 0xFFFF):
            use = first[part[first] > 0]
            key = mix(h[use].view(np.uint64) ^ mix(part[use].astype(np.uint64)))
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            chosen[use[count[back] > 1]] = True
        keep = np.flatnonzero(chosen)
        yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(tie[keep]), pa.array(pos[keep])], names=["doc", "tie", "pos"])


#: A suffix with what stands before it (around: LEFT bytes before, MATCH bytes from the
#: anchor, zeros beyond the text; sides: 128 times the bytes before that the text has, and those from the anchor), or a span to remove.
_CONTEXT = "around binary, sides int, doc long, tie long, pos int, lo int, hi int"


def _context_batch(around, sides, doc, tie, pos, lo, hi) -> pa.RecordBatch:
    data = pa.array([None] * len(doc), pa.binary()) if around is None else _binary(around)
    return pa.RecordBatch.from_arrays(
        [data, *(pa.array(np.asarray(x).astype(k)) for x, k in ((sides, np.int32), (doc, np.int64), (tie, np.int64), (pos, np.int32), (lo, np.int32), (hi, np.int32)))],
        names=["around", "sides", "doc", "tie", "pos", "lo", "hi"],
    )


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    ends = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(rows))])


def _rows(column, width: int) -> np.ndarray:
    """The bytes of a binary column of values of one width, a row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of each candidate; of equal ones in a batch, the first stays and the others are spans."""
    at = np.arange(-LEFT, MATCH)
    for batch in batches:
        held = []
        for doc, tie, text, found in zip(*(batch.column(k) for k in range(4))):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            places = np.unique(found.values.to_numpy())
            for k in range(0, len(places), BLOCK_ROWS):
                pos = places[k : k + BLOCK_ROWS, None].astype(np.int64)
                inside = (pos + at >= 0) & (pos + at < len(raw))
                around = np.where(inside, raw[np.clip(pos + at, 0, len(raw) - 1)], 0).astype(np.uint8)
                p = pos[:, 0]
                held.append((around, np.minimum(LEFT, p), np.minimum(MATCH, len(raw) - p), np.full(len(p), doc.as_py()), np.full(len(p), tie.as_py()), p))
            if sum(len(x[0]) for x in held) > BLOCK_ROWS:
                yield from _collapse(held)
                held = []
        yield from _collapse(held)


def _collapse(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    around, lefts, rights, doc, tie, pos = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((pos, tie, doc))
    around, lefts, rights, doc, tie, pos = (x[order] for x in (around, lefts, rights, doc, tie, pos))
    sides = lefts * 128 + rights
    words = np.concatenate([_words(around), sides.astype(np.uint64)[:, None]], axis=1)
    order = multikey_quicksort(words)
    same = np.r_[False, (words[order][1:] == words[order][:-1]).all(axis=1)]
    # stable, so a run's first row is the first of its equals; a row that is there twice is no copy of itself
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    again = same & ((doc[order] != doc[lead]) | (tie[order] != tie[lead]) | (pos[order] != pos[lead]))
    one, two = order[~same], order[again]
    yield _context_batch(around[one], sides[one], doc[one], tie[one], pos[one], np.zeros(len(one)), np.zeros(len(one)))
    yield _context_batch(None, sides[two], doc[two], tie[two], pos[two], pos[two] - lefts[two], pos[two] + rights[two])


def _words(rows: np.ndarray) -> np.ndarray:
    """Bytes as 64-bit numbers that sort as the bytes do."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The stable order of rows of words: each segment is divided into smaller, equal and larger ones by a
    pivot's word at its depth, and the equal ones go on at the next depth; small segments are sorted directly."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        rows = order[lo:hi]
        if hi - lo <= SEGMENT_ROWS:
            if hi - lo > 1 and depth < words.shape[1]:
                order[lo:hi] = rows[np.lexsort(words[rows, depth:].T[::-1])]
            continue
        if depth == words.shape[1]:
            continue
        key = words[rows, depth]
        pivot = np.sort(key[:: max(1, len(key) // 31)])[16 if len(key) > 31 else 0]
        less, more = key < pivot, key > pivot
        equal = ~(less | more)
        order[lo:hi] = np.concatenate([rows[less], rows[equal], rows[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


class _Classes:
    """Numbers of equal strings: rows have the same number at length n if their first n bytes are equal."""

    def __init__(self, rows: np.ndarray):
        self.order = multikey_quicksort(_words(rows))
        differ = rows[self.order][1:] != rows[self.order][:-1]
        self.shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        #: How many first bytes each row shares with any other one: with one of its neighbours in the order.
        self.most = np.zeros(len(self.order), np.int64)
        self.most[self.order] = np.maximum(np.r_[0, self.shared], np.r_[self.shared, 0])

    def at(self, n: int) -> np.ndarray:
        out = np.zeros(len(self.order), np.int64)
        out[self.order[1:]] = np.cumsum(self.shared < n)
        return out


def _ordered(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Surroundings, lengths and places in the order (doc, tie, pos), each place once."""
    doc, tie, pos, sides = (t[k].to_numpy() for k in ("doc", "tie", "pos", "sides"))
    order = np.lexsort((pos, tie, doc))
    new = np.r_[True, (np.diff(doc[order]) != 0) | (np.diff(tie[order]) != 0) | (np.diff(pos[order]) != 0)]
    order = order[new]
    return _rows(t["around"], LEFT + MATCH)[order], *(x[order] for x in (sides >> 7, sides & 127, doc, tie, pos))


_SPAN = "doc long, tie long, lo int, hi int"


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for whole, last in _groups(batches, "lead"):
        held.append(whole)
        if last or sum(map(len, held)) > BLOCK_ROWS:
            yield _compare(pa.concat_tables(held))
            held = []


def _compare(t: pa.Table) -> pa.RecordBatch:
    """The spans of the windows of whole groups that stand earlier in their group."""
    around, lefts, rights, doc, tie, pos = _ordered(t)
    after, before = _Classes(around[:, LEFT:]), _Classes(around[:, :LEFT][:, ::-1])
    # no window of a row has more bytes in common than its sides have with any other row
    left, right = np.minimum(lefts, before.most), np.minimum(rights, after.most)
    lo, hi = np.full(len(pos), -1, np.int64), np.full(len(pos), LEFT + 1, np.int64)
    for o in range(LEFT + 1):
        rows = np.flatnonzero((left >= o) & (right >= MATCH - o))
        if not len(rows):
            continue
        key = before.at(o)[rows] * len(pos) + after.at(MATCH - o)[rows]
        order = np.argsort(key, kind="stable")
        later = rows[order[1:][key[order[1:]] == key[order[:-1]]]]
        lo[later] = o
        hi[later] = np.minimum(hi[later], o)
    hit = np.flatnonzero(lo >= 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[hit]), pa.array(tie[hit]), pa.array((pos[hit] - lo[hit]).astype(np.int32)), pa.array((pos[hit] + MATCH - hi[hit]).astype(np.int32))],
        names=["doc", "tie", "lo", "hi"],
    )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a hot group, whole."""
    for batch in batches:
        if batch.num_rows:
            around, lefts, rights, doc, tie, pos = _ordered(pa.Table.from_batches([batch]))
            for o in range(LEFT + 1):
                rows = np.flatnonzero((lefts >= o) & (rights >= MATCH - o))
                yield pa.RecordBatch.from_arrays(
                    [_binary(around[rows, LEFT - o : LEFT - o + MATCH]), pa.array(doc[rows]), pa.array(tie[rows]), pa.array((pos[rows] - o).astype(np.int32))],
                    names=["w", "doc", "tie", "start"],
                )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(k) for k in range(3))):
            raw, spans = text.as_py().encode(), spans.as_py()
            merged: list[list[int]] = []
            for s in sorted((x["lo"], min(x["hi"], len(raw))) for x in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            kept = hashlib.sha256()
            at = removed = 0
            for lo, hi in merged:
                kept.update(raw[at:lo])
                removed, at = removed + hi - lo, hi
            kept.update(raw[at:])
            out.append((doc.as_py(), len(raw), removed, len(merged), kept.hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )


def repeated_spans(docs: DataFrame, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """The documents (doc, tie, text, doc_id) and the spans (doc, tie, lo, hi) of their bytes to remove."""
    spark = docs.sparkSession
    set_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    # only where an id stands for different texts its rows are told apart by the hash of their texts
    shared = docs.select(doc.alias("doc"), F.xxhash64(text).alias("t")).groupBy("doc").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    several = not shared.where(f"a <> b and doc <> {_LAST}").isEmpty()
    tie = F.xxhash64(text) if several else F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.lit(0))
    rows = docs.select(doc.alias("doc"), tie.cast("long").alias("tie"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    anchors = rows.select("doc", "tie", "text").mapInArrow(_anchors, _ANCHOR)
    sample = rows.where(F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(SAMPLED)) == 0).select("doc", "tie", "text").mapInArrow(_anchors, _ANCHOR).where("kind <> 1")
    counts, counts_path = write_scratch(sample.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "suffix")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = F.broadcast(counts.where((F.col("n") > 1) & (F.col("n") * HOT_KEYS > total)).select("h", F.lit(True).alias("common")))
    # anchors of a common h are candidates whatever else there is, and are dealt out evenly, also those of one passage with equal surroundings
    dealt = anchors.join(common, "h", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    dealt = dealt.repartition("h", F.when(F.col("common"), F.xxhash64("doc", "tie", "pos")).otherwise(0)).sortWithinPartitions("h")
    found, found_path = write_scratch(dealt.mapInArrow(_candidates, "doc long, tie long, pos int"), "suffix")
    drop_scratch(spark, counts_path)
    free_shuffles(spark)
    some = found.groupBy("doc", "tie").agg(F.collect_list("pos").alias("found"))
    contexts, contexts_path = write_scratch(rows.select("doc", "tie", "text").join(some, ["doc", "tie"]).mapInArrow(_contexts, _CONTEXT), "suffix", "zstd")
    drop_scratch(spark, found_path)
    free_shuffles(spark)
    suffixes = contexts.where("around is not null").drop("lo", "hi")
    lead = F.substring("around", LEFT + 1, GRAM)
    hot, hot_path = write_scratch(suffixes.groupBy(lead.alias("lead")).count().where(F.col("count") > group_rows).select("lead"), "suffix")
    few = hot.count()
    listed = F.broadcast(hot) if few <= BROADCAST_ROWS else hot
    usual = suffixes.join(listed, lead == F.col("lead"), "left_anti") if few else suffixes
    usual = usual.repartitionByRange(lead).sortWithinPartitions(lead).withColumn("lead", lead)
    spans = contexts.where("around is null").select("doc", "tie", "lo", "hi").unionByName(usual.mapInArrow(_resolve, _SPAN))
    if few:
        windows, windows_path = write_scratch(suffixes.join(listed, lead == F.col("lead"), "left_semi").mapInArrow(_window_rows, "w binary, doc long, tie long, start int"), "suffix")
        first = windows.groupBy("w").agg(F.min(F.struct("doc", "tie", "start")).alias("x")).select("x.*")
        later = windows.select("doc", "tie", "start").distinct().join(first.distinct(), ["doc", "tie", "start"], "left_anti")
        spans = spans.unionByName(later.select("doc", "tie", F.col("start").alias("lo"), (F.col("start") + MATCH).alias("hi")))
    spans, spans_path = write_scratch(spans, "suffix")
    drop_scratch(spark, contexts_path, hot_path, *([windows_path] if few else []))
    free_shuffles(spark)
    return rows, spans


def remove_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a MATCH-byte string covers it that also starts earlier: in a smaller doc_id or
    earlier in the same document. Null text is empty. Rows that repeat an id and its text are one
    document; rows that repeat an id with other texts are documents of their own, in the order of a
    hash of their texts, and so are rows without id, which come last. Other columns are ignored.
    """
    rows, spans = repeated_spans(docs, group_rows)
    merged = spans.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return (
        rows.join(merged, ["doc", "tie"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
