"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import drop_scratch, write_scratch
from quillstone.llm.minhash import words_of

#: Fixed masks: 1 takes the token, 0 ignores it. Any WINDOW aligned tokens with at most SUBSTITUTED
#: differences leave all taken positions of one of the two equal somewhere (checked by the tests).
MASKS = ("11010111", "11110011")
SPAN = len(MASKS[0])
WINDOW, SUBSTITUTED = 13, 2
#: Fixed masks for items of SPAN to WINDOW - 1 tokens, laid on the first SPAN tokens: whichever single token
#: differs, one of the three ignores it (checked by the tests). Shorter items are joined as they are.
SHORT_MASKS = ("00011111", "11100011", "11111100")
SHORT_SUBSTITUTED = 1
#: Seeds of the benchmark, in rows, up to which they are broadcast (some 40 bytes each); beyond, both sides are shuffled.
BROADCAST_SEEDS = 1_000_000


#: Bits of the table of the benchmark's tokens with which documents' positions are screened before they are hashed:
#: 512 KB, whatever the benchmark. The fuller it is, the fewer positions it rules out; it never rules out a match.
SCREEN_BITS = 22
#: Positions of a text that one row of alignments covers.
BLOCK = 256
_NONE = "array<struct<seed:bigint,pos:int>>"


def _all_known(known: str, taken: list[int]) -> Callable[[Column], Column]:
    """Whether the benchmark has all tokens at those distances from a place."""

    def fits(i: Column) -> Column:
        found = F.get(known, i + taken[0])
        for k in taken[1:]:
            found = found & F.get(known, i + k)
        return found

    return fits


def _places(hashes: str, known: str | None) -> Column:
    """The positions where a mask fits and, if `known` says which tokens the benchmark has, all tokens are known that both masks take."""
    everywhere = F.sequence(F.lit(0), F.size(hashes) - SPAN)
    if known:
        shared = [k for k in range(SPAN) if all(m[k] == "1" for m in MASKS)]
        everywhere = F.filter(everywhere, _all_known(known, shared))
    return F.when(F.size(hashes) >= SPAN, everywhere).otherwise(F.array().cast("array<int>"))


def _seeds(hashes: str, known: str | None = None) -> Column:
    """(seed, pos) for each mask at each place of an array of token hashes."""

    def both(i: Column) -> Column:
        made = []
        for number, mask in enumerate(MASKS):
            taken = [F.get(hashes, i + k) for k, bit in enumerate(mask) if bit == "1"]
            made.append(F.struct(F.xxhash64(F.lit(number), *taken).alias("seed"), i.alias("pos")))
        return F.array(*made)

    return F.flatten(F.transform(_places(hashes, known), both)).cast(_NONE)


def _short_seed(hashes: str, number: int, taken: list[int]) -> Callable[[Column], Column]:
    return lambda i: F.struct(F.xxhash64(F.lit(number), *[F.get(hashes, i + k) for k in taken]).alias("seed"), i.cast("int").alias("pos"))


def _short_seeds(hashes: str, known: str | None = None) -> Column:
    """(seed, pos) for each of SHORT_MASKS: of an item at its start, of a text (`known` given) wherever the benchmark has all tokens that the mask takes."""
    made = []
    for number, mask in enumerate(SHORT_MASKS, len(MASKS)):
        taken = [k for k, bit in enumerate(mask) if bit == "1"]
        places = F.filter(F.sequence(F.lit(0), F.size(hashes) - SPAN), _all_known(known, taken)) if known else F.array(F.lit(0))
        made.append(F.transform(places, _short_seed(hashes, number, taken)))
    return F.when(F.size(hashes) >= SPAN, F.concat(*made)).otherwise(F.array().cast(_NONE)).cast(_NONE)


def tolerance(n: Column) -> Column:
    """Tokens that may differ in the best window of an item of n tokens."""
    return F.when(n >= WINDOW, SUBSTITUTED).when(n >= SPAN, SHORT_SUBSTITUTED).otherwise(0)


def _tokens(norm: Column) -> Column:
    return F.split(norm, " ")


def _screen(tokens: DataFrame) -> DataFrame:
    """One row: the bits of the hashes of all tokens, in 2**(SCREEN_BITS - 6) longs."""
    at = F.shiftrightunsigned("h", 64 - SCREEN_BITS)
    words = tokens.select(F.explode("hashes").alias("h")).distinct()
    words = words.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - SCREEN_BITS}) & 63 as int))")).alias("bits"))
    everywhere = tokens.sparkSession.range(1 << SCREEN_BITS - 6).select(F.col("id").cast("int").alias("word"))
    filled = everywhere.join(words, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")).alias("x"))
    return filled.agg(F.sort_array(F.collect_list("x")).alias("x")).select(F.col("x.bits").alias("screen"))


def _whole(rows: DataFrame, items: DataFrame, length: int, screen: Column, shown: Callable[[Column], Column], broadcast_rows: int) -> DataFrame:
    """The rows of contaminated() for items of `length` tokens, all of which must follow one another in a text. The words
    themselves are joined, each run of them once for each text, so there is nothing to verify."""
    phrase = lambda t, i: F.array_join(F.slice(t, i + 1, length), " ")
    texts = rows.select("doc_id", _tokens(F.col("norm")).alias("d")).withColumn("screen", screen)
    texts = texts.select("doc_id", "d", F.transform("d", lambda x: shown(F.xxhash64(x))).alias("known"))

    places = F.when(F.size("d") >= length, F.filter(F.sequence(F.lit(0), F.size("d") - length), _all_known("known", list(range(length)))))
    texts = texts.select("doc_id", "d", places.alias("places")).where(F.size("places") > 0)
    found = texts.select("doc_id", F.explode(F.array_distinct(F.transform("places", lambda i: phrase("d", i)))).alias("phrase"))
    wanted = items.select("item_id", F.array_join("t", " ").alias("phrase"))
    few = wanted.limit(broadcast_rows + 1).count() <= broadcast_rows
    n = F.lit(length).cast("long")
    return found.join(F.broadcast(wanted) if few else wanted, "phrase").select("doc_id", "item_id", n.alias("window_matches"), n.alias("matched"), n.alias("item_tokens")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """A row (doc_id, item_id, window_matches, matched, item_tokens) for each document and item that overlap.

    Tokens are lower-case words between white space. A document overlaps an item if WINDOW aligned
    tokens differ in at most SUBSTITUTED places. Of an item of SPAN to WINDOW - 1 tokens all are
    aligned and SHORT_SUBSTITUTED may differ; an item of fewer tokens must occur word for word. Items without
    tokens match nothing. window_matches is the best window's number of equal tokens, matched that
    of the whole alignment; whoever finds very short items too common can choose by item_tokens.

    Masked hashes of test and training tokens are joined; the alignments hit are then compared token
    by token, so hash collisions add nothing. What is compared is the part of the text that lies
    beside the item, cut from blocks of BLOCK tokens, so that a long or repetitive text costs as many
    rows as it has alignments, each as long as the item. Documents (doc_id, text) and benchmark
    (item_id, text): null texts are empty, other columns are ignored, repeated rows give one row, a
    null id stands for all rows without id.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", words_of(F.col("text")).alias("norm")).where("norm <> ''").distinct()
    tokens = items.select("item_id", _tokens(F.col("norm")).alias("t"), F.transform(_tokens(F.col("norm")), lambda x: F.xxhash64(x)).alias("hashes"))
    n = F.size("t")
    middling = (n >= SPAN) & (n < WINDOW)
    longest, short, lengths = tokens.agg(F.max(n), F.max(middling), F.sort_array(F.collect_set(F.when(n < SPAN, n)))).first()
    longest = longest or 0
    made = F.when(n >= WINDOW, _seeds("hashes")).when(middling, _short_seeds("hashes"))
    seeds = tokens.select("item_id", F.inline(made)).select("item_id", F.col("seed").alias("item_seed"), F.col("pos").alias("item_pos"))
    seeds, seeds_path = write_scratch(seeds, "seeds")
    small = seeds.limit(broadcast_seeds + 1).count() <= broadcast_seeds
    rows = docs.select("doc_id", words_of(F.col("text")).alias("norm")).withColumn("key", F.xxhash64("doc_id", "norm"))
    hashed = rows.select("key", F.transform(_tokens(F.col("norm")), lambda x: F.xxhash64(x)).alias("hashes"))
    screen = _screen(tokens).scalar()
    top = 64 - SCREEN_BITS

    def shown(h: Column) -> Column:
        word = F.get(F.col("screen"), F.shiftrightunsigned(h, top + 6).cast("int"))
        return F.getbit(word, F.shiftrightunsigned(h, top).bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

    found = hashed.withColumn("screen", screen).select("key", "hashes", F.transform("hashes", shown).alias("known"))
    found = found.select("key", F.inline(F.concat(_seeds("hashes", "known"), _short_seeds("hashes", "known")) if short else _seeds("hashes", "known")))
    hits, hits_path = write_scratch(
        found.join(F.broadcast(seeds) if small else seeds, F.col("seed") == F.col("item_seed"))
        .select("key", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .distinct(),
        "hits",
    )
    # a block of a text holds what lies beside the items that start in it or, in the first one, before it
    block = lambda at: F.floor(F.greatest(at, F.lit(0)) / BLOCK).cast("int")
    texts = rows.join(hits.select("key").distinct(), "key", "left_semi").distinct().withColumn("d", _tokens(F.col("norm")))
    blocks = texts.select("doc_id", "key", "d", F.explode(F.sequence(F.lit(0), block(F.size("d") - 1))).alias("block"))
    blocks = blocks.select("doc_id", F.col("key").alias("k"), F.col("block").alias("b"), F.slice("d", F.col("block") * BLOCK + 1, BLOCK + longest).alias("d"))
    placed = hits.withColumn("block", block(F.col("shift"))).join(
        tokens.select(F.col("item_id").alias("i"), "t"), F.col("item_id").eqNullSafe(F.col("i"))
    )
    aligned = placed.join(blocks, (F.col("key") == F.col("k")) & (F.col("block") == F.col("b")))
    low = F.greatest(F.lit(0), -F.col("shift"))
    # slices, so that each side is cut once and not again for every token
    ours = F.slice("d", F.col("shift") + low - F.col("block") * BLOCK + 1, F.size("t") - low)
    theirs = F.slice("t", low + 1, F.size(ours))
    equal = F.zip_with(ours, theirs, lambda a, b: (a == b).cast("int"))
    width = F.least(F.lit(WINDOW), F.size("t"))
    add = lambda a, x: a + x
    best = F.array_max(
        F.transform(F.sequence(F.lit(0), F.size("equal") - F.col("width")), lambda j: F.aggregate(F.slice("equal", j + 1, F.col("width")), F.lit(0), add))
    )
    need = F.col("width") - tolerance(F.col("width"))
    judged = (
        aligned.where(F.size("t") > low)
        .select("doc_id", "item_id", F.size("t").alias("item_tokens"), equal.alias("equal"), width.alias("width"))
        .where(F.size("equal") >= F.col("width"))
        .select("doc_id", "item_id", "item_tokens", best.alias("best"), need.alias("need"), F.aggregate("equal", F.lit(0), add).alias("matched"))
        .where(F.col("best") >= F.col("need"))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("best").cast("long").alias("window_matches"),
            F.max("matched").cast("long").alias("matched"),
            F.max("item_tokens").cast("long").alias("item_tokens"),
        )
    )
    for length in lengths:
        judged = judged.unionByName(_whole(rows, tokens.where(n == length), length, screen, shown, broadcast_seeds))
    result, _ = write_scratch(judged, "overlaps")
    drop_scratch(spark, seeds_path, hits_path)
    return result
