"""Spelling variants: words that are one edit apart, found by merging the light subtrees of a trie.

All words form a trie. In each of its nodes the heaviest child (most words) carries the heavy path on,
the other children are light; a word leaves heavy paths at most log2(number of words) times, since
each time at least half of the words stay behind. Two words that are one edit apart go different ways
in the node where they first differ, so one of them goes a light way there. It is therefore enough to
merge light subtrees, each word at each node where it leaves the heavy path:

- replaced: its character there becomes the heavy one. Words whose merged terminals coincide with one
  another or with a word differ in that character alone;
- skipped: the character is left out. A word at the merged terminal is one deletion away (only at the
  last of a run of equal characters, which is where the two words first differ);
- put in: the heavy character is put before it, which is the heavy subtree with that character
  skipped, seen from the light side. A word at the merged terminal is one insertion away.

So a pair is met in one node and one way only, and the merges have at most three terminals for each word
and light step. Nodes are 64-bit hashes of prefixes: if two of them coincide, both get the same heavy
character, which costs time but loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, drop_scratch, free_shuffles, join_groups, set_batches, write_scratch
from quillstone.llm.line_dedup import lower_ascii
from quillstone.llm.textops import mix, prefix_hash, span_hash

LEAST_LENGTH, LEAST_COUNT, RATIO, SLIP = 5, 3, 2, 97
#: Fixed value: the characters of a word.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Letters whose trie steps are made at once.
STEP_LETTERS = 1 << 20


def slipped(doc_id: Column, word: Column, slip: int) -> Column:
    """word, without one character if `slip` divides the CRC-32 of `<doc_id>:<word>`; which one the same number says."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % slip == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int | None = None) -> DataFrame:
    """(word, n): runs of LETTERS in all texts of docs (doc_id, text), A-Z lower-cased, of at least so many code points and occurrences.

    slip: see slipped(); None leaves the words as they are. Null texts have no words; null ids count as an empty one.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    found = found.where(F.char_length("run") >= least_length).select("doc_id", lower_ascii(F.col("run")).alias("word"))
    if slip:
        found = found.select(slipped(F.col("doc_id"), F.col("word"), slip).alias("word")).where(F.char_length("word") >= least_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each node on a word's way: the word's id, depth, node, and the character that it takes (0: it ends)."""
    for batch in batches:
        words = [w.encode("latin-1") + b"\0" for w in batch.column(1).to_pylist()]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        i = 0
        while i < len(words):
            done = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + STEP_LETTERS, "right")))
            data = np.frombuffer(b"".join(words[i:j]), np.uint8)
            size = sizes[i:j]
            start = np.repeat(np.cumsum(size) - size, size)
            at = np.arange(len(data))
            node = mix(span_hash(prefix_hash(data), start, at) + (at - start).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i).take(pa.array(np.repeat(np.arange(j - i), size))), pa.array((at - start).astype(np.int32)), pa.array(node.view(np.int64)), pa.array(data.astype(np.int32))],
                names=["id", "d", "node", "step"],
            )
            i = j


def _merged(light: DataFrame) -> DataFrame:
    """The terminals of each word's light steps: kind (replaced, or one edit of length), d, target, word, n."""
    word, d, heavy = F.col("word"), F.col("d"), F.expr("char(heavy)")
    before = F.substring(word, F.lit(1), d)
    rest = lambda k: F.substring(word, d + 1 + k, F.char_length(word))
    goes = F.col("step") != 0
    last = F.substring(word, d + 1, F.lit(1)) != F.substring(word, d + 2, F.lit(1))
    end = lambda kind, here, target: F.when(here, F.struct(F.lit(kind).alias("kind"), target.alias("target")))
    ends = F.array(
        end("replaced", goes, F.concat(before, heavy, rest(1))), end("length", goes & last, F.concat(before, rest(1))), end("length", F.lit(True), F.concat(before, heavy, rest(0)))
    )
    return light.select("word", "n", "d", F.explode(ends).alias("e")).where("e is not null").select("e.kind", "d", "e.target", "word", "n")


def near_words(words: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (id, word, n: id names the word) that have others one edit apart: how many, and the one with the largest n (ties: the smallest in code-point order).

    The nodes near the root hold any share of the words and go back to them by join_groups(). Words that
    meet by a replaced character are a group of at most one word for each letter; each of them gets the group's
    size and its best other member, no pairs.
    """
    spark = words.sparkSession
    set_batches(spark)
    steps, steps_path = write_scratch(words.select("id", "word").mapInArrow(_steps, "id long, d int, node long, step int"), "trie")
    fans = steps.groupBy("node", "step").agg(F.count(F.lit(1)).alias("n"))
    # the end of a word is the smallest step, and so never the heaviest of several
    heavy = fans.groupBy("node").agg(F.max(F.struct("n", "step")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("ways"))
    heavy, heavy_path = write_scratch(heavy.where("ways > 1").select("node", F.col("top.step").alias("heavy"), "size"), "trie")
    light = join_groups(steps, heavy, ["node"], "size", steps.count(), heavy.count() <= broadcast_rows, "inner").where(F.col("step") != F.col("heavy"))
    known = words.select(F.col("word").alias("target"), F.col("n").alias("target_n"))
    ends = _merged(light.select("id", "d", "step", "heavy").join(words, "id")).join(known, "target", "left")
    ends, ends_path = write_scratch(ends, "trie")
    drop_scratch(spark, steps_path, heavy_path)
    free_shuffles(spark)
    pairs = ends.where("kind = 'length' and target_n is not null")
    one = lambda word, n, other: pairs.select(F.col(word).alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col(n)).alias("n"), F.col(other).alias("word")).alias("best"))
    member = F.struct((-F.col("n")).alias("n"), "word")
    groups = ends.where("kind = 'replaced'").groupBy("d", "target").agg(F.collect_list(member).alias("x"), F.first("target_n").alias("target_n"))
    heavy_one = F.when(F.col("target_n").isNotNull(), F.array(F.struct((-F.col("target_n")).alias("n"), F.col("target").alias("word")))).otherwise(F.array().cast("array<struct<n:bigint,word:string>>"))
    groups = groups.select(F.array_sort(F.concat("x", heavy_one)).alias("x")).where(F.size("x") > 1)
    first, second = F.get("x", F.lit(0)), F.get("x", F.lit(1))
    met = groups.select(F.posexplode("x").alias("nth", "m"), (F.size("x") - 1).cast("long").alias("near"), first.alias("first"), second.alias("second"))
    met = met.select(F.col("m.word").alias("word"), "near", F.when(F.col("nth") == 0, F.col("second")).otherwise(F.col("first")).alias("best"))
    every = one("word", "target_n", "target").unionByName(one("target", "n", "word")).unionByName(met)
    best = every.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    found, _ = write_scratch(best.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best")), "trie")
    drop_scratch(spark, ends_path)
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: where the forms lead in the end. Each round doubles the way; since a
    form has more occurrences than its word, ways end, after the logarithm of the largest number of them at most."""
    spark = forms.sparkSession
    now, path = write_scratch(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("went")), "roots")
    while not now.where("went").isEmpty():
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        new = now.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        new, new_path = write_scratch(new, "roots")
        drop_scratch(spark, path)
        now, path = new, new_path
    return now.select("word", "root")


def group_spellings(words: DataFrame, ratio: float = RATIO, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of words (word, n): word, form, root, n, n_near, form_n.

    words: different strings of LETTERS with their occurrences, as count_words() gives them. Two words are near
    if they differ by exactly one inserted, deleted or replaced code point; n_near counts them. A word's
    form is its near word of largest n (ties: the smallest in code-point order) if that has at least `ratio`
    times the word's n, or null; root is where the forms lead from the word, itself if it has none. Null
    and empty words are left out. Other columns are ignored.
    """
    spark = words.sparkSession
    if ratio <= 1:
        raise ValueError("forms have to lead to more frequent words")
    words, _ = write_scratch(words.where("word <> ''").select(F.monotonically_increasing_id().alias("id"), "word", F.col("n").cast("long").alias("n")), "words")
    placed = words.select("word", "n").join(near_words(words, broadcast_rows), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    placed, _ = write_scratch(
        placed.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n")), "words"
    )
    roots = _roots(placed.where("form is not null").select("word", "form"))
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
