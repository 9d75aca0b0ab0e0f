"""Chat formatting: snapshots that a longer logged conversation continues are dropped, the rest rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns in one rendered part, and turn numbers in one block. No list is longer, and no window if turn numbers of a
#: conversation differ; rows that share a conversation and a block of turn numbers are sorted in one task, spilling to disk.
PART = 256
# The marks of the public ChatML layout.
START, END = "<|im_start|>", "<|im_end|>"


def _plain(value: Column) -> Column:
    """Marks inside a role or text are opened up, so that they can't end a turn."""
    return F.replace(value, F.lit("<|"), F.lit("< |"))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, n (turns of the conversation), h1 and h2 (hash of the turns up to this one).

    Turns are numbered from 0 in the order (turn, role, text), within blocks of PART turn numbers
    first and over the blocks' counts then. The prefix hash is the exclusive or of 64-bit hashes
    of (position, role, text), twice, rolled over in the same two steps.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("block", F.floor(F.col("turn") / PART))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    over = Window.partitionBy("conv_id").orderBy("block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block"))

    counts = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"),
        F.sum("c").over(Window.partitionBy("conv_id")).alias("n"),
    )
    placed = (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(counts, same)
        .select("conv_id", "block", "role", "text", "n", (F.col("at") + F.col("start")).cast("long").alias("pos"))
    )
    hashed = placed.select(
        "*", F.xxhash64("pos", "role", "text").alias("e1"), F.xxhash64(F.lit("second"), "pos", "text", "role").alias("e2")
    )
    totals = hashed.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    totals = totals.select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        *[F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0)).alias(f"x{k}") for k in (1, 2)],
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        hashed.select("*", *[F.bit_xor(f"e{k}").over(upto).alias(f"p{k}") for k in (1, 2)])
        .join(totals, same)
        .select("conv_id", "pos", "role", "text", "n", *[F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"h{k}") for k in (1, 2)])
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, part, n_turns, rendered) of the conversations that no longer one starts with.

    turns: conv_id, turn, role, text. A conversation goes if its turns are the first turns of a
    longer one; of equal conversations the one with the smallest conv_id stays (a null id before all
    others). A conversation is rendered in parts of PART turns, to be joined in order of part; only
    a conversation of more turns has more than one. Null roles and texts are empty, repeated rows
    count once, turns with equal numbers are ordered by role and text, null numbers come first.
    Other columns are ignored.
    """
    rows = numbered_turns(turns)
    keys = ["n", "h1", "h2"]
    wholes = rows.where(F.col("pos") == F.col("n") - 1).groupBy(*keys).agg(F.min(F.struct("conv_id")).alias("first"))
    prefixes = rows.where(F.col("pos") < F.col("n") - 1).select((F.col("pos") + 1).alias("n"), "h1", "h2").distinct()
    kept = wholes.join(prefixes, keys, "left_anti").select(F.col("first.conv_id").alias("kept_id"))
    shown = F.concat(F.lit(START), _plain(F.col("role")), F.lit("\n"), _plain(F.col("text")), F.lit(f"{END}\n"))
    return (
        rows.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
        .select("conv_id", F.floor(F.col("pos") / PART).alias("part"), "pos", shown.alias("shown"))
        .groupBy("conv_id", "part")
        .agg(F.count(F.lit(1)).alias("n_turns"), F.array_sort(F.collect_list(F.struct("pos", "shown"))).alias("shown"))
        .select("conv_id", "part", "n_turns", F.array_join(F.col("shown.shown"), "").alias("rendered"))
    )


SQL = f"""
    WITH t AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    ), o AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
               count(*) OVER (PARTITION BY conv_id) AS n
        FROM t
    ), p AS (
        SELECT conv_id, pos, n, role, text,
               md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS h
        FROM o
    ), kept AS (
        SELECT min(conv_id) AS conv_id FROM p WHERE pos = n - 1 AND h NOT IN (SELECT h FROM p WHERE pos < n - 1) GROUP BY h
    )
    SELECT conv_id, pos // {PART} AS part, count(*) AS n_turns,
           string_agg('{START}' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '{END}' || chr(10), '' ORDER BY pos) AS rendered
    FROM p WHERE conv_id IN (SELECT conv_id FROM kept)
    GROUP BY ALL
"""
