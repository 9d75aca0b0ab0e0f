"""Greedy packing of ordered items into bins, for runs of any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.plans.stages import Stages

#: Items of a run that are folded within one row; longer runs are spread over tasks.
MOST_FOLDED = 4096
#: Positions that one task adds up at once.
BLOCK = 4096
#: Keys of long runs up to which they are broadcast.
BROADCAST_RUNS = 200_000


def running_sums(rows: DataFrame, keys: Sequence[str], pos: str, **sums: Column) -> DataFrame:
    """rows with the running sums, up to each row, over pos within keys.

    No task holds a whole key: rows are added up in blocks of BLOCK positions, the blocks' totals, one row
    for each, over the key, and these go back to the rows.
    """
    rows = rows.withColumn("_block", F.floor(F.col(pos) / BLOCK)).withColumns({f"_v_{n}": c for n, c in sums.items()})
    by = [*keys, "_block"]
    inside = Window.partitionBy(*by).orderBy(pos)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*by).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    ahead = totals.select(*by, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    found = rows.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_s_{n}") for n in sums]).join(ahead, by)
    return found.withColumns({n: F.col(f"_s_{n}") + F.col(f"_b_{n}") for n in sums}).drop("_block", *[f"_{x}_{n}" for n in sums for x in "vsb"])


def pack_runs(items: DataFrame, keys: Sequence[str], pos: str, cost: str, limit: str, limits: Sequence[int], most_folded: int | None = None) -> DataFrame:
    """items with `bin`, from 0 within a run, and `starts`: whether a bin begins there. Bins are filled in the order of pos; an item that would bring
    a bin above its run's limit begins the next one, also if it is above the limit by itself.

    pos is unique within a run (keys), cost is at least 1, limit is one of `limits` for a whole run. Runs of up to most_folded items are
    folded each in its row. Of longer ones each item gets the link to where the next bin would begin if
    one began there, from sums within stretches of the limit's size, and the bins' beginnings are what the
    links reach from the first item: links are doubled until all lead to the end, two joins a round.
    """
    most_folded = most_folded or MOST_FOLDED
    keys = list(keys)
    rest = [c for c in items.columns if c not in (*keys, pos)]
    sizes = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most_folded).select(*keys)
    stages = Stages(items.sparkSession)
    long, n = stages.keep("long", lambda: sizes, n=F.count(F.lit(1)))
    named = F.broadcast(long) if n["n"] <= BROADCAST_RUNS else long
    short = items if not n["n"] else items.join(named, keys, "left_anti")
    rows = short.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, *rest))).alias("_x"))
    zero = F.struct(F.lit(None).cast("long").alias("used"), F.lit(-1).alias("bin"), F.array().cast("array<struct<bin:int,starts:boolean>>").alias("out"))

    def place(s: Column, x: Column) -> Column:
        fresh = s["used"].isNull() | (s["used"] + x[cost] > x[limit])
        used, here = F.when(fresh, x[cost]).otherwise(s["used"] + x[cost]).cast("long"), s["bin"] + fresh.cast("int")
        return F.struct(used.alias("used"), here.alias("bin"), F.concat(s["out"], F.array(F.struct(here.alias("bin"), fresh.alias("starts")))).alias("out"))

    flags = rows.select(*keys, "_x", F.aggregate("_x", zero, place, lambda s: s["out"]).alias("_f"))
    found = flags.select(*keys, F.explode(F.arrays_zip("_x", "_f")).alias("_z")).select(*keys, "_z._x.*", "_z._f.*")
    if not n["n"]:
        return found
    spread = _spread(items.join(named, keys, "left_semi"), keys, pos, cost, limit, limits, stages)
    return found.unionByName(spread.select(found.columns))


def _spread(items: DataFrame, keys: list[str], pos: str, cost: str, limit: str, limits: Sequence[int], stages: Stages) -> DataFrame:
    items, _ = stages.keep("items", lambda: running_sums(items, keys, pos, _end=F.col(cost).cast("long"), _nth=F.lit(1).cast("long")))
    placed = items.select(*keys, (F.col("_nth") - 1).alias("i"), (F.col("_end") - F.col(cost)).alias("at"), F.col(limit).alias("l"))
    ends = items.groupBy(*keys).agg(F.max("_nth").alias("i"), F.max("_end").alias("at"), F.first(limit).alias("l"))
    links = None
    for size in sorted(set(limits)):
        mine = placed.unionByName(ends).where(F.col("l") == size).withColumn("part", F.floor(F.col("at") / size))
        # what a bin from here can hold ends within this stretch or the next one
        both = mine.select(*keys, "i", "at", "part", F.explode(F.array("part", F.col("part") - 1)).alias("here"))
        ahead = Window.partitionBy(*keys, "here").orderBy("at").rangeBetween(0, size)
        found = both.select(*keys, "i", "part", "here", F.greatest(F.max("i").over(ahead), F.col("i") + 1).alias("to")).where("part = here").select(*keys, "i", "to")
        links = found if links is None else links.unionByName(found)
    last = ends.select(*keys, F.col("i").alias("n"))
    links, _ = stages.keep("links0", lambda: links.join(last, keys).where("to < n").select(*keys, "i", "to"))
    marks, _ = stages.keep("marks0", lambda: items.select(*keys).distinct().withColumn("i", F.lit(0).cast("long")))
    number = 0
    while not links.isEmpty():
        number += 1
        reached = lambda: marks.unionByName(marks.join(links, [*keys, "i"]).select(*keys, F.col("to").alias("i"))).distinct()  # noqa: B023, E731
        then = links.select(*keys, F.col("i").alias("to"), F.col("to").alias("far"))
        doubled = lambda: links.join(then, [*keys, "to"]).select(*keys, "i", F.col("far").alias("to"))  # noqa: B023, E731
        marks, links = stages.keep(f"marks{number}", reached)[0], stages.keep(f"links{number}", doubled)[0]
    begun = marks.select(*keys, (F.col("i") + 1).alias("_nth"), F.lit(True).alias("starts"))
    flagged, _ = stages.keep("flagged", lambda: items.join(begun, [*keys, "_nth"], "left").withColumn("starts", F.coalesce("starts", F.lit(False))).drop("_nth", "_end"))
    return running_sums(flagged, keys, pos, bin=F.col("starts").cast("int")).withColumn("bin", (F.col("bin") - 1).cast("int"))
