"""Sharding by balanced label propagation."""

from __future__ import annotations

import json
from collections import Counter
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import BROADCAST_ROWS, drop_scratch, gapless_rank, hash_bucket, join_groups, write_scratch

#: Rows of a shard that are filled by trying all sums of group sizes; the rest is filled largest groups first.
TAIL = 1 << 13


def _plan(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of the driver's as a broadcast side, without Python on the executors."""
    names = [x.split()[0] for x in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return F.broadcast(spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ",")))))


def _intervals(amounts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(from, upto, shard) of each (shard, amount) if the amounts are laid in a row."""
    out, at = [], 0
    for to, n in amounts:
        if n:
            out.append((at, at + n, to))
        at += n
    return out


def _exchange(wishes: dict[tuple[int, int], int], free: list[int]) -> tuple[Counter, Counter]:
    """How many of the wished moves, and how many unlinked rows, go from one shard to another so that all keep their counts.

    Wishes are closed to circles of shards first; what is left goes where an unlinked row can come back.
    """
    out: dict[int, dict[int, int]] = {}
    for (s, t), n in wishes.items():
        out.setdefault(s, {})[t] = n
    free, moved, given = list(free), Counter(), Counter()
    for with_free in (False, True):
        for s, t in sorted(wishes, key=lambda e: (-wishes[e], e)):
            while out[s].get(t):
                before, queue, end = {t: s}, [t], None
                for u in queue:
                    if u == s or with_free and free[u]:
                        end = u
                        break
                    for v, n in out.get(u, {}).items():
                        if n and v not in before:
                            before[v] = u
                            queue.append(v)
                if end is None:
                    break
                way, u = [(s, t)], end
                while u != t:
                    way.append((before[u], u))
                    u = before[u]
                n = min([out[a][b] for a, b in way] + ([] if end == s else [free[end]]))
                for a, b in way:
                    out[a][b] -= n
                    moved[a, b] += n
                if end != s:
                    free[end] -= n
                    given[end, s] += n
    return moved, given


def _pack(groups: dict[int, int], room: list[int]) -> tuple[dict[int, list[tuple[int, int]]], int]:
    """By size the (shard, number of groups) that fit whole, and how many groups of more than one row do not.

    groups: number of groups by size, single rows as size 1. Each shard in turn takes its share of
    every size, then the largest groups that fit, and the last TAIL rows by the best sum of sizes.
    """
    left, rest, plan = Counter(groups), sum(room), {}
    for s in sorted(range(len(room)), key=lambda s: (room[s], s)):
        chosen = Counter({z: max(0, n * room[s] // rest - 2) for z, n in left.items()} if rest else {})
        gap = room[s] - sum(z * n for z, n in chosen.items())
        for z in sorted(left, reverse=True):
            n = min(left[z] - chosen[z], (gap if z > TAIL else max(0, gap - TAIL)) // z)
            chosen[z] += n
            gap -= z * n
        reach, layers = 1, []
        for z in sorted((z for z in left if z <= gap), reverse=True):
            n, step = min(left[z] - chosen[z], gap // z), 1
            while n:
                k = min(step, n)
                layers.append((z, k, reach))
                reach |= (reach << z * k) & ((1 << gap + 1) - 1)
                n, step = n - k, 2 * step
        best = reach.bit_length() - 1
        for z, k, without in reversed(layers):
            if not without >> best & 1:
                chosen[z] += k
                best -= z * k
        for z, n in chosen.items():
            if n:
                left[z] -= n
                plan.setdefault(z, []).append((s, n))
        rest -= room[s]
    return plan, sum(n for z, n in left.items() if z > 1)


def _seat(state: DataFrame, room: list[int], few: bool) -> DataFrame:
    """Puts the groups that are still split, or all groups if that leaves fewer of them split, whole into shards; unlinked rows fill up. few: at most BROADCAST_ROWS groups."""
    spark = state.sparkSession
    groups = state.where("gsize > 1").groupBy("gid", "gsize").agg(F.min("shard").alias("least"), F.max("shard").alias("most"))
    groups = groups.withColumn("home", F.when(F.col("least") == F.col("most"), F.col("least"))).drop("least", "most")
    split, every, open_room = Counter(), Counter(), list(room)
    for r in groups.groupBy("gsize", "home").agg(F.count(F.lit(1)).alias("n")).collect():
        every[r.gsize] += r.n
        if r.home is None:
            split[r.gsize] += r.n
        else:
            open_room[r.home] -= r.gsize * r.n
    single = sum(room) - sum(z * n for z, n in every.items())
    plan, lost = _pack(split + Counter({1: single}), open_room)
    if lost and split != every:
        wider = _pack(every + Counter({1: single}), room)
        if wider[1] < lost:
            (plan, lost), split, open_room = wider, every, room
    pool = groups if split == every else groups.where("home is null")
    gaps = list(open_room)
    for z, puts in plan.items():
        for s, n in puts if z > 1 else []:
            gaps[s] -= z * n
    puts = [(z, *x) for z, p in plan.items() if z > 1 for x in _intervals(p)]
    numbered = gapless_rank(pool, ["gsize"], hash_bucket(F.xxhash64("gid")), ["gid"], "nth").join(
        _plan(spark, "z long, lo long, hi long, to int", puts), (F.col("gsize") == F.col("z")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")), "left"
    )
    numbered = numbered.select("gid", "gsize", F.col("gsize").alias("of"), "to")
    rows = join_groups(state, numbered, ["gid", "gsize"], "of", sum(room), few)
    rows = rows.withColumn("fills", (F.col("gsize") == 1) | F.col("of").isNotNull() & F.col("to").isNull()).withColumnRenamed("to", "seat").drop("of")
    bucket = F.when(F.col("gsize") == 1, hash_bucket(F.col("key")) + 1024).otherwise(hash_bucket(F.xxhash64("gid"), 4) * 64 + hash_bucket(F.col("key"), 6))
    ranked = gapless_rank(rows, ["fills"], bucket, ["gid", "key", "doc_id"], "rank")
    filled = ranked.join(
        _plan(spark, "lo long, hi long, to int", _intervals(list(enumerate(gaps)))), F.col("fills") & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left"
    )
    return filled.withColumn("shard", F.coalesce("to", "seat", "shard")).select(state.columns)


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int | None = None, cut: list[int] | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents with equal texts are linked. Labels are shards. The start deals rows out evenly in
    hash order. In each round a group's members wish to move towards the shard where most of the
    group is (ties by hash), pre-aggregated by (group, shard), so no pairs are made. The law `rows`
    (counts at most one apart) holds exactly: wishes of opposite directions, or around a circle of
    shards, are exchanged, and other moves are made as far as unlinked rows can go the other way,
    small groups first. Rounds go on (at most `rounds` of them, if given) as long as fewer rows than before lie
    apart from most of their group; groups that are split then are seated whole where they fit, by counts of
    groups by size, see _pack; all groups are only where that leaves fewer of them split. A group larger than a shard fills as many as it can alone
    before the start, and its remaining rows are a group of their own.

    Null text: size 1 and CRC 0, linked with other null texts only. slot numbers a shard's rows
    from 0. grown_shard is null: the law is not `key`. Rows that repeat, or that share an id or have none, are rows of their own,
    ordered by (hash of id and text, id) wherever that matters; texts of any length count by their hash. Other columns
    are ignored. Only counts by shard (at most shards squared) and by group size and shard reach the driver.

    cut: gets, for each round, the number of rows that lie apart from most of their group: links cut by the shards.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(F.col("text"))), F.lit(b"")).alias("gid"),
    ).withColumn("key", F.xxhash64("doc_id", "gid"))
    state, path = write_scratch(rows, "shard")
    total = state.count()
    room = [total // shards + (s < total % shards) for s in range(shards)]
    sizes, sizes_path = write_scratch(state.groupBy("gid").agg(F.count(F.lit(1)).alias("gsize")).where("gsize > 1"), "shard")
    # fewer than shards, but for tables of fewer rows than that
    large = sizes.where(F.col("gsize") > max(room)).select(F.hex("gid").alias("g"), "gsize").orderBy("g").collect()
    few = sizes.count() <= BROADCAST_ROWS
    rows = join_groups(state, sizes.withColumn("of", F.col("gsize")), ["gid"], "of", total, few).drop("of")
    rows = rows.withColumn("gsize", F.coalesce("gsize", F.lit(1).cast("long")))
    closed, seats = 0, []
    for r in large:
        at = 0
        while closed < shards and 0 < room[closed] <= r.gsize - at:
            seats.append((r.g, 0, at, at + room[closed], closed))
            at += room[closed]
            room[closed] = 0
            closed += 1
        if at < r.gsize:
            seats.append((r.g, r.gsize - at, at, r.gsize, None))
    # gsize 0: rows that have their shard for good
    seated = None
    if large:
        hot = F.col("gsize") > (total + shards - 1) // shards
        put = gapless_rank(rows.where(hot), ["gid"], hash_bucket(F.col("key")), ["key", "doc_id"], "nth").join(
            _plan(spark, "g string, part long, lo long, hi long, to int", seats), (F.hex("gid") == F.col("g")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi"))
        )
        put = put.withColumn("gsize", F.col("part")).withColumnRenamed("to", "shard")
        seated = put.where("shard is not null").select(*rows.columns, "shard")
        rows = rows.where(~hot).unionByName(put.where("shard is null").select(rows.columns))
    dealt = gapless_rank(rows, [], hash_bucket(F.col("key")), ["key", "doc_id"], "rank")
    dealt = dealt.withColumn("shard", (F.col("rank") % max(1, shards - closed) + closed).cast("int")).drop("rank")
    base, base_path = write_scratch(dealt if seated is None else dealt.unionByName(seated), "shard")
    drop_scratch(spark, path, sizes_path)
    state, paths, before = base, [base_path], None
    for turn in count():
        linked = state.where("gsize > 1").groupBy("gid", "gsize", "shard").agg(F.count(F.lit(1)).alias("n"))
        aims = linked.groupBy("gid", "gsize").agg(
            F.max_by("shard", F.struct("n", F.xxhash64("gid", "shard", F.lit(turn)).alias("tie"))).alias("aim")
        )
        wishes = join_groups(state, aims.withColumn("of", F.col("gsize")), ["gid", "gsize"], "of", total, few).drop("of")
        wishes = wishes.withColumn(
            "kind", F.when(F.col("gsize") == 1, "free").when(F.col("aim") != F.col("shard"), "move").otherwise("stay")
        ).withColumn("queue", F.when(F.col("kind") == "move", F.col("shard") * shards + F.col("aim")).otherwise(F.col("shard")))
        salt = F.xxhash64("key", F.lit(turn))
        # small groups first: the bucket's upper part is the logarithm of the group's size
        bucket = F.floor(F.log2(F.greatest("gsize", F.lit(1)).cast("double"))).cast("long") * 1024
        bucket = bucket + F.when(F.col("kind") == "move", hash_bucket(salt, 7)).otherwise(hash_bucket(salt))
        ranked, new_path = write_scratch(
            gapless_rank(wishes.withColumn("salt", salt), ["kind", "queue"], bucket, ["salt", "doc_id"], "rank").drop("salt"),
            "shard",
        )
        paths.append(new_path)
        drop_scratch(spark, paths.pop(0))
        state = ranked.select(base.columns)
        have = {(r.kind, r.queue): r.n for r in ranked.groupBy("kind", "queue").agg(F.count(F.lit(1)).alias("n")).collect()}
        wished = {divmod(q, shards): n for (kind, q), n in have.items() if kind == "move"}
        wanted = sum(wished.values())
        if cut is not None:
            cut.append(wanted)
        if not wished:
            break
        if rounds is not None and turn >= rounds or before is not None and wanted >= before:
            state = _seat(state, room, few)
            break
        before = wanted
        moved, given = _exchange(wished, [have.get(("free", s), 0) for s in range(shards)])
        flows = [("move", s * shards + t, 0, n, t) for (s, t), n in moved.items()]
        for s in range(shards):
            flows += [("free", s, *x) for x in _intervals([(t, n) for (u, t), n in sorted(given.items()) if u == s])]
        todo = _plan(spark, "k string, q int, lo long, hi long, to int", flows)
        here = (F.col("kind") == F.col("k")) & (F.col("queue") == F.col("q")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
        state = ranked.join(todo, here, "left").withColumn("shard", F.coalesce("to", "shard")).select(base.columns)
        if not moved:
            state = _seat(state, room, few)
            break
    placed = gapless_rank(state.withColumn("salt", F.xxhash64("key", F.lit(-1))), ["shard"], hash_bucket(F.col("salt")), ["salt", "doc_id"], "slot")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
