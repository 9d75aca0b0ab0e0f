"""Ball k-means over integer vectors: the clusters of plain rounds of assignment and means, with fewer distances.

A cluster is a ball: its centroid and a radius that bounds its members' distances. Another ball is a
neighbour if its centroid is less than two radii away; no member can be nearer to any other centroid.
A member nearer to its centroid than half the way to the nearest neighbour is in the ball's stable
core and is compared with nothing. The rest lies in annuli: ring t ends where half the way to
neighbour t + 1 begins, so a member of ring t is compared with the first t neighbours alone. A ball
is stable as a whole, with all its distances, if neither its centroid nor any neighbour's has moved.
All bounds are kept in integers and rounded to the safe side, so they leave out no centroid that is
as near.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import drop_scratch, set_batches, write_scratch

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, 3
#: Components beyond it count as it, so that four times a squared distance fits into 64 bits.
BOUND = 1 << 26
_STATE = "vec_id long, v array<int>, cluster int, distance long, moved boolean"
_PART = "cluster int, n long, inertia long, radius2 long, moved long, sums array<long>"


@dataclass
class Balls:
    """The centroids of a round and, of each, its neighbours in order of distance."""

    centroids: np.ndarray
    near: list[np.ndarray] = field(default_factory=list)
    #: Squared distances to these.
    apart2: list[np.ndarray] = field(default_factory=list)
    #: Balls whose members stay, with the distances they have.
    stable: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))


def neighbours(centroids: np.ndarray, radius: list[int | None], moved: np.ndarray) -> Balls:
    """radius: at least the distance of each ball's farthest member; None if it isn't known, which makes every ball a neighbour."""
    balls = Balls(centroids, stable=np.zeros(len(centroids), bool))
    for i, c in enumerate(centroids):
        d = ((centroids - c) ** 2).sum(1)
        order = np.array([j for j in np.lexsort((np.arange(len(d)), d)) if j != i and (radius[i] is None or int(d[j]) <= 4 * radius[i] ** 2)], np.int64)
        balls.near.append(order)
        balls.apart2.append(d[order])
        balls.stable[i] = radius[i] is not None and not moved[i] and not moved[order].any()
    return balls


def assign(v: np.ndarray, cluster: np.ndarray, distance: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row of v (ties: the smaller number), its squared distance, and how many distances that took."""
    new, found, used = cluster.copy(), distance.copy(), 0
    for i in np.unique(cluster):
        if balls.stable[i]:
            continue
        at = np.flatnonzero(cluster == i)
        own = ((v[at] - balls.centroids[i]) ** 2).sum(1)
        best, which = own.copy(), np.full(len(at), i)
        # ring of each member: the neighbours that are at most twice as far from the centroid as the member is
        ring = np.searchsorted(balls.apart2[i], 4 * own, "right")
        used += len(at) + int(ring.sum())
        for t, j in enumerate(balls.near[i]):
            some = np.flatnonzero(ring > t)
            if not len(some):
                break
            d = ((v[at[some]] - balls.centroids[j]) ** 2).sum(1)
            nearer = (d < best[some]) | (d == best[some]) & (j < which[some])
            best[some[nearer]], which[some[nearer]] = d[nearer], j
        new[at], found[at] = which, best
    return new, found, used


def _integers(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    """vec_id and v of the vectors that count; all are in cluster 0 to begin with."""
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        whole = pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False)
        ids, lists = ids.filter(whole), lists.filter(whole)
        x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # nulls become NaN
        finite = np.isfinite(x).all(1)
        with np.errstate(over="ignore"):
            v = np.clip(np.floor(x[finite] * scale), -BOUND, BOUND).astype(np.int32)
        yield _state(ids.filter(pa.array(finite)), v, np.zeros(len(v), np.int64), np.zeros(len(v), np.int64), np.ones(len(v), bool))


def _state(ids: pa.Array, v: np.ndarray, cluster: np.ndarray, distance: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(v) + 1, dtype=np.int64) * v.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(v.reshape(-1))), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(moved)],
        names=["vec_id", "v", "cluster", "distance", "moved"],
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _assigned(state: DataFrame, balls: Balls, dim: int) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(balls)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dim)
            old = batch.column(2).to_numpy().astype(np.int64)
            new, distance, _ = assign(v, old, batch.column(3).to_numpy().astype(np.int64), shared.value)
            yield _state(batch.column(0), v.astype(np.int32), new, distance, new != old)

    return state.mapInArrow(run, _STATE)


def _parts(state: DataFrame, k: int, dim: int) -> DataFrame:
    """A row for each cluster: its number of vectors, the sum and maximum of their distances, and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, inertia, radius2, moved = (np.zeros(k, np.int64) for _ in range(4))
        sums = np.zeros((k, dim), np.int64)
        for batch in batches:
            v, cluster = _matrix(batch.column(1), dim), batch.column(2).to_numpy()
            distance = batch.column(3).to_numpy()
            for i in np.unique(cluster):
                own = cluster == i
                n[i] += own.sum()
                inertia[i] += distance[own].sum()
                radius2[i] = max(radius2[i], distance[own].max())
                moved[i] += batch.column(4).to_numpy(zero_copy_only=False)[own].sum()
                sums[i] += v[own].sum(0)
        at = np.flatnonzero(n)
        offsets = pa.array(np.arange(len(at) + 1) * dim, pa.int32())
        columns = [pa.array(at.astype(np.int32)), *(pa.array(x[at]) for x in (n, inertia, radius2, moved)), pa.ListArray.from_arrays(offsets, pa.array(sums[at].reshape(-1)))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "inertia", "radius2", "moved", "sums"])

    parts = state.mapInArrow(run, _PART)
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), whole("inertia").alias("inertia"), F.max("radius2").alias("radius2"), F.sum("moved").alias("moved"),
        F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(dim)]).alias("sums"),
    )


def first_centroids(state: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `seed:vec_id`, in that order; of equal ids, the smaller vector first. Rows without id come last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = state.select(name.alias("name"), "v").orderBy(F.col("name").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, counts: list[int] | None = None
) -> DataFrame:
    """One row per vector kept: vec_id, cluster, distance, cluster_inertia, inertia, centroid (array of long).

    vectors: vec_id, embedding (array of float or double). Vectors of exactly `dim` components, none null, NaN
    or infinite, are kept; a component x is the integer floor(scale * x), within BOUND. Each round puts every
    vector to the nearest centroid by squared distance (ties: the smaller number) and makes each centroid
    that has any the floor of their mean; the vectors are put to the last centroids once more. Fewer
    vectors than clusters give as many centroids; none give no rows. Rows that repeat count each; equal
    first vectors leave the later of their clusters empty. Rows without id are vectors like others, first
    centroids only if no others are left. Other columns are ignored.

    A round reads the vectors with their clusters, writes them anew and reads them once more for the sums: one row of
    sums for each cluster and task is all that is shuffled, one for each cluster all that reaches the driver, and
    the balls (clusters * dim numbers) are all that is broadcast. A hot cluster or vector is divided like
    any other rows. Rounds that would change nothing are left out. Each round is a table in the shared folder, so a
    lost executor costs its tasks of one round.

    counts: gets, for each assignment, the number of vectors that moved.
    """
    spark = vectors.sparkSession
    set_batches(spark)
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    state, path = write_scratch(chosen.mapInArrow(lambda batches: _integers(batches, dim, scale), _STATE), "vectors")
    centroids = first_centroids(state, clusters, seed)
    k = len(centroids)
    if not k:
        drop_scratch(spark, path)
        return _named(spark, state, [])
    radius: list[int | None] = [None] * k
    moved = np.ones(k, bool)
    for number in range(rounds + 1):
        new, new_path = write_scratch(_assigned(state, neighbours(centroids, radius, moved), dim), "vectors")
        drop_scratch(spark, path)
        state, path = new, new_path
        sums = {r.cluster: r for r in _parts(state, k, dim).collect()}
        changed = sum(r.moved for r in sums.values())
        if counts is not None:
            counts.append(changed)
        if number == rounds or number and not changed:  # the same members have the same means
            break
        after = centroids.copy()
        for i, r in sums.items():
            after[i] = [int(s) // r.n for s in r.sums]
        shift = [_root(int(x)) for x in ((after - centroids) ** 2).sum(1)]
        moved = (after != centroids).any(1)
        # the farthest member is at most as much farther as the centroid has moved
        radius = [_root(sums[i].radius2) + shift[i] if i in sums else 0 for i in range(k)]
        centroids = after
    total = sum(int(r.inertia) for r in sums.values())
    return _named(spark, state, [(i, int(r.inertia), total, centroids[i].tolist()) for i, r in sorted(sums.items())])


def _root(x: int) -> int:
    """The square root, rounded up."""
    return isqrt(x - 1) + 1 if x > 0 else 0


def _named(spark: SparkSession, state: DataFrame, rows: list[tuple]) -> DataFrame:
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return state.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
