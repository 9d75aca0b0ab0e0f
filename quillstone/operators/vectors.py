"""Nearest vectors: inverted lists over centroids, residual codes, exact ranking of what the codes leave open.

build() keeps three tables, each vector that is there several times once, as a point:

- `points` (point, vector, n, ids): the MD5 of the components, how many rows have them and the smallest of their ids;
- `centroids` (list, centroid): fitted on a bounded sample of the points;
- `codes` (list, point, code, scale, error, reach): a point's nearest centroid, its distance from that and, in a byte for each
  component, the difference; `error` is how far the decoded point lies from the true one.

By the error, a code gives a lower and an upper bound on a distance. A search decodes the lists that are nearest to a query, in
blocks of queries and points, and drops the points whose lower bound is above the k-th smallest upper bound. The distances of
the few that remain are computed from the vectors. So codes cost no recall; what can be missed are points of lists that were
not looked into, and an exact search goes on into each list whose ball (centroid, largest reach) may hold a nearer point.
How many lists a search looks into is measured at the end of a build, by exact searches for a bounded sample of the points:
as many as hold a given share of their neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstone.operators.joins import join_hot
from quillstone.plans.stages import Stages

#: Lists are as many as the root of the points, up to this; the centroids are a few MB then, on the driver too.
MOST_LISTS = 8192
#: Points that a centroid is fitted on, on average: the sample is 524,288 points at most.
SAMPLE_PER_LIST = 64
ROUNDS = 12
#: A search can ask for so many neighbours; a point keeps as many ids.
MOST_K = 1000
#: Of the TUNED_K nearest others of about so many points, drawn by hash, this share lies in the lists that a search looks into unless told otherwise.
TUNED_ON, TUNED_K, TUNED_SHARE = 256, 10, 0.96
#: Points and queries that meet in one group of a search.
POINT_BLOCK, QUERY_BLOCK = 8192, 2048
_SLICE = 256


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has dim components, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dim) & ~bad, F.lit(False))


def distance(a: Column, b: Column) -> Column:
    """The Euclidean distance, summed in the order of the components."""
    square = lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda acc, x: acc + x))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.to_list(), dtype=np.float64).reshape(-1, dim)


def _distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distances between the rows of a and b, and by how much rounding may have changed them."""
    na, nb = (a * a).sum(1)[:, None], (b * b).sum(1)[None, :]
    found = np.sqrt(np.maximum(na + nb - 2 * (a @ b.T), 0))
    return found, (np.sqrt(na) + np.sqrt(nb)) * math.sqrt((a.shape[1] + 8) * np.finfo(float).eps)


def _fit(points: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's rounds from points drawn by a fixed seed; a centroid that nothing is nearest to stays."""
    centroids = points[np.random.default_rng(0).choice(len(points), min(lists, len(points)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([_distances(points[i : i + _SLICE], centroids)[0].argmin(1) for i in range(0, len(points), _SLICE)])
        order = np.argsort(near, kind="stable")
        lists_held, starts, sizes = np.unique(near[order], return_index=True, return_counts=True)
        centroids[lists_held] = np.add.reduceat(points[order], starts) / sizes[:, None]
    return centroids


class VectorIndex:
    """An index of vectors in a folder (unless it is given, one of the shared folder that goes at the interpreter's exit)."""

    def __init__(self, spark: SparkSession, dim: int, path: str | None = None):
        self.spark, self.dim = spark, dim
        self.stages = Stages(spark, path)

    def build(self, rows: DataFrame) -> VectorIndex:
        """Indexes rows (id long, vector). Rows whose vector usable() refuses and rows without id are left out; an index that was
        whole before is read as it is. Rows may have equal ids or equal vectors, and there may be none."""
        held = rows.select(F.col("id").cast("long").alias("id"), "vector").where(F.col("id").isNotNull() & usable(F.col("vector"), self.dim))
        held = held.select("id", "vector", F.md5(F.col("vector").cast("string")).alias("point"))

        def points() -> DataFrame:
            # the smallest ids of a common vector are picked before they are shuffled
            few = held.select("point", "id").distinct().withColumn("nth", F.row_number().over(W.partitionBy("point").orderBy("id"))).where(F.col("nth") <= MOST_K)
            few = few.groupBy("point").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            return held.groupBy("point").agg(F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("n")).join(few, "point")

        found, counts = self.stages.keep("points", points, points=F.count(F.lit(1)))
        n = counts["points"]
        lists = max(1, min(MOST_LISTS, math.isqrt(n)))
        share = min(1.0, lists * SAMPLE_PER_LIST / max(1, n))
        drawn = found.where(F.conv(F.substring("point", 1, 8), 16, 10).cast("double") <= share * 2**32).select("point", "vector")
        dim = self.dim

        def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = [f for f in frames if len(f)]
            if whole:
                # in a fixed order, whatever the order of the rows
                sample = pd.concat(whole).sort_values("point")
                made = _fit(_matrix(sample["vector"], dim), lists)
                yield pd.DataFrame({"list": range(len(made)), "centroid": list(made)})

        self.stages.keep("centroids", lambda: drawn.repartition(1).mapInPandas(fit, "list int, centroid array<double>"))
        centroids = self._centroids()

        def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for i in range(0, len(f), 4096):
                    some = f.iloc[i : i + 4096]
                    x = _matrix(some["vector"], dim)
                    near = np.concatenate([_distances(x[j : j + _SLICE], centroids)[0].argmin(1) for j in range(0, len(x), _SLICE)])
                    rest = x - centroids[near]
                    scale = np.abs(rest).max(1) / 127
                    scale[scale == 0] = 1.0
                    codes = np.rint(rest / scale[:, None]).astype(np.int8)
                    # a little more than computed, for its own rounding
                    error = np.linalg.norm(rest - codes * scale[:, None], axis=1) * (1 + 1e-9)
                    yield pd.DataFrame({"list": near.astype(np.int32), "point": some["point"].to_numpy(), "code": [c.tobytes() for c in codes], "scale": scale, "error": error, "reach": np.linalg.norm(rest, axis=1) * (1 + 1e-9)})

        coded = lambda: found.select("point", "vector").mapInPandas(encode, "list int, point string, code binary, scale double, error double, reach double")
        self.stages.keep("codes", lambda: coded().repartitionByRange("list", "point").sortWithinPartitions("list", "point"))
        self.stages.keep("lists", lambda: self._table("codes").groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")))
        self.stages.keep("probes", lambda: self._tuned(found, min(1.0, TUNED_ON / max(1, n))))
        return self

    def _tuned(self, points: DataFrame, share: float) -> DataFrame:
        """(probes): how many lists, from the nearest, hold TUNED_SHARE of the neighbours of some points."""
        # by other digits of the hash than the sample that the centroids are fitted on
        drawn = points.where(F.conv(F.substring("point", 9, 8), 16, 10).cast("double") <= share * 2**32).select(F.get("ids", F.lit(0)).alias("query_id"), "vector")
        found = nearest_others(self._found(drawn, TUNED_K + 1, 1, True), TUNED_K).select("query_id", "list")
        centroids, dim = self._centroids(), self.dim

        def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for i in range(0, len(f), _SLICE):
                    some = f.iloc[i : i + _SLICE]
                    away, _ = _distances(_matrix(some["vector"], dim), centroids)
                    yield pd.DataFrame({"place": 1 + (away < away[np.arange(len(some)), some["list"].to_numpy()][:, None]).sum(1)})

        placed = found.join(drawn, "query_id").select("vector", "list").mapInPandas(places, "place long")
        return placed.agg(F.coalesce(F.percentile("place", TUNED_SHARE), F.lit(1.0)).alias("x")).select(F.ceil("x").cast("int").alias("probes"))

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.stages.path}/{name}")

    def _centroids(self) -> np.ndarray:
        rows = self._table("centroids").orderBy("list").collect()
        return np.array([r.centroid for r in rows], dtype=np.float64).reshape(-1, self.dim)

    def search(self, queries: DataFrame, top_k: int = 10, probes: int | None = None, exact: bool = False) -> DataFrame:
        """(query_id, id, distance, rank): the top_k rows nearest to each of queries (query_id, vector), ties by id.

        Queries are as many as one likes. Those whose vector usable() refuses get no rows. With exact, no nearer row is missed;
        without, the probes nearest lists are looked into, as many as the build has measured unless they are given.
        """
        if not 0 < top_k <= MOST_K:
            raise ValueError(f"top_k is not between 1 and {MOST_K}")
        if probes is None:
            probes = 1 if exact else self._table("probes").first().probes
        return self._found(queries, top_k, probes, exact).drop("list")

    def _found(self, queries: DataFrame, top_k: int, probes: int, exact: bool) -> DataFrame:
        """search() with the list of each row."""
        work = Stages(self.spark)
        asked = queries.where(usable(F.col("vector"), self.dim)).select("query_id", "vector", F.md5(F.col("vector").cast("string")).alias("query"))
        asked, _ = work.keep("asked", lambda: asked)
        wanted, _ = work.keep("wanted", lambda: asked.groupBy("query").agg(F.any_value("vector").alias("vector")))
        centroids, dim = self._centroids(), self.dim
        radii = np.full(len(centroids), -np.inf)  # of an empty list
        for r in self._table("lists").collect():
            radii[r.list] = r.radius
        filled = np.flatnonzero(radii >= 0)

        def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for i in range(0, len(f) if len(filled) else 0, _SLICE):
                    some = f.iloc[i : i + _SLICE]
                    away, _ = _distances(_matrix(some["vector"], dim), centroids[filled])
                    best = filled[np.argsort(away, axis=1, kind="stable")[:, :probes]]
                    at = np.repeat(np.arange(len(some)), best.shape[1])
                    yield pd.DataFrame({"query": some["query"].to_numpy()[at], "list": best.ravel().astype(np.int32)})

        def reachable(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for i in range(0, len(f) if len(filled) else 0, _SLICE):
                    some = f.iloc[i : i + _SLICE]
                    away, slack = _distances(_matrix(some["vector"], dim), centroids[filled])
                    at, which = np.nonzero(away - slack - radii[filled] <= some["most"].to_numpy()[:, None])
                    yield pd.DataFrame({"query": some["query"].to_numpy()[at], "list": filled[which].astype(np.int32)})

        probed, _ = work.keep("probed", lambda: wanted.mapInPandas(nearest, "query string, list int"))
        open_, _ = work.keep("open", lambda: self._screened(probed, wanted, top_k, centroids))
        if exact:
            most = self._bounded(open_, top_k).groupBy("query").agg(F.max("most").alias("most"))
            most = wanted.join(most, "query", "left").fillna(float("inf"), "most")
            further, _ = work.keep("further", lambda: most.mapInPandas(reachable, "query string, list int").join(probed, ["query", "list"], "left_anti"))
            more, _ = work.keep("more", lambda: self._screened(further, wanted, top_k, centroids))
            open_ = open_.unionByName(more)
        left, _ = work.keep("left", lambda: self._bounded(open_, top_k).where(F.col("lower") <= F.col("most")).select("query", "list", "point"))
        # a point, or a vector that many ask for, may be in very many of the rows
        met = join_hot(left, self._table("points").select("point", "vector", "ids"), ["point"], "inner")
        met = met.join(wanted.withColumnRenamed("vector", "sought"), "query").select("query", "list", "ids", distance(F.col("sought"), F.col("vector")).alias("distance"))
        by = lambda *c: F.row_number().over(W.partitionBy("query").orderBy(*c))
        best = met.withColumn("rank", by("distance", F.get("ids", F.lit(0)))).where(F.col("rank") <= top_k)
        ids = best.select("query", "list", "distance", F.explode(F.slice("ids", 1, top_k)).alias("id"))
        ranked, _ = work.keep("ranked", lambda: ids.withColumn("rank", by("distance", "id")).where(F.col("rank") <= top_k).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "distance", "list"))).alias("found")))
        return join_hot(asked.select("query_id", "query"), ranked, ["query"], "inner").select("query_id", F.inline("found")).select("query_id", "id", "distance", "rank", "list")

    def _bounded(self, rows: DataFrame, top_k: int) -> DataFrame:
        """rows (query, point, lower, upper) with `most`, the top_k-th smallest upper bound of the query, if it has as many."""
        nth = rows.withColumn("nth", F.row_number().over(W.partitionBy("query").orderBy("upper", "point")))
        most = F.coalesce(F.max(F.when(F.col("nth") == top_k, F.col("upper"))).over(W.partitionBy("query")), F.lit(float("inf")))
        return nth.withColumn("most", most).drop("nth")

    def _screened(self, probed: DataFrame, wanted: DataFrame, top_k: int, centroids: np.ndarray) -> DataFrame:
        """(query, list, point, lower, upper) of the points that may be among the top_k of a list that the query looks into.

        The rows of a list are dealt into blocks, so are the queries that look into it; each block of points meets each block
        of queries in one group, so that neither a list nor its queries are ever in one task.
        """
        dim = self.dim
        # a row for each list, MOST_LISTS at most
        asking = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("query_blocks"))
        blocks = F.broadcast(self._table("lists").select("list", F.ceil(F.col("n") / POINT_BLOCK).cast("int").alias("point_blocks")).join(asking, "list"))
        dealt = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        points = self._table("codes").select("list", "point", "code", "scale", "error").join(blocks, "list")
        points = points.select("list", "point", "code", "scale", "error", dealt("point", F.col("point_blocks")).alias("a"), each("query_blocks").alias("b"))
        asked = probed.join(wanted, "query").join(blocks, "list")
        asked = asked.select("list", "query", F.col("vector"), dealt("query", F.col("query_blocks")).alias("b"), each("point_blocks").alias("a"))

        def meet(key, queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            none = pd.DataFrame({"query": pd.Series(dtype=str), "list": pd.Series(dtype=np.int32), "point": pd.Series(dtype=str), "lower": pd.Series(dtype=float), "upper": pd.Series(dtype=float)})
            if not len(queries) or not len(held):
                return none
            centre = centroids[key[0]]
            codes = np.frombuffer(b"".join(held["code"]), np.int8).reshape(-1, dim) * held["scale"].to_numpy()[:, None]
            error, names, found = held["error"].to_numpy(), held["point"].to_numpy(), []
            sought = _matrix(queries["vector"], dim) - centre
            # subtracting the centroid rounds too, by the size of the numbers
            rounded = np.linalg.norm(centre) * 4 * np.finfo(float).eps
            for i in range(0, len(sought), _SLICE):
                away, slack = _distances(sought[i : i + _SLICE], codes)
                loose = error + slack + rounded
                lower, upper = away - loose, away + loose
                most = np.partition(upper, top_k - 1, axis=1)[:, top_k - 1] if len(names) >= top_k else np.full(len(away), np.inf)
                at, which = np.nonzero(lower <= most[:, None])
                found.append(pd.DataFrame({"query": queries["query"].to_numpy()[i : i + _SLICE][at], "list": np.int32(key[0]), "point": names[which], "lower": lower[at, which], "upper": upper[at, which]}))
            return pd.concat(found)

        keys = ("list", "a", "b")
        return asked.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(meet, "query string, list int, point string, lower double, upper double")


def nearest_others(found: DataFrame, top_k: int) -> DataFrame:
    """Of search() for the neighbours of indexed rows, asked for one more than wanted: the top_k without the row itself."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("rank"))
    return found.where("id <> query_id").withColumn("rank", rank).where(F.col("rank") <= top_k)


def fuse(rankings: dict[str, DataFrame], constant: int = 60, top_k: int = 10) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, id, rank) by name: (query_id, id, score, rank, and each ranking's own rank by its name).

    A row's score is the sum of 1 / (constant + rank) over the rankings that have it, in the order given; ties go by id.
    A ranking names an id once for a query; what it names more often counts by its best rank.
    """
    rows = None
    for name, frame in rankings.items():
        one = frame.select("query_id", "id", F.lit(name).alias("name"), F.col("rank").cast("int").alias("at"))
        rows = one if rows is None else rows.unionByName(one)
    met = rows.groupBy("query_id", "id").agg(*[F.min(F.when(F.col("name") == n, F.col("at"))).alias(n) for n in rankings])
    score = F.lit(0.0)
    for name in rankings:
        score = score + F.coalesce(F.lit(1.0) / (F.col(name) + constant), F.lit(0.0))
    scored = met.withColumn("score", score)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top_k).select("query_id", "id", "score", "rank", *rankings)
