import hashlib
import math
import random

import numpy as np
import pytest

from quillstone.llm import ball_kmeans
from quillstone.llm.ball_kmeans import assign, cluster_vectors, neighbours


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [min(max(math.floor(1024 * float(np.float32(x))), -ball_kmeans.BOUND), ball_kmeans.BOUND) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [list(v) for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        got = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), g in zip(kept, got) if g == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    got = [nearest(v) for _, v in kept]
    of = lambda j: sum(d for d, g in got if g == j)
    return sorted(((i, j, d, of(j), sum(d for d, _ in got), c[j]) for (i, _), (d, j) in zip(kept, got)), key=str)


def run(spark, rows, kind="float", **how):
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, cluster string, v int")
    return sorted((tuple(r) for r in cluster_vectors(frame.repartition(3), **how).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    point = lambda at, spread: [at[k] + rng.gauss(0, spread) for k in range(64)]
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, point(rng.choice(middles), rng.choice([0.01, 0.3]))) for i in range(120)]
    rows += [(200 + i, middles[0]) for i in range(60)]  # a third of all rows
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65), (304, [0.5] * 63 + [None]), (305, [0.5] * 63 + [math.nan]), (306, [math.inf] + [0.5] * 63)]
    rows += [(None, point(middles[1], 0.1)), (None, point(middles[2], 0.1)), (7, rows[7][1]), (8, point(middles[3], 0.1))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, "double") == [x for x in run(spark, rows, "double")]


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(i % 4)] + [0.0] * 63) for i in range(40)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len({r[1] for r in got}) == 4


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_clusters(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_large_components_do_not_overflow(spark):
    rows = [(i, [(-1.0) ** i * 3e38] * 64) for i in range(9)] + [(20 + i, [float(i)] * 64) for i in range(9)]
    assert run(spark, rows) == brute(rows)


def test_balls_leave_out_no_nearer_centroid_and_spare_distances():
    rng = np.random.default_rng(5)
    for spread in (3, 40, 400):
        middles = rng.integers(-500, 500, (40, 8))
        v = middles[rng.integers(0, 40, 3000)] + rng.integers(-spread, spread + 1, (3000, 8))
        plain = lambda c: ((v[:, None, :] - c[None]) ** 2).sum(2)
        c = v[:40].copy()
        cluster, distance = np.zeros(3000, np.int64), np.zeros(3000, np.int64)
        radius, moved, used = [None] * 40, np.ones(40, bool), []
        for _ in range(8):
            cluster, distance, n = assign(v, cluster, distance, neighbours(c, radius, moved))
            used.append(n)
            assert (cluster == plain(c).argmin(1)).all() and (distance == plain(c).min(1)).all()
            after = np.array([v[cluster == i].sum(0) // max(1, (cluster == i).sum()) if (cluster == i).any() else c[i] for i in range(40)])
            radius = [ball_kmeans._root(int(distance[cluster == i].max())) + ball_kmeans._root(int(((after[i] - c[i]) ** 2).sum())) if (cluster == i).any() else 0 for i in range(40)]
            moved, c = (after != c).any(1), after
        assert used[-1] < 3000 * 40 / (2 if spread < 400 else 1)


def test_rounds_without_moves_are_left_out(spark):
    rows = [(i, [float(i % 2) * 9] + [0.001 * i] * 63) for i in range(12)]
    counts = []
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    cluster_vectors(frame, clusters=2, rounds=50, counts=counts)
    assert counts[-1] == 0 and len(counts) < 10
