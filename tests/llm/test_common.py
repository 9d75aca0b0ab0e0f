import random

import pytest
from pyspark.sql import functions as F

from quillstone.llm import common


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_groups_is_a_plain_join(spark, monkeypatch, how):
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    keys = [1] * 50 + [2] * 30 + [3] * 5 + [None] * 3 + list(range(10, 40))
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    groups = rows.where("k < 30").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = sorted(map(str, rows.join(groups, "k", how).select("k", "i", "n").collect()))
    for small in (True, False):
        assert sorted(map(str, common.join_groups(rows, groups, ["k"], "n", len(keys), small, how).select("k", "i", "n").collect())) == plain


@pytest.mark.parametrize("few", [10**6, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "BROADCAST_ROWS", few)
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    rng = random.Random(6)
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(200, 201 + k) for k in range(40)] + [(300 + k, 301 + k) for k in range(20)] + [(5, 5)]
    root = {n: n for e in edges for n in e}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = common.components(spark.createDataFrame(edges, "a int, b int"), "a", "b", "test").collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in got} == {n: find(n) for n in linked} and len(got) == len(linked)


def test_join_spread_is_a_plain_join_in_which_no_task_gets_a_hot_key(spark):
    rows = spark.createDataFrame([(1 if k % 3 == 0 else k, k) for k in range(900)], "a int, b int")
    values = spark.createDataFrame([(k, f"text {k}") for k in range(0, 900, 2)] + [(1, "one")], "a int, text string")
    plain = sorted(map(tuple, rows.join(values, "a").select("a", "b", "text").collect()))
    for few in (10**6, 0):
        got = common.join_spread(rows, values, "a", "b", per=10, few=few)
        assert sorted(map(tuple, got.select("a", "b", "text").collect())) == plain
    for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(k, v)
    try:
        placed = common.join_spread(rows, values, "a", "b", per=10, few=0).where("a = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(k)
    assert len(placed) == 4 and max(r["count"] for r in placed) < 150


class Session:
    """What shared_dir() asks of a session."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


@pytest.mark.parametrize("master", ["local[4]", "local-cluster[3,2,3000]", "yarn"])
def test_shared_folder_comes_from_the_session(master):
    assert common.shared_dir(Session(master, {"spark.checkpoint.dir": "hdfs://store/shared/"})) == "hdfs://store/shared"


def test_only_one_machine_may_leave_the_shared_folder_unset():
    assert common.shared_dir(Session("local[4]", {})) == "/tmp/checkpoints"
    for master in ("local-cluster[3,2,3000]", "yarn"):
        with pytest.raises(ValueError):
            common.shared_dir(Session(master, {}))
