import hashlib
import json

from pyspark.sql import functions as F

from quillstone.functions import ids
from quillstone.functions import text as tx


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).cast("array<string>").alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first().x


def test_ids_have_their_frozen_values(spark):
    u, v = F.lit("u"), F.lit("v")
    assert one(spark, ids.doc_id(u, v), a=1) == "60cedb20de8f964f7894f1d68ea14786b32581ddf68e6f1a434246068b421c30"
    assert one(spark, ids.chunk_id(u, v, F.lit(0)), a=1) == "b031bfb4c16489a6756f381befef44f71a2354119da59e86ed233973d0557ca6"
    assert one(spark, ids.doc_id(u, F.lit(None).cast("string")), a=1) is None


def test_edge_ids_are_of_ascii_json(spark):
    texts = ["plain", "§ 1303", 'a"b\\c\n\t', "é😀", "\x7f\x01", None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ids.edge_id(F.lit("f"), F.col("t"), F.lit("k"), F.col("t")).alias("e"))
    for r in frame.collect():
        want = json.dumps(["f", r.t, "k", r.t], separators=(",", ":"))
        assert r.e == hashlib.sha256(want.encode()).hexdigest(), want


def test_token_estimates_and_headings(spark):
    assert [one(spark, tx.est_tokens(F.col("t")), t="x" * n) for n in (0, 40, 41)] == [1, 10, 11]
    assert one(spark, tx.heading_line(F.col("p")), p=["a", " ", "b"]) == "## a > b"
    assert one(spark, tx.heading_line(F.col("p")), p=[]) == "## (no heading)"


def test_boilerplate(spark):
    link = "[x](https://a.b/c)"
    cases = {
        "\n".join([link] * 6): True, "\n".join([link] * 4): False, "\n".join([link] * 5 + ["prose"]): False, "\u2028".join([link] * 6): True,
        "Code: A B\nSelect Code": True, "Code: " + "x" * 300 + " Select Code": False, "": False, "prose with [x](https://a.b/c)": False,
    }
    for t, want in cases.items():
        assert one(spark, tx.is_boilerplate(F.col("t")), t=t) is want, t


def test_queries_and_suspicion(spark):
    assert one(spark, tx.match_query(F.col("t")), t="Article 22(1)") == '"Article" OR "22" OR "1"'
    assert one(spark, tx.match_query(F.col("t")), t="?! --") == ""
    assert one(spark, tx.match_query(F.col("t")), t="café foo_bar") == '"café" OR "foo_bar"'
    odd = tx.is_suspicious(F.col("c"), F.col("t"))
    assert one(spark, odd, c="too short", t="x") is True
    assert one(spark, odd, c="a b c d e", t=" a b c d e and more") is True
    assert one(spark, odd, c="a b c d e", t="other") is False
    assert one(spark, odd, c="w " * 121, t="other") is True


def test_messages_cache_the_window_only(spark):
    blocks = json.loads(one(spark, tx.prompt_messages(F.lit("h"), F.lit("w"), F.lit("c")), a=1))
    assert [b.get("cache_control") for b in blocks] == [{"type": "ephemeral"}, None] and blocks[0]["text"] == "h\n\nw"
