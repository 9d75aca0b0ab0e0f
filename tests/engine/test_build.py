import json
import re

import pytest

from quillstone import catalog
from quillstone.functions import ids
from quillstone.operators.chunking import html_blocks, parse_pages
from quillstone.plans import build
from quillstone.plans.stages import Stages

GOOD = "<h1>T</h1><p>see Article 2(1)</p><h2>Article 2</h2><p>a rule</p>"
BAD = "<![foo[x]]>"


def inputs(spark, n=100, bad=(7,), unpinned=(), unpaged=()):
    manifest = spark.createDataFrame([(f"s{k}", f"https://x.example/{k}", []) for k in range(n)], "slug string, url string, references array<string>")
    pins = spark.createDataFrame([(f"s{k}", None if k in unpinned else "v1") for k in range(n)], "slug string, resolved_version string")
    pages = spark.createDataFrame([(f"s{k}", (BAD if k in bad else "") + GOOD) for k in range(n) if k not in unpaged], "slug string, html string")
    return manifest, pins, pages, spark.createDataFrame([], "chunk_id string, model string, prompt_version int, context string, text_sha256 string")


def empty(spark):
    return catalog._empty_store(spark, None)


def plans(spark):
    """The final plans of all queries so far."""
    store = spark._jsparkSession.sharedState().statusStore()
    seen = store.executionsList()
    return [seen.apply(k).physicalPlanDescription() for k in range(seen.size())]


def test_one_bad_page_in_a_hundred(spark):
    before = len(plans(spark))
    stages = Stages(spark)
    made = build.build_corpus(empty(spark), *inputs(spark), "m", 1, stages=stages)
    assert made.counts["built"] == made.store.docs.count() == 99 and made.counts["errors"] == 1
    (error,) = made.errors.collect()
    assert error.slug == "s7" and "foo" in error.error
    assert made.run.first().status == "partial" and json.loads(made.run.first().stats) == made.counts
    assert made.store.edges.groupBy("edge_type").count().count() == 2
    ran = [p.split("== Initial Plan ==")[0] for p in plans(spark)[before:]]
    trees = [p.split("\n\n")[0] for p in ran]
    assert sum("MapInArrow" in p for p in trees) == 1
    exchanges = sum(len(re.findall(r"\bExchange\b", p)) for p in trees)
    assert exchanges < 40, exchanges


def test_a_build_goes_on_where_it_ended(spark, monkeypatch):
    stages = Stages(spark)
    monkeypatch.setattr(build, "resolve", lambda found: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build.build_corpus(empty(spark), *inputs(spark, 5, ()), "m", 1, stages=stages)
    monkeypatch.undo()
    again = Stages(spark, stages.path)
    made = build.build_corpus(empty(spark), *inputs(spark, 5, ()), "m", 1, stages=again)
    assert "parsed" in stages.made and again.made == ["resolved", "edges"]
    plain = build.build_corpus(empty(spark), *inputs(spark, 5, ()), "m", 1)
    assert made.counts == plain.counts and plain.counts["built"] == 5 and plain.run.first().status == "ok"
    again.drop()
    with pytest.raises(Exception):
        made.store.docs.count()


def test_what_stands_is_skipped_and_what_has_left_the_manifest_goes(spark, tmp_path):
    manifest, pins, pages, contexts = inputs(spark, 6, ())
    first = build.build_corpus(empty(spark), manifest.where("slug <> 's5'"), pins, pages, contexts, "m", 1)
    build.save(first.store, str(tmp_path / "store"))
    store = build.load(spark, str(tmp_path / "store"))
    some = manifest.where("slug in ('s1', 's5')")
    part = build.build_corpus(store, some, pins, pages, contexts, "m", 1, only=["s5"])
    assert (part.counts["built"], part.counts["pruned"], part.store.docs.count()) == (1, 0, 6)
    failing = build.build_corpus(store, some, pins, inputs(spark, 6, (5,))[2], contexts, "m", 1)
    assert (failing.counts["built"], failing.counts["pruned"], failing.counts["errors"], failing.store.docs.count()) == (0, 0, 1, 5)
    whole = build.build_corpus(store, some, pins, pages, contexts, "m", 1)
    assert (whole.counts["built"], whole.counts["skipped"], whole.counts["pruned"]) == (1, 1, 4)
    assert sorted(r.slug for r in whole.store.docs.collect()) == ["s1", "s5"]
    kept = {r.chunk_id for r in whole.store.chunks.collect()}
    assert {r.from_chunk for r in whole.store.edges.collect()} <= kept and len(kept) == whole.store.chunks.count() == 4
    assert sorted(r.canonical_url[-1] for r in whole.store.sources.collect()) == ["0", "1", "2", "3", "4", "5"]


def test_required_contexts_pins_pages_and_an_empty_manifest(spark):
    args = inputs(spark, 8, (1,), (2,), (3,))
    made = build.build_corpus(empty(spark), *args, "m", 1, require_context=True)
    assert {r.slug: r.error.split(":")[0] for r in made.errors.collect()} == {"s1": "AssertionError", "s2": "no pin", "s3": "no page", "*": "10 of 10 chunks have no context"}
    assert made.counts["errors"] == 4 and made.run.first().status == "partial"
    noted = build.build_corpus(empty(spark), *args, "m", 1)
    assert noted.run.first().note == "10 of 10 chunks have no context" and noted.counts["errors"] == 3
    none = build.build_corpus(empty(spark), *(x.limit(0) for x in args), "m", 1)
    assert set(none.counts.values()) == {0} and none.run.first().status == "ok" and none.store.chunks.count() == 0


def test_headings_end_at_level_six(spark):
    pages = spark.createDataFrame([(1, "<h7>seven</h7><h²>two</h²><h1>one</h1><p>x"), (2, None), (3, BAD)], "page_id long, html string")
    rows = html_blocks(pages, "page_id", "html").collect()
    assert [(r.doc, r.kind, r.level, r.text) for r in rows] == [("1", "text", 0, "seventwo"), ("1", "heading", 1, "one"), ("1", "text", 0, "x")]
    assert [(r.doc, r.pos) for r in parse_pages(pages, "page_id", "html").where("error is not null").collect()] == [("3", 0)]
