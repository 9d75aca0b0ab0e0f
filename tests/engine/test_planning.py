import json

import pytest
from pyspark.sql import functions as F

from quillstone.sources import planning


def test_urls(spark):
    cases = {
        "corpus/x.html": "local", "file:///a/b": "local", "C:/x": "local", "https://arxiv.org/abs/1706.03762v7": "arxiv",
        "https://export.arxiv.org/pdf/cs/0701001v2.pdf": "arxiv", "https://arxiv.org.evil.com/abs/1": "generic", "HTTPS://E.com": "generic",
    }
    frame = spark.createDataFrame([(u,) for u in cases], "u string")
    rows = {r.u: r for r in frame.select("u", planning.recipe(F.col("u")).alias("r"), planning.arxiv_id(F.col("u")).alias("a")).collect()}
    assert {u: r.r for u, r in rows.items()} == cases
    assert rows["https://arxiv.org/abs/1706.03762v7"].a == "1706.03762" and rows["https://export.arxiv.org/pdf/cs/0701001v2.pdf"].a == "cs/0701001"
    match = planning.host_matches(F.col("u"), ["arxiv.org"])
    assert {r.u for r in frame.where(match).collect()} == {u for u, k in cases.items() if k == "arxiv"}


ROW = {"doc_id": "a", "url": "u", "format": "pdf", "license": "l", "license_ok": True, "version": "v"}


def test_manifest_rules(spark, tmp_path):
    path = tmp_path / "m.json"
    for rows, rule in (([ROW | {"format": "doc"}], "format"), ([ROW | {"license_ok": "yes"}], "license"), ([ROW, ROW], "duplicate"), ({}, "list"), ([1], "mapping"), ([{"doc_id": "a"}], "lacks")):
        path.write_text(json.dumps(rows))
        with pytest.raises(planning.ManifestError, match=rule):
            planning.load_manifest(spark, str(path))
    path.write_text(json.dumps([ROW, ROW | {"doc_id": "b", "url": "https://arxiv.org/abs/1.2", "version": "v3"}]))
    manifest = planning.load_manifest(spark, str(path))
    assert manifest.where("slug = 'a'").first().domain == "unspecified"
    assert [tuple(r) for r in planning.plan_fetches(manifest, ["b"]).collect()] == [("b", "arxiv", "https://arxiv.org/html/1.2v3")]
    with pytest.raises(planning.ManifestError):
        planning.plan_fetches(manifest, ["zzz"])


def test_pins_and_cached_files(spark, tmp_path):
    (tmp_path / "a.meta.json").write_text(json.dumps({"doc_id": "a", "raw_filename": "a.pdf", "resolved_version": "v9"}))
    (tmp_path / "b.meta.json").write_text(json.dumps({"doc_id": "b", "raw_filename": "b.pdf"}))
    (tmp_path / "c.meta.json").write_text("{broken")
    (tmp_path / "a.pdf").write_bytes(b"x")
    pins, files = planning.read_pins(spark, str(tmp_path / "*.meta.json")), planning.read_raw(spark, str(tmp_path / "*.pdf"))
    assert {r.slug for r in pins.collect()} == {"a", "b"} and [r.slug for r in planning.cached(pins, files).collect()] == ["a"]
    manifest = planning.manifest_frame(spark, [ROW, ROW | {"doc_id": "b", "url": "https://e.com"}, ROW | {"doc_id": "d", "url": "gone.html"}])
    got = {r.slug: (r.status, r.resolved_version) for r in planning.fetch_decisions(manifest, pins, files).collect()}
    assert got == {"a": ("cached", "v9"), "b": ("ok", "v"), "d": ("error", None)}
    assert planning.CorpusConfig.of({"chunk": None}).chunk == {}
