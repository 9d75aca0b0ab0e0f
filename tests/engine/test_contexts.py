import hashlib
import json

from quillstone.operators import contexts
from quillstone.sources import planning


def test_pin_files_are_read_merged_and_replaced(spark, tmp_path):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    pin = lambda c, t: {"context": c, "text_sha256": sha(t), "window_index": 0}
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": "a", "model": "m", "prompt_version": 1, "contexts": {"c1": pin(" good ", "t1"), "c2": pin("x", "changed"), "c3": pin(" ", "t3")}}))
    (tmp_path / "b.json").write_text("{broken")
    files = contexts.read_pin_files(spark, str(tmp_path / "*.json"))
    pins = contexts.pin_rows(files)
    assert pins.count() == 3
    chunks = spark.createDataFrame([(f"c{i}", f"t{i}") for i in range(1, 5)], "chunk_id string, text string")
    valid = contexts.valid_pins(pins, chunks, "m", 1)
    assert [tuple(r) for r in valid.collect()] == [("c1", "good")]
    assert contexts.valid_pins(pins, chunks, "other", 1).count() == 0 == contexts.valid_pins(pins, chunks, "m", 2).count()
    made = lambda todo: todo.selectExpr("chunk_id", "case when chunk_id = 'c4' then ' new ' else ' ' end as context")
    rows = {r.chunk_id: (r.origin, r.context) for r in contexts.with_contexts(chunks, valid, made).collect()}
    assert rows == {"c1": ("pinned", "good"), "c2": ("missing", None), "c3": ("missing", None), "c4": ("generated", "new")}
    stats = contexts.context_stats(contexts.with_contexts(chunks, valid, made))
    assert tuple(stats.select("pinned", "generated", "missing").first()) == (1, 1, 2)
    assert stats.select(contexts.shortfall(stats, True)).first()[0] == "error"
    new = spark.createDataFrame([("c1", "newer", "s", 1)], "chunk_id string, context string, text_sha256 string, window_index int")
    assert {r.chunk_id: r.context for r in contexts.merge_pins(pins, new, "m", 1).collect()} == {"c1": "newer", "c2": "x", "c3": " "}
    assert [r.chunk_id for r in contexts.merge_pins(pins, new, "m", 2).collect()] == ["c1"]
    for _ in range(2):
        contexts.save_pin_files(files, str(tmp_path / "saved"))
        assert contexts.read_pin_files(spark, str(tmp_path / "saved")).count() == 1
    usage = spark.createDataFrame([(1, 2), (3, None)], "input long, output long")
    assert tuple(contexts.usage_total(usage, "input", "output").first()) == (4, 2)


def test_many_pins_survive_their_files_and_a_crash(spark, tmp_path):
    one = lambda k: {"doc_id": f"d{k}", "model": "m", "prompt_version": 1, "contexts": {f"c{k}": {"context": "x", "text_sha256": "s", "window_index": k}}}
    for k in range(6):
        (tmp_path / f"{k}.json").write_text(json.dumps(one(k), indent=1))
    (tmp_path / "broken.json").write_text('{"doc_id": "y", "mod')
    (tmp_path / "list.json").write_text("[1]")
    files = contexts.read_pin_files(spark, str(tmp_path / "*.json"))
    assert files.count() == 6 == contexts.pin_rows(files).count()
    at = str(tmp_path / "saved")
    contexts.save_pin_files(files.coalesce(1), at)
    again = contexts.read_pin_files(spark, at)
    assert sorted(again.collect()) == sorted(files.collect())
    contexts.save_pin_files(again.where("doc_id <> 'd0'"), at)  # over what it is read from
    assert contexts.read_pin_files(spark, at).count() == 5
    (tmp_path / "saved").rename(tmp_path / "saved.old")  # cut off between the renames
    planning.restore_json(spark, at)
    assert contexts.read_pin_files(spark, at).count() == 5


def test_fetch_pins_are_read_back(spark, tmp_path):
    pins = spark.createDataFrame([(f"s{k}", "v1") for k in range(6)], "slug string, resolved_version string")
    planning.write_pins(pins.coalesce(1), str(tmp_path / "pins"))
    got = planning.read_pins(spark, str(tmp_path / "pins"))
    assert got.count() == 6 and {(r.slug, r.resolved_version) for r in got.collect()} == {tuple(r) for r in pins.collect()}
