from quillstone.streaming import ingest


def test_files_are_ingested_once(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "out")
    frame = lambda *rows: spark.createDataFrame(rows, ingest.SCHEMA)
    frame(("u", "v", "a\nb"), ("w", "v", None), (None, "v", "x")).write.parquet(source)
    for _ in range(2):
        ingest.start(ingest.new_documents(spark, source), store, str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(store).count() == 3
    frame(("u", "v", "a\nb"), ("n", "v", "c")).write.mode("append").parquet(source)
    ingest.start(ingest.new_documents(spark, source), store, str(tmp_path / "state")).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(store).collect()) == ["", "a", "b", "c"]


def test_a_batch_reads_only_buckets_that_may_hold_its_ids(spark, tmp_path):
    frame = lambda first, n: spark.createDataFrame([(f"u{k}", "v", "a\nb") for k in range(first, first + n)], ingest.SCHEMA)
    seen = []
    write = ingest.upsert(str(tmp_path / "store"), seen)
    write(frame(0, 300), 0)
    write(frame(1000, 40), 1)
    write(frame(298, 4), 2)
    write(frame(298, 4), 2)  # a batch that runs again
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2 * (300 + 40 + 2)
    (one, none, all_one), (two, some, all_two), again = seen
    assert all_one > 200 and none <= 2 and 1 <= some <= 6 < all_two and again == (2, some, all_two)
    ids = [r.chunk_id for r in spark.read.parquet(str(tmp_path / "store")).collect()]
    assert len(ids) == len(set(ids))


def test_filters_lose_no_id(spark):
    rows = spark.createDataFrame([(f"{k % 3}", f"c{k}") for k in range(500)], "bucket string, chunk_id string")
    filters = ingest.blooms(rows.where("chunk_id < 'c3'")).selectExpr("0 AS batch", "*")
    found = {r.chunk_id for r in ingest.possible(rows, filters).collect()}
    held = {f"c{k}" for k in range(500) if f"c{k}" < "c3"}
    assert held <= found and len(found - held) < 10


def test_filters_are_asked_by_hash(spark):
    """An id goes to the filters as 8 bytes, and its bits are told apart in its row."""
    rows = spark.createDataFrame([(f"{i % 4:02d}", f"{i % 4:02d}-{i}") for i in range(400)], "bucket string, chunk_id string")
    filters = ingest.blooms(rows.where("bucket < '02'")).selectExpr("7 AS batch", "*")
    found = ingest.possible_hashes(rows, filters)
    assert set(found.columns) == {"batch", "bucket", "hash"}
    held = rows.where("bucket < '02'").selectExpr("bucket", "xxhash64(chunk_id) AS hash")
    assert held.join(found, ["bucket", "hash"], "left_anti").isEmpty() and found.where("bucket >= '02'").isEmpty()
