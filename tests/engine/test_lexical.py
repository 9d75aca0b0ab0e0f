import hashlib
import random
import sqlite3

import pytest

from quillstone.operators import inverted, lexical


def chunks(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, context string, text string")


def fts(rows, query, k=50):
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(chunk_id UNINDEXED, context, text, tokenize='porter unicode61')")
    db.executemany("INSERT INTO f VALUES (?,?,?)", [(i, c or "", t) for i, c, t in rows])
    match = " OR ".join(f'"{w}"' for w in query.split())  # a word with underscores is a phrase there
    return [(i, -s) for i, s in db.execute("SELECT chunk_id, bm25(f, 0.0, 1.0, 2.0) s FROM f WHERE f MATCH ? ORDER BY s, chunk_id LIMIT ?", (match, k))]


WORDS = "damage damages damaged liability liabilities consideration considerations contractual organization hopping hoping caresses ponies agreed feed relational conditional rational digitizer operator feudalism decisiveness hopefulness formality sensitivity triplicate formative electrical goodness revival allowance inference adjustment adoption controll roll probate rate cease happy sky cry café naïve protein synthesis the not 22 2b".split()


def test_scores_equal_sqlite(spark):
    rng = random.Random(1)
    rows = [(f"c{i:03d}", rng.choice([None, "", " ".join(rng.choices(WORDS, k=4))]), " ".join(rng.choices(WORDS, k=rng.randint(1, 30)))) for i in range(120)]
    frame = chunks(spark, rows)
    posted, sizes = lexical.postings(frame).cache(), lexical.lengths(frame).cache()
    for query in ("damages", "liability protein protein", "hoping not 22", "cafe naive relational", "decisive feudal electric adopt"):
        got = [(r.chunk_id, r.score) for r in lexical.search(posted, sizes, query).collect()]
        want = fts(rows, query)
        assert [i for i, _ in got] == [i for i, _ in want]
        assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, want))
    assert lexical.search(posted, sizes, "?!").count() == 0 == lexical.search(posted, sizes, "the", 0).count()
    with pytest.raises(ValueError):
        lexical.search(posted, sizes, "the", -1)


def test_clamped_terms_and_marks_rank_as_in_sqlite(spark):
    """A term of most chunks has an idf of 1e-6; its scores still differ by length. Queries and texts are divided alike."""
    rows = [(f"c{i:03d}", None, " ".join(["common", "filler"][: 1 + i % 2] + ["pad"] * (20 - i))) for i in range(20)]
    rows += [("x0", None, "नमस्ते दुनिया"), ("x1", None, "नम अन्य")]
    frame = chunks(spark, rows)
    posted, sizes = lexical.postings(frame).cache(), lexical.lengths(frame).cache()
    got, want = lexical.search(posted, sizes, "common", 5).collect(), fts(rows, "common", 5)
    assert [r.chunk_id for r in got] == [i for i, _ in want]
    assert all(abs(r.score - s) < 1e-15 for r, (_, s) in zip(got, want))
    assert [r.chunk_id for r in lexical.search(posted, sizes, "नमस्ते").collect()][0] == "x0"
    assert lexical.query_terms("cafe\u0301 a_b \u0301x", False) == ["cafe\u0301", "a", "b", "x"]


def test_a_search_without_postings_reads_texts_once(spark):
    rng = random.Random(4)
    rows = [(f"c{i:03d}", rng.choice([None, "", " ".join(rng.choices(WORDS, k=4))]), rng.choice([None, "", *[" ".join(rng.choices(WORDS, k=rng.randint(1, 30)))] * 8])) for i in range(90)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = chunks(spark, rows)
    frame = plain.mapInArrow(count, plain.schema)
    posted = {s: lexical.postings(plain, s).cache() for s in (False, True)}
    assert lexical.search_chunks(plain, "?!", 5, False).count() == 0
    for query, stemmed in (("liability protein protein not", False), ("hoping cafe relational 22", True)):
        seen.value = 0
        got = lexical.search_chunks(frame, query, 50, stemmed).collect()
        assert got == lexical.search(posted[stemmed], lexical.lengths(plain), query, 50, stemmed).collect()
        assert seen.value == len(rows)
    assert lexical.search_chunks(plain.limit(0), "the").count() == 0
    with pytest.raises(ValueError):
        lexical.search_chunks(plain, "the", -1)
    hits, stats = lexical.matches(chunks(spark, [("a", "x", "x y"), ("a", None, "x z"), ("b", "", "z"), ("a", None, "x")]), ["x"], False)
    assert [tuple(r) for r in hits.collect()] == [("a", 6, "x", 1, 3)] and tuple(stats.first()) == (4, 7 / 4)


def test_what_may_have_a_stem(spark):
    """A word's stem differs from its beginning in the last two characters at most; words that fold are always looked at."""
    rng = random.Random(6)
    ends = ["", "s", "es", "ed", "ing", "ies", "ational", "tional", "enci", "anci", "izer", "bli", "alli", "entli", "eli", "ousli", "ization", "ation", "ator", "alism", "iveness", "fulness", "ousness", "aliti", "iviti", "biliti", "logi", "icate", "iciti", "ical", "ement", "ion", "y", "e", "ll"]
    words = sorted({"".join(rng.choices("abcdeilnoprstuyz", k=rng.randint(1, 6))) + rng.choice(ends) + rng.choice(["", "", "ed", "ing", "s"]) for _ in range(20000)} | {"café", "naïves"})
    rows = spark.createDataFrame([(w, lexical.stem(w)) for w in words], "word string, stem string")
    for stem in rng.sample(sorted({lexical.stem(w) for w in words}), 8) + ["cafe"]:
        assert rows.where(~lexical._may_stem_to(rows.word, [stem])).where(rows.stem == stem).count() == 0
    assert all(lexical.stem(w)[:-2] == w[: len(lexical.stem(w)[:-2])] for w in words if w.isascii())


def test_stems_equal_sqlite():
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(t, tokenize='porter unicode61')")
    db.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    rng = random.Random(2)
    ends = ["", "s", "es", "ed", "ing", "ies", "ational", "tional", "izer", "ation", "ness", "ful", "ement", "ion", "ive", "ize", "ity", "ous", "ll", "e", "y", "al", "biliti", "logi"]
    words = sorted({"".join(rng.choices("abcdeilnoprstuy", k=rng.randint(2, 6))) + rng.choice(ends) for _ in range(4000)} | {w for w in WORDS if w.isascii()})
    db.executemany("INSERT INTO f(rowid, t) VALUES (?,?)", list(enumerate(words)))
    want = dict(db.execute("SELECT doc, term FROM v"))
    assert [(w, lexical.stem(w), want[i]) for i, w in enumerate(words) if lexical.stem(w) != want[i]] == []


def test_index_is_stale_after_any_change(spark, tmp_path):
    rows = [("a", "ctx", "protein"), ("b", None, "law")]
    frame = chunks(spark, rows)
    index = inverted.Index(spark, str(tmp_path / "i"))
    with pytest.raises(lexical.NotBuiltError):
        index.search("law")
    assert index.is_stale(frame)
    index.build(frame)
    assert not index.is_stale(frame) and index.search("laws").first().chunk_id == "b"
    assert index.is_stale(chunks(spark, [("a", "other", "protein"), rows[1]])) and index.is_stale(chunks(spark, rows[:1]))
    assert inverted.Index(spark, index.path, weights=(1.0, 1.0)).is_stale(frame) and inverted.Index(spark, index.path, "unicode61").is_stale(frame)
    index.invalidate()
    assert not index.built()
    with pytest.raises(ValueError):
        inverted.Index(spark, index.path, "porter'; drop")


def same(got, want):
    got = [(r.chunk_id, r.score) for r in got.collect()]
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, want))


def texts(rng, n, first=0):
    return [(f"c{first + i:04d}", rng.choice([None, "", " ".join(rng.choices(WORDS, k=4))]), " ".join(rng.choices(WORDS, k=rng.randint(0, 30)))) for i in range(n)]


def test_phrases_equal_sqlite(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, c, t.replace(" protein", rng.choice([" protein", "_protein"]))) for i, c, t in texts(rng, 150)]
    rows += [("x0", "a a a", "b a a a b"), ("x1", "a", "a b"), ("x2", "protein", "synthesis")]
    index = inverted.Index(spark, str(tmp_path / "i"))
    index.build(chunks(spark, rows))
    for query in ("protein_synthesis", "damage_liabilities not", "a_a", "a_b protein_synthesis_the", "the_the the", "gone_never", "sky__cry"):
        same(index.search(query), fts(rows, query))
    assert lexical.query_phrases("foo_Bar _x_ __ a", False) == [["foo", "bar"], ["x"], ["a"]]


def test_updates_equal_a_rebuild(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inverted, "MOST_SEGMENTS", 2)
    rng = random.Random(4)
    rows = dict((r[0], r) for r in texts(rng, 300))
    index = inverted.Index(spark, str(tmp_path / "i"))
    index.build(chunks(spark, list(rows.values())))
    seen = []
    for step in range(3):
        changed = [(i, *texts(rng, 1)[0][1:]) for i in rng.sample(sorted(rows), 3)] + texts(rng, 3, 1000 + 10 * step)
        gone = [i for i in rng.sample(sorted(rows), 4) if i not in {r[0] for r in changed}]
        index.update(chunks(spark, changed + changed[:1]), spark.createDataFrame([(i,) for i in [*gone, "never"]], "chunk_id string"))
        rows |= {r[0]: r for r in changed}
        rows = {i: r for i, r in rows.items() if i not in gone}
        whole = chunks(spark, list(rows.values()))
        assert not index.is_stale(whole) and index.is_stale(whole.limit(5))
        fresh = inverted.Index(spark, str(tmp_path / f"fresh{step}"))
        fresh.build(whole)
        for query in ("damages", "liability protein protein", "protein_synthesis the"):
            assert index.search(query).collect() == fresh.search(query).collect()
            same(index.search(query), fts(list(rows.values()), query))
        seen.append((len(index.version()["segments"]), len(index.version()["marks"])))
    assert seen == [(2, 1), (1, 0), (2, 1)]
    index.update(chunks(spark, []), whole.select("chunk_id"))
    assert index.search("the").count() == 0


def test_blocks_that_cannot_reach_the_best_are_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK_CHUNKS", 8)
    rng = random.Random(5)
    rows = [(f"c{i:04d}", None, " ".join(["common"] * (1 + (i % 97 == 0) * 9) + ["rare"] * (i % 211 == 0) + rng.choices(["x", "y", "z"], k=20))) for i in range(2000)]
    index = inverted.Index(spark, str(tmp_path / "i"))
    index.build(chunks(spark, rows))
    index.update(chunks(spark, []), spark.createDataFrame([(f"c{i:04d}",) for i in range(0, 2000, 97 * 3)], "chunk_id string"))
    for query, k in (("common", 5), ("common rare", 5), ("rare", 3), ("common rare x", 40)):
        pruned = index.search(query, k).collect()
        report = index.report
        assert pruned == index.search(query, k, prune=False).collect() and len(pruned) == k
        if query != "rare":
            assert report.blocks > 100
        if query in ("common", "common rare"):
            assert report.skipped > report.blocks / 2


def test_terms_are_grouped_where_their_chunk_lies(spark):
    """No posting is shuffled for its counts or places, and rows that repeat an id are still one chunk."""
    rows = [("a", "x y", "y x y"), ("b", None, "x"), ("c", "", "?!")]
    for stemmed in (False, True):
        for made in (lexical.postings, inverted.positional_postings):
            assert "Exchange" not in made(chunks(spark, rows), stemmed)._jdf.queryExecution().executedPlan().toString()
    posted = {(r.term, r.chunk_id): (r.length, r.context, r.text) for r in inverted.positional_postings(chunks(spark, rows), False).collect()}
    assert posted == {("x", "a"): (5, [0], [1]), ("y", "a"): (5, [1], [0, 2]), ("x", "b"): (1, [], [0])}
    again = [*rows, ("b", "x", "z x"), (None, None, "x"), (None, None, "x")]
    counts = {(r.term, r.chunk_id): (r.tf_context, r.tf_text) for r in lexical.postings(chunks(spark, again), False).collect()}
    assert counts == {("x", "a"): (1, 1), ("y", "a"): (1, 2), ("x", "b"): (1, 2), ("z", "b"): (0, 1), ("x", None): (0, 2)}
    assert {r.chunk_id: r.text for r in inverted.positional_postings(chunks(spark, again), False).where("term = 'x'").collect()} == {"a": [1], "b": [0, 1], None: [0, 0]}


def test_an_index_shuffles_texts_not_postings(spark, tmp_path):
    """A posting names its chunk by a number in its block; a segment's rows come from the exchange of the texts alone. An id counts once."""
    index = inverted.Index(spark, str(tmp_path / "i"), "unicode61")
    frame = chunks(spark, [("a", "x", "y x"), ("b", None, "x"), ("b", None, "x"), ("c", None, None)])
    made, docs = index._of(frame, 1, 10)
    plan = made.sortWithinPartitions("term", "block")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1
    index.build(frame)
    version = index.version()
    assert (version["segments"][0]["n"], version["segments"][0]["tokens"]) == (3, 4)
    assert "chunk_id" not in index._read(version, "postings").schema.simpleString()
    assert sorted(r.chunk_id for r in index.search("x").collect()) == ["a", "b"]


def test_the_digest_reads_packed_hashes_in_order(spark):
    rows = [(f"c{i % 900:04d}", None if i % 7 == 0 else f"k{i % 3}", f"text {i}") for i in range(1000)]
    frame = spark.createDataFrame(rows, "chunk_id string, context string, text string").repartition(5)
    hashes = sorted((c, hashlib.sha256("\x1f".join((c, k or "", t)).encode()).hexdigest()) for c, k, t in rows)
    packed = lexical.packed_hashes(frame).collect()
    assert sum(len(r.hashes) for r in packed) == 32 * len(rows) and len(packed) <= len(rows) / lexical.PACKED + 4
    assert b"".join(r.hashes for r in sorted(packed)).hex() == "".join(h for _, h in hashes)
    assert tuple(lexical.corpus_digest(frame).first()) == (1000, hashlib.sha256("".join(h for _, h in hashes).encode()).hexdigest())
    assert tuple(lexical.corpus_digest(frame.limit(0)).first()) == (0, hashlib.sha256(b"").hexdigest())
