import random
import re

import pytest

from quillstone.operators import citations, gates, graph
from quillstone.plans import build


def frame(spark, rows):
    return spark.createDataFrame([(d, i, f"{d}{i}", t, h) for d, i, t, h in rows], "doc_id string, chunk_index long, chunk_id string, text string, heading_path array<string>")


def test_patterns_equal_python(spark):
    rng = random.Random(5)
    parts = ["Article", "Articles", " ", "\t", "22", "5th", "22a", "(1)", "Recital", "§", "Section", "Sections", "2-201", "1.01", "arXiv:", "1706.03762", "doi:", "10.1000/Ab.c)", "Roe", "v.", "Wade", "Hamer", "é", "\n", "٣", "x", "."]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(1500)]
    rows = frame(spark, [("d", i, t, []) for i, t in enumerate(texts)])
    want, heads = set(), set()
    for i, t in enumerate(texts):
        seen = set()
        end = 0
        for line in t.split("\n"):
            end += len(line)
            header = [(k, m.group(1)) for k, p in citations.ANCHORS if (m := re.match(p[4:].replace(r"\z", r"\Z"), line))]
            if header:
                if header[0] not in seen:
                    seen.add(header[0])
                    heads.add((f"d{i}", *header[0], end))
            else:
                for kind, p in (x for s in citations.REFERENCES.values() for x in s):
                    flags = re.I if p.startswith("(?Ui)") else 0
                    for m in re.finditer(p[p.index(")") + 1 :], line, flags):
                        want.add((f"d{i}", kind, m.group(1).lower() if kind == "case" else m.group(1)))
            end += 1
    got = citations.references(rows).collect()
    assert {(r.chunk_id, r.kind, r.value) for r in got} == want and len(got) == len(want)
    assert {(r.chunk_id, r.kind, r.value, r.end) for r in citations.text_anchors(rows).collect()} == heads


def test_header_lines_are_looked_for_once(spark):
    """A line is matched and its number taken once for each pattern, and only in lines that name what the pattern does."""
    plan = citations.text_anchors(frame(spark, [("d", 0, "x", [])]))._jdf.queryExecution().optimizedPlan().toString()
    for _, pattern in citations.ANCHORS:
        assert 0 < plan.count(pattern) <= 2


def test_first_definer_and_thin_headers(spark):
    rows = frame(spark, [("a", 3, "Article 22\nlate", []), ("a", 1, "Article 22\nfirst", []), ("a", 2, "body", ["T", " 1201. "]), ("b", 0, "x\nArticle 30\n 1.", []), ("b", 1, "long body", ["CHAPTER 2 [1201 - 1206]"])])
    index = lambda n: {(r.doc_id, r.kind, r.value): r.target for r in graph.anchor_index(rows, n).collect()}
    assert index(0) == {("a", "article", "22"): "a1", ("a", "section", "1201"): "a2", ("b", "article", "30"): "b0"}
    assert index(200) == {("a", "article", "22"): "a2", ("a", "section", "1201"): "a2", ("b", "article", "30"): "b1"}


def test_scope_ambiguity_and_global_kinds(spark):
    manifest = spark.createDataFrame(
        [("E", "https://e.eu/x", ["G"]), ("G", "https://g.eu/x", []), ("A", "https://a.eu/x", []), ("P", "https://arxiv.org/abs/1706.03762v2", [])],
        "slug string, url string, references array<string>",
    )
    pins = spark.createDataFrame([(s, "v1") for s in "EGAP"], "slug string, resolved_version string")
    known = {r.slug: r.doc_id for r in graph.documents_of(manifest, pins).collect()}
    rows = frame(spark, [(known["E"], 0, "see Article 22(1), arXiv:1706.03762 and Article 99", []), (known["G"], 0, "Article 22\nx", []), (known["A"], 0, "Article 22\ny", []), (known["P"], 0, "paper", [])])
    edges, stats = graph.build_graph(rows, manifest, pins)
    to = {r.provenance: r.to_chunk for r in edges.where("edge_type = 'references'").collect()}
    assert to == {"Article 22(1)": known["G"] + "0", "arXiv:1706.03762": known["P"] + "0", "Article 99": None}
    assert stats.first().asDict() == {"adjacent": 0, "resolved": 2, "unresolved": 1, "ambiguous": 0, "self_citations": 0, "edges": 3}
    wider = spark.createDataFrame([("E", "https://e.eu/x", ["G", "A", "gone"]), *[tuple(r) for r in manifest.where("slug <> 'E'").collect()]], manifest.schema)
    assert graph.build_graph(rows, wider, pins)[1].first().ambiguous == 1
    assert graph.build_graph(rows, manifest, pins, record_unresolved=False)[0].count() == 2
    again = graph.replace_edges(edges, edges, ["references", "adjacent"])
    assert again.count() == edges.count() == edges.select("edge_id").distinct().count()


def test_gates(spark):
    rows = spark.createDataFrame([("d", 0, "one", "text"), ("d", 1, "two", "table")], "doc_id string, chunk_index long, text string, chunk_type string")
    fixtures = spark.createDataFrame([("span", "d", ["one\ntwo"], None), ("table", "d", None, ["one"]), ("gone", "x", ["one"], None)], "name string, doc_id string, must_contain array<string>, must_contain_in_table array<string>")
    assert {r.name: r.passed for r in gates.structure_gate(fixtures, rows).collect()} == {"span": True, "table": False, "gone": False}
    assert gates.all_passed(fixtures.limit(0).selectExpr("true as passed")).first().passed is True
    pending = spark.createDataFrame([(True, False), (False, True)], "passed boolean, pending boolean")
    assert gates.all_passed(pending).first().passed is True


def test_needles_are_found_as_in_the_whole_document(spark):
    rng = random.Random(3)
    docs = {f"d{d}": [("".join(rng.choices("ab\n", k=rng.choice([0, 0, 1, 3, 12, 60]))), rng.choice(["text", "table"])) for _ in range(rng.randint(1, 12))] for d in range(25)}
    rows = [(d, i, t, k) for d, x in docs.items() for i, (t, k) in enumerate(x)]
    fixtures, want = [], {}
    for n in range(150):
        d = rng.choice([*docs, "none"])
        needle = lambda: "".join(rng.choices("ab\n", k=rng.choice([0, 1, 3, 5, 8])))
        anywhere, in_table = [needle() for _ in range(2)], [needle()]
        whole, tables = ("\n".join(t for t, k in docs.get(d, []) if k in some) for some in (("text", "table"), ("table",)))
        fixtures.append((f"f{n}", d, anywhere, in_table))
        want[f"f{n}"] = [x for x in anywhere if x not in whole] + [x for x in in_table if x not in tables]
    frame = spark.createDataFrame(rows, "doc_id string, chunk_index long, text string, chunk_type string")
    got = gates.structure_gate(spark.createDataFrame(fixtures, "name string, doc_id string, must_contain array<string>, must_contain_in_table array<string>"), frame).collect()
    assert {r.name: list(r.missing) for r in got} == want and all(r.passed == (not want[r.name]) for r in got)


def test_a_third_of_all_chunks_cite_one_paper(spark):
    manifest = spark.createDataFrame([(f"s{k}", f"https://arxiv.org/{'abs' if k < 9 else 'pdf'}/2001.{10000 + min(k, 8)}" if k else "https://x.example/big", []) for k in range(10)], "slug string, url string, references array<string>")
    pins = spark.createDataFrame([(f"s{k}", "v1") for k in range(10)], "slug string, resolved_version string")
    known = {r.slug: r.doc_id for r in graph.documents_of(manifest, pins).collect()}
    text = lambda k: "arXiv:2001.10001" if k % 3 == 0 else f"arXiv:2001.{10000 + k % 9} and Article {k % 5}(1)"
    rows = [(known["s0"], k, text(k), []) for k in range(600)] + [(known[f"s{k}"], 0, "a paper", []) for k in range(1, 10)]
    edges, stats = graph.build_graph(frame(spark, rows), manifest, pins)
    got = stats.first()
    want = sum(1 for k in range(600) if k % 3 == 0) + sum(1 for k in range(600) if k % 3 and 1 <= k % 9 < 8)
    assert got.resolved == want and got.ambiguous == sum(1 for k in range(600) if k % 3 and k % 9 == 8)
    refs = citations.references(frame(spark, rows), ("academic",), "doc_id")
    plain = refs.where("value = '2001.10001'").count()
    found = graph.candidates(refs, graph.document_anchors(manifest, pins, frame(spark, rows)), graph.scopes(manifest, pins)).where("value = '2001.10001'").collect()
    assert len(found) == plain and all(list(r.targets) == [known["s1"] + "0"] for r in found)


def test_a_part_of_the_store_is_replaced_alone(spark, tmp_path):
    docs = spark.createDataFrame([("a", "ua")], "doc_id string, canonical_url string")
    chunks = spark.createDataFrame([("a0", "a")], "chunk_id string, doc_id string")
    edge = lambda *rows: spark.createDataFrame(rows, "edge_id string, from_chunk string, to_chunk string, edge_type string")
    at = str(tmp_path / "store")
    build.save(build.Store(docs.select("canonical_url"), docs, chunks, edge(("e", "a0", "a0", "adjacent"), ("f", "a0", "a0", "references"))), at)
    times = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    before, old = times(), build.manifest_of(spark, at)
    build.replace(spark, at, {"adjacent": edge(("g", "a0", "a0", "adjacent"), ("h", "a0", "a0", "references"))})
    new = build.manifest_of(spark, at)
    assert sorted((r.edge_id, r.edge_type) for r in build.load(spark, at).edges.collect()) == [("f", "references"), ("g", "adjacent")]
    assert {k: v for k, v in new.items() if k != "edges"} == {k: v for k, v in old.items() if k != "edges"} and new["edges"]["references"] == old["edges"]["references"]
    assert all(times()[p] == t for p, t in before.items())
    assert build.count_rows(spark, at, "edges") == 2
    build.replace(spark, at, docs=docs.limit(0))
    assert build.load(spark, at).docs.count() == 0 and build.load(spark, at).chunks.count() == 1
    assert old["edges"]["adjacent"] not in {p.split("/store/")[1].rsplit("/", 1)[0] for p in times()}
    build.replace(spark, at, {"references": edge(("z", "a0", "a0", "references")).limit(0)})
    assert [r.edge_id for r in build.load(spark, at).edges.collect()] == ["g"]
    with pytest.raises(ValueError):
        build.replace(spark, at, chunks=chunks.drop("doc_id"))


def test_rebuild_skips_replaces_and_prunes(spark, tmp_path):
    docs = lambda *x: spark.createDataFrame([(i, "u" + i) for i in x], "doc_id string, canonical_url string")
    chunks = lambda *x: spark.createDataFrame([(i + "0", i) for i in x], "chunk_id string, doc_id string")
    sources = spark.createDataFrame([("ua", "v1")], "canonical_url string, version string")
    edges = spark.createDataFrame([("e", "a0", "b0", "adjacent")], "edge_id string, from_chunk string, to_chunk string, edge_type string")
    store = build.Store(sources, docs("a", "b"), chunks("a"), edges)
    todo = build.to_build(docs("a", "b", "c"), store.docs, store.chunks)
    assert sorted(r.doc_id for r in todo.collect()) == ["b", "c"]
    none = spark.createDataFrame([], "slug string, error string")
    new, stats = build.rebuild(store, spark.createDataFrame([("ua", "v2"), ("uc", "v1")], sources.schema), todo, chunks("b", "c"), none)
    assert sorted(r.doc_id for r in new.docs.collect()) == ["a", "b", "c"] and {tuple(r) for r in new.sources.collect()} == {("ua", "v1"), ("uc", "v1")}
    assert stats.first().status == "ok" and build.run_row(stats, "r").count() == 1
    left = build.prune(new, docs("a", "c"), none, True)
    assert sorted(r.doc_id for r in left.docs.collect()) == ["a", "c"] and left.edges.count() == 0
    assert build.prune(new, docs("a"), spark.createDataFrame([("x", "e")], none.schema), True).docs.count() == 3
    build.save(left, str(tmp_path))
    assert build.count_rows(spark, str(tmp_path), "docs") == 2 and build.load(spark, str(tmp_path)).chunks.count() == 2


def test_a_loaded_store_is_saved_to_its_own_place(spark, tmp_path):
    docs = spark.createDataFrame([("a", "ua"), ("b", "ub")], "doc_id string, canonical_url string")
    chunks = spark.createDataFrame([("a0", "a"), ("b0", "b")], "chunk_id string, doc_id string")
    edges = spark.createDataFrame([("e", "a0", "b0", "adjacent"), ("f", "b0", "b0", "references")], "edge_id string, from_chunk string, to_chunk string, edge_type string")
    at = str(tmp_path / "store")
    build.save(build.Store(docs.select("canonical_url"), docs, chunks, edges), at)
    for gone, left in (("a", 1), ("b", 0)):
        old = build.load(spark, at)
        build.save(build.delete_docs(old, old.docs.where(f"doc_id = '{gone}'")), at)
        new = build.load(spark, at)
        assert new.docs.count() == new.chunks.count() == left and new.sources.count() == 2
        assert old.docs.count() == left + 1  # the version before stays readable
    assert build.load(spark, at).edges.count() == 0 and len(list((tmp_path / "store").glob("current-*"))) == 2
    with pytest.raises(ValueError):
        build.save(build.Store(docs, docs, chunks.drop("doc_id"), edges), at)
    with pytest.raises(FileNotFoundError):
        build.load(spark, str(tmp_path / "nowhere"))


@pytest.mark.parametrize("most_users", [0, 2, 99])
def test_candidates_equal_plain_ones(spark, monkeypatch, most_users):
    monkeypatch.setattr(graph, "MOST_USERS", most_users)
    rng = random.Random(most_users)
    docs = [f"d{k}" for k in range(12)]
    scope = {(d, o) for d in docs[:9] for o in {d, "d0", rng.choice(docs)}}
    index = {(rng.choice(docs), rng.choice(["article", "arxiv"]), str(rng.randint(1, 4)), f"t{rng.randint(0, 5)}") for _ in range(70)}
    refs = [(f"c{rng.randint(0, 40)}", rng.choice(docs), rng.choice(["article", "arxiv"]), str(rng.randint(1, 5)), f"r{rng.randint(0, 3)}") for _ in range(400)]
    refs += refs[:50] + [(f"c{k}", "d1", "article", "1", "hot") for k in range(100, 400)]
    reach = lambda d: {o for a, o in scope if a == d} or {d}
    want = {}
    for c, d, kind, value, raw in set(refs):
        met = sorted({t for o, k, v, t in index if (k, v) == (kind, value) and (k == "arxiv" or o in reach(d))})
        want[c, d, kind, value, raw] = set(met if len(met) < 3 else (met[0], met[-1]))
    found = graph.candidates(
        spark.createDataFrame(refs, "chunk_id string, doc_id string, kind string, value string, raw string"),
        spark.createDataFrame(sorted(index), "doc_id string, kind string, value string, target string"),
        spark.createDataFrame(sorted(scope), "doc_id string, scope_doc string"),
    )
    got = found.collect()
    assert {tuple(r)[:5]: set(r.targets) for r in got} == want and len(got) == len(want)
    edges = graph.reference_edges(graph.resolve(found)).collect()
    assert len({r.edge_id for r in edges}) == len(edges)
    outcomes = {(k[0], next(iter(t)) if t else None, k[4]) for k, t in want.items() if len(t) < 2 and t != {k[0]}}
    assert {(r.from_chunk, r.to_chunk, r.provenance) for r in edges} == outcomes


def test_edges_are_not_shuffled_by_their_ids(spark):
    manifest = spark.createDataFrame([(f"s{k}", f"https://x.example/{k}", []) for k in range(5)], "slug string, url string, references array<string>")
    pins = spark.createDataFrame([(f"s{k}", "v1") for k in range(5)], "slug string, resolved_version string")
    known = {r.slug: r.doc_id for r in graph.documents_of(manifest, pins).collect()}
    rows = [(known[f"s{k % 5}"], k, f"Article {k}\nsee Article {k % 7}(1)", []) for k in range(50)]
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    edges, _ = graph.build_graph(frame(spark, rows), manifest, pins)
    assert "hashpartitioning(edge_id" not in plan(edges)
    twice, _ = graph.build_graph(frame(spark, rows + rows[:9]), manifest, pins)
    assert twice.select("edge_id").distinct().count() == twice.count()
    assert {r.edge_id for r in edges.where("edge_type = 'references'").collect()} == {r.edge_id for r in twice.where("edge_type = 'references'").collect()}


def test_saved_edges_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([("a", "ua")], "doc_id string, canonical_url string")
    kinds = ["adjacent", "a/b c", "é"]
    edges = spark.createDataFrame([(f"e{k}", "a0", "a0", kinds[k % 3]) for k in range(30)], "edge_id string, from_chunk string, to_chunk string, edge_type string")
    at = str(tmp_path / "store")
    build.save(build.Store(docs.select("canonical_url"), docs, spark.createDataFrame([("a0", "a")], "chunk_id string, doc_id string"), edges.mapInArrow(count, edges.schema)), at)
    assert seen.value == 30
    assert {(r.edge_id, r.edge_type) for r in build.load(spark, at).edges.collect()} == {(f"e{k}", kinds[k % 3]) for k in range(30)}
    assert set(build.manifest_of(spark, at)["edges"]) == set(kinds)
    build.replace(spark, at, {"é": edges.limit(0)})
    assert build.load(spark, at).edges.count() == 20
