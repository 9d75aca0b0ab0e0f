import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstone.functions.text import est_tokens
from quillstone.operators import chunking, contexts, packing


def est(chars, cpt=4):
    return max(1, -(-chars // cpt))


def brute(rows, target, most):
    """rows: (heading, text) in order; the greedy rule, written plainly."""
    cap = max(target, most)
    runs = []
    for i, (h, t) in enumerate(rows):
        if runs and runs[-1][0] == h:
            runs[-1][1].append(i)
        else:
            runs.append((h, [i]))
    cost = lambda h, some: len(f"## {h}") + 1 + sum(len(rows[i][1]) for i in some) + 2 * (len(some) - 1)
    out, now, used = [], [], 0
    for h, some in runs:
        tokens = est(cost(h, some))
        if tokens > cap:
            out, now, used = out + ([now] if now else []), [], 0
            part, spent = [], 0
            for i in some:
                c = est(cost(h, [i]))
                if part and spent + c > cap:
                    out.append([(h, part)])
                    part, spent = [], 0
                part, spent = part + [i], spent + c
            out.append([(h, part)])
            continue
        if now and used + tokens > target:
            out, now, used = out + [now], [], 0
        now, used = now + [(h, some)], used + tokens
    out += [now] if now else []
    return [([i for _, s in w for i in s], est(sum(cost(h, s) for h, s in w) + 2 * (len(w) - 1))) for w in out]


@pytest.mark.parametrize("most_folded", [4096, 3])
def test_windows_equal_the_plain_rule(spark, monkeypatch, most_folded):
    monkeypatch.setattr(packing, "MOST_FOLDED", most_folded)
    monkeypatch.setattr(packing, "BLOCK", 4)
    rng = random.Random(3)
    for target, most in ((30, 50), (60, 60), (100, 80)):
        docs = {d: [(rng.choice("AB"), "x" * rng.choice([0, 5, 40, 90, 300])) for _ in range(rng.randint(1, 25))] for d in range(60)}
        rows = [(d, i, [h], t) for d, x in docs.items() for i, (h, t) in enumerate(x)]
        frame = spark.createDataFrame(rows, "doc long, chunk_index long, heading_path array<string>, text string")
        got = {}
        for r in chunking.context_windows(frame, target, most).orderBy("doc", "window_index").collect():
            got.setdefault(r.doc, []).append((list(r.chunk_indices), r.est_tokens))
        assert got == {d: brute(x, target, most) for d, x in docs.items()}


def test_costs_follow_the_formula(spark):
    frame = spark.createDataFrame([(1, i, ["A"], "x" * 400) for i in range(3)], "doc long, chunk_index long, heading_path array<string>, text string")
    p = contexts.Pricing(min_cacheable=1)
    row = contexts.estimate_cost(frame, pricing=p).where("doc is null").first()
    prefix = est(4 + 1 + 1204) + est(593) + est(64)
    assert (row.windows, row.chunks, row.cache_write_tokens, row.cache_read_tokens) == (1, 3, prefix, 2 * prefix)
    assert row.input_tokens == 3 * (100 + 36) and row.output_tokens == 450
    assert row.usd == round((row.input_tokens + 2 * prefix + 0.2 * prefix + 5 * 450) / 1e6, 4)
    assert contexts.estimate_cost(frame).where("doc is null").first().cacheable_windows == 0


def test_html_becomes_blocks_and_chunks(spark):
    html = "<nav>menu</nav><h1>Top</h1><p>one</p><script>no()</script><h2>Part</h2><p>two<br>three</p><table><tr><th>a</th><td>b</td></tr></table><h1>Next</h1>four"
    blocks = chunking.html_blocks(spark.createDataFrame([(1, html), (2, None)], "id long, html string"), "id", "html")
    rows = chunking.structural_chunks(blocks).orderBy("chunk_index").collect()
    assert [(r.heading_path, r.chunk_type, r.text) for r in rows] == [
        ([], "text", "menu"), (["Top"], "text", "one"), (["Top", "Part"], "text", "two\nthree"), (["Top", "Part"], "table", "a | b"), (["Next"], "text", "four")
    ]
    assert [r.chunk_index for r in rows] == list(range(5))


def test_types_and_grids(spark):
    items = F.from_json(F.lit('[{"label":"text"},{"label":"table","grid":"g"}]'), "array<struct<label:string,grid:string>>")
    assert tuple(spark.range(1).select(chunking.chunk_type(items), chunking.first_grid(items)).first()) == ("table", "g")


def test_pins_coverage_and_texts(spark):
    chunks = spark.createDataFrame([("a", "t1", "ok is a context of words"), ("b", "t2", None), ("c", "t3", "short")], "chunk_id string, text string, context string")
    row = contexts.coverage(chunks).first()
    assert tuple(row) == (3, 2, 1, 1)
    assert {(r.chunk_id, r.flag) for r in contexts.coverage_flags(chunks).collect()} == {("b", "empty"), ("c", "suspicious")}
    windows = spark.createDataFrame([(1, 0, [0, 1, 2])], "doc long, window_index int, chunk_indices array<long>")
    rows = spark.createDataFrame([(1, 0, ["A"], "x"), (1, 1, ["A"], "y"), (1, 2, ["B"], "z")], "doc long, chunk_index long, heading_path array<string>, text string")
    assert chunking.window_texts(rows, windows).first().text == "## A\nx\n\ny\n\n## B\nz"


def bins(costs, limit):
    out, used = [], None
    for c in costs:
        fresh = used is None or used + c > limit
        used = c if fresh else used + c
        out.append(fresh)
    return out


def test_a_long_run_is_packed_in_spread_tasks(spark, monkeypatch):
    rng = random.Random(6)
    runs = {("a", 1): [rng.choice([1, 2, 9, 30, 70]) for _ in range(6000)], ("a", 2): [1] * 3000, ("b", 1): [99] * 40, ("c", 1): [5], ("d", 1): [rng.randint(1, 60) for _ in range(500)]}
    limits = {("a", 1): 60, ("a", 2): 7, ("b", 1): 60, ("c", 1): 60, ("d", 1): 60}
    rows = [(*k, 10 + i, c, limits[k], "x") for k, costs in runs.items() for i, c in enumerate(costs)]
    frame = spark.createDataFrame(rows, "doc string, run int, n long, cost long, limit long, other string").repartition(4)
    monkeypatch.setattr(packing, "BLOCK", 256)
    got = {}
    for r in packing.pack_runs(frame, ["doc", "run"], "n", "cost", "limit", [60, 7], most_folded=450).orderBy("n").collect():
        got.setdefault((r.doc, r.run), []).append((r.starts, r.bin))
    for k, costs in runs.items():
        starts = bins(costs, limits[k])
        assert [s for s, _ in got[k]] == starts
        assert [b for _, b in got[k]] == [sum(starts[: i + 1]) - 1 for i in range(len(starts))]


def plain_chunks(blocks, most):
    """Texts of one section's chunks."""
    out, now = [], ""
    for text in blocks:
        parts = [text]
        if len(text) > most:
            parts = [p for s in re.sub(r"([.!?]) +", r"\1\n", text).split("\n") for p in (re.split(" +", s) if len(s) > most else [s]) if p]
        for k, part in enumerate(parts):
            if now and len(now) + 1 + len(part) > most:
                out, now = out + [now], ""
            now = part if not now else now + (" " if k else "\n") + part
    return out + [now] if now else out


@pytest.mark.parametrize("most_folded", [4096, 5])
def test_no_chunk_is_over_the_cap(spark, monkeypatch, most_folded):
    monkeypatch.setattr(packing, "MOST_FOLDED", most_folded)
    rng = random.Random(7)
    sentence = lambda: " ".join("w" * rng.choice([1, 3, 8, 30]) for _ in range(rng.randint(1, 12))) + rng.choice([".", "!", "?", "", "..."])
    docs = {f"d{d}": [" ".join(sentence() for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 30))] for d in range(30)}
    docs["one"] = ["500 tokens. " * 20, "x" * 300, "end"]
    rows = [(d, i, "text", 0, t.strip()) for d, x in docs.items() for i, t in enumerate(x)]
    chunks = chunking.structural_chunks(spark.createDataFrame(rows, "doc string, pos int, kind string, level int, text string"), 20)
    got = {}
    for r in chunks.withColumn("n", est_tokens(F.col("text"))).orderBy("doc", "chunk_index").collect():
        got.setdefault(r.doc, []).append(r.text)
        assert r.n <= 20 or " " not in r.text
    assert got == {d: plain_chunks([t.strip() for t in x], 80) for d, x in docs.items()}


def test_a_parser_gives_its_blocks_back_in_small_batches(spark, monkeypatch):
    pages = [(f"p{k}", "<p>a</p>" * (k % 50) + "<p>" + "b" * (k * 10) if k % 9 else None) for k in range(600)] + [("long", "<p>c</p>" * 10_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pages)], names=["doc", "html"])
    out = list(chunking.parse_batches(iter([batch])))
    assert all(0 < b.num_rows <= chunking.BATCH_BLOCKS and sum(map(len, b.column(4).to_pylist())) < chunking.BATCH_CHARS + 6000 for b in out)
    rows = [r for b in out for r in zip(*(c.to_pylist() for c in b.columns))]
    assert rows == [(doc, *row) for doc, html in pages for row in chunking._page_blocks(html)] and len(out) > 5
    chunking.parse_pages(spark.createDataFrame(pages[:1], "doc string, html string"), "doc", "html")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= chunking.BATCH_PAGES
