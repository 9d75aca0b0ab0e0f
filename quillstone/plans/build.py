"""Rebuilding the store: what is present, what goes, what is added. Tables are DataFrames in, DataFrames out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import ids
from quillstone.operators.chunking import html_blocks, parse_pages, structural_chunks
from quillstone.operators.citations import references
from quillstone.operators.contexts import valid_pins, with_contexts
from quillstone.operators.graph import adjacent_edges, anchor_index, candidates, document_anchors, reference_edges, replace_edges, resolve, scopes
from quillstone.operators.inverted import Index
from quillstone.plans.stages import Stages

#: Columns that the stored tables must have.
SCHEMAS = {
    "sources": "canonical_url string",
    "docs": "doc_id string",
    "chunks": "chunk_id string, doc_id string",
    "edges": "edge_id string, from_chunk string, to_chunk string, edge_type string",
}
#: How stored edges are read; a column that a version lacks is null.
EDGES = "edge_id string, from_chunk string, to_chunk string, to_external_ref string, provenance string, confidence double, edge_type string"
TABLES = ("sources", "docs", "chunks", "edges")
_MARK = "current-"


@dataclass(frozen=True)
class Store:
    """The tables of a corpus store."""

    sources: DataFrame
    docs: DataFrame
    chunks: DataFrame
    edges: DataFrame


def present_docs(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents that have at least one chunk."""
    return docs.join(chunks.select("doc_id").distinct(), "doc_id", "left_semi")


def to_build(wanted: DataFrame, docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Wanted documents that aren't present: they are left out before anything is parsed."""
    return wanted.join(present_docs(docs, chunks).select("doc_id"), "doc_id", "left_anti")


def delete_docs(store: Store, gone: DataFrame) -> Store:
    """The store without some documents, their chunks, and the edges on either side of these."""
    gone = gone.select("doc_id").distinct()
    lost = store.chunks.join(gone, "doc_id", "left_semi").select("chunk_id")
    edges = store.edges.join(lost.withColumnRenamed("chunk_id", "from_chunk"), "from_chunk", "left_anti")
    edges = edges.join(lost.withColumnRenamed("chunk_id", "to_chunk"), "to_chunk", "left_anti").select(store.edges.columns)
    return Store(store.sources, store.docs.join(gone, "doc_id", "left_anti"), store.chunks.join(gone, "doc_id", "left_anti"), edges)


def prune_plan(docs: DataFrame, expected: DataFrame) -> DataFrame:
    """Documents that the manifest no longer has."""
    return docs.join(expected.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id")


def add_sources(sources: DataFrame, new: DataFrame) -> DataFrame:
    """New sources whose address isn't known; a known one keeps its row."""
    return sources.unionByName(new.join(sources.select("canonical_url"), "canonical_url", "left_anti").dropDuplicates(["canonical_url"]))


def rebuild(store: Store, sources: DataFrame, docs: DataFrame, chunks: DataFrame, errors: DataFrame, full: bool = True) -> tuple[Store, DataFrame]:
    """The store with the new documents in place of what is incomplete, and a row of counts.

    docs and chunks are those of to_build(); errors (slug, error) come from sources that failed: they
    add nothing, and with any of them, or for part of the manifest, nothing is pruned. expected
    documents are docs and what is present.
    """
    kept = present_docs(store.docs, store.chunks)
    cleared = delete_docs(store, store.docs.join(kept.select("doc_id"), "doc_id", "left_anti").unionByName(docs.join(store.docs.select("doc_id"), "doc_id", "left_semi").select(store.docs.columns)))
    built = Store(add_sources(store.sources, sources), cleared.docs.unionByName(docs), cleared.chunks.unionByName(chunks), cleared.edges)
    n = lambda frame, name: frame.agg(F.count(F.lit(1)).alias(name))
    stats = n(docs, "built").crossJoin(n(kept, "skipped")).crossJoin(n(chunks, "chunks")).crossJoin(n(errors, "errors"))
    return built, stats.select("*", F.when(F.col("errors") > 0, "partial").otherwise("ok").alias("status"), F.lit(full).alias("full"))


def prune(store: Store, expected: DataFrame, errors: DataFrame, full: bool) -> Store:
    if not full or errors.limit(1).count():
        return store
    return delete_docs(store, prune_plan(store.docs, expected))


def run_row(stats: DataFrame, run_id: str) -> DataFrame:
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return stats.select(F.lit(run_id).alias("ingest_run_id"), at.alias("finished_at"), "status", F.to_json(F.struct("built", "skipped", "chunks", "errors")).alias("stats"))


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """old with the rows of new, which replace those of their key; of new rows with one key, the one with the largest hash."""
    once = new.groupBy(*key).agg(F.max_by(F.struct(*new.columns), F.xxhash64(*new.columns)).alias("r")).select("r.*")
    return old.join(new.select(*key).distinct(), list(key), "left_anti").select(old.columns).unionByName(once)


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the versions that are complete."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted((int(n.split("-")[1]), n.split("-")[2]) for n in names if n.startswith(_MARK))


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def manifest_of(spark: SparkSession, path: str, version: str | None = None) -> dict:
    """Where the tables of a version (by default the current one) lie: sources, docs, chunks, and edges by type."""
    if version is None:
        marks = _marks(spark, path)
        if not marks:
            raise FileNotFoundError(f"no store at {path}")
        version = marks[-1][1]
    return json.loads(spark.read.text(f"{path}/{version}/manifest").first()[0])


def _check_edges(edges: DataFrame) -> None:
    lacks = [c.split()[0] for c in SCHEMAS["edges"].split(", ") if c.split()[0] not in edges.columns]
    if lacks:
        raise ValueError(f"edges lacks {', '.join(lacks)}")


def replace(spark: SparkSession, path: str, edges: dict[str, DataFrame] | DataFrame | None = None, **tables: DataFrame) -> None:
    """A new version with these tables (sources, docs, chunks) and types of edges; all others are those of the version
    before, file by file. A type of edges without rows has none then. A frame of edges stands for all
    types; it is computed once and dealt out to a folder for each type.

    The version's manifest says where each table lies. A mark, made last and at once, makes it the
    current one; the version before stays for those that still read it. Folders that neither names go.
    """
    for name, frame in tables.items():
        lacks = [c.split()[0] for c in SCHEMAS[name].split(", ") if c.split()[0] not in frame.columns]
        if lacks:
            raise ValueError(f"{name} lacks {', '.join(lacks)}")
    marks, version = _marks(spark, path), uuid.uuid4().hex
    placed = manifest_of(spark, path) if marks else {"edges": {}}
    for name, frame in tables.items():
        frame.write.parquet(f"{path}/{version}/{name}")
        placed[name] = f"{version}/{name}"
    fs, at = _fs(spark, path)
    if isinstance(edges, DataFrame):
        _check_edges(edges)
        dealt, placed["edges"] = f"{path}/{version}/dealt", {}
        named = F.concat(F.lit("k"), F.hex(F.encode("edge_type", "UTF-8"))).alias("kind")
        edges.where("edge_type is not null").select("*", named).write.partitionBy("kind").parquet(dealt)
        for n, name in enumerate(sorted(x.getPath().getName() for x in fs.listStatus(at(dealt)) if x.isDirectory())):
            number = f"{version}/edges-{n}-{uuid.uuid4().hex[:6]}"
            if not fs.rename(at(f"{dealt}/{name}"), at(f"{path}/{number}")):
                raise OSError(f"{dealt}/{name} can't be renamed")
            placed["edges"][bytes.fromhex(name.removeprefix("kind=k")).decode()] = number
        fs.delete(at(dealt), True)
        edges = None
    for kind, frame in (edges or {}).items():
        _check_edges(frame)
        number = f"{version}/edges-{len(placed['edges'])}-{uuid.uuid4().hex[:6]}"
        frame.where(F.col("edge_type") == kind).write.parquet(f"{path}/{number}")
        placed["edges"][kind] = number
    spark.createDataFrame([(json.dumps(placed),)], "v string").coalesce(1).write.text(f"{path}/{version}/manifest")
    number = marks[-1][0] + 1 if marks else 0
    fs.create(at(f"{path}/{_MARK}{number:08d}-{version}")).close()
    for n, old in marks[:-1]:
        fs.delete(at(f"{path}/{_MARK}{n:08d}-{old}"), False)
    kept = [manifest_of(spark, path, v) for _, v in _marks(spark, path)]
    named = {x for m in kept for x in (*(v for k, v in m.items() if k != "edges"), *m["edges"].values())}
    versions = {v for _, v in _marks(spark, path)}
    for folder in (x.getPath().getName() for x in fs.listStatus(at(path)) if x.isDirectory()):
        for table in (x.getPath().getName() for x in fs.listStatus(at(f"{path}/{folder}"))):
            if f"{folder}/{table}" not in named and not (table == "manifest" and folder in versions):
                fs.delete(at(f"{path}/{folder}/{table}"), True)
        if folder not in versions and not fs.listStatus(at(f"{path}/{folder}")):
            fs.delete(at(f"{path}/{folder}"), True)


def save(store: Store, path: str) -> None:
    """A version of all tables, which the frames may be read from; edges lie by type, so that reading one type reads its files only."""
    _check_edges(store.edges)
    replace(store.docs.sparkSession, path, store.edges, sources=store.sources, docs=store.docs, chunks=store.chunks)


def load(spark: SparkSession, path: str) -> Store:
    placed = manifest_of(spark, path)
    read = [spark.read.parquet(f"{path}/{placed[name]}") for name in ("sources", "docs", "chunks")]
    edges = spark.createDataFrame([], EDGES)
    for kind, at in sorted(placed["edges"].items()):
        edges = edges.unionByName(spark.read.schema(EDGES).parquet(f"{path}/{at}"))
    return Store(*read, edges)


def count_rows(spark: SparkSession, path: str, table: str) -> int:
    if table not in TABLES:
        raise ValueError(f"no such table: {table}")
    if table == "edges":
        return load(spark, path).edges.count()
    return spark.read.parquet(f"{path}/{manifest_of(spark, path)[table]}").count()


def chunk(chunks: DataFrame, chunk_id: str) -> DataFrame:
    return chunks.where(F.col("chunk_id") == chunk_id)


def chunks_of(chunks: DataFrame, doc_id: str) -> DataFrame:
    return chunks.where(F.col("doc_id") == doc_id).orderBy("chunk_index")


def load_documents(manifest: DataFrame, pins: DataFrame, pages: DataFrame, drop_boilerplate: bool = True) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, slug, url, title) and chunks (doc_id, chunk_id, chunk_index, heading_path, chunk_type, text) of pinned sources.

    pages: slug, html. The pin's version gives the ids; a source without a pin or page gives nothing. The
    title is the first heading of level 1, or the slug.
    """
    pinned = pins.where(F.col("resolved_version").isNotNull()).select("slug", "resolved_version")
    named = manifest.select("slug", "url").join(pinned, "slug").join(pages.select("slug").distinct(), "slug", "left_semi")
    blocks = html_blocks(pages.join(named.select("slug"), "slug", "left_semi"), "slug", "html")
    titles = blocks.where("kind = 'heading' and level = 1").groupBy("doc").agg(F.min_by("text", "pos").alias("title"))
    url, version = F.col("url"), F.col("resolved_version")
    known = named.join(titles.withColumnRenamed("doc", "slug"), "slug", "left")
    docs = known.select(ids.doc_id(url, version).alias("doc_id"), "slug", "url", F.coalesce("title", "slug").alias("title"))
    chunks = structural_chunks(blocks, drop_boilerplate=drop_boilerplate).withColumnRenamed("doc", "slug").join(named, "slug")
    return docs, chunks.select(
        ids.doc_id(url, version).alias("doc_id"), ids.chunk_id(url, version, F.col("chunk_index")).alias("chunk_id"),
        F.col("chunk_index").cast("long").alias("chunk_index"), "heading_path", "chunk_type", "text",
    )


@dataclass(frozen=True)
class Built:
    """What a build has made: the store, the row of the run, and its errors (slug, error)."""

    store: Store
    run: DataFrame
    errors: DataFrame
    counts: dict[str, int]


#: Ids of wanted documents up to which they are broadcast, so that pages stay where they are.
BROADCAST_IDS = 1_000_000


def _few(frame: DataFrame, n: int) -> DataFrame:
    return F.broadcast(frame) if n <= BROADCAST_IDS else frame


def build_corpus(
    store: Store, manifest: DataFrame, pins: DataFrame, pages: DataFrame, context_pins: DataFrame, model: str, prompt_version: int,
    index: Index | None = None, stages: Stages | None = None, only: list[str] | None = None, require_context: bool = False, run_id: str | None = None,
    extractors: tuple[str, ...] = ("legal", "academic"), min_body_chars: int = 0, generate: Callable[[DataFrame], DataFrame] | None = None,
) -> Built:
    """From manifest to chunks with contexts, edges, errors and the row of the run; what is present already isn't parsed again.

    Every step is a table in the folder of `stages`, written once and read by those after it: each page is
    parsed once, anchors and citations are looked for once, and counters are observed on the way.
    A build that breaks off goes on in the same folder; the store's frames read it, so it stays until
    the store is saved.

    A source without a pin or page, or whose page the parser gives up on, is a row of errors and adds
    nothing; the others are built, and the status is `partial`. Documents that the manifest no
    longer has go, but only after a whole build (`only` is None) without such errors. Contexts come from valid pins or
    from generate (see with_contexts), whose errors are rows too, one for each chunk; the chunk itself is built. If some are missing, that is noted in the run or, with require_context, an error. The graph is built
    anew over all chunks. index, if given, is invalidated before anything else.
    """
    if index is not None:
        index.invalidate()
    stages = stages or Stages(store.docs.sparkSession)
    one, n_null = F.count(F.lit(1)), lambda c: F.count_if(F.col(c).isNull())
    chosen = manifest if only is None else manifest.where(F.col("slug").isin(only))
    version = pins.where(F.col("resolved_version").isNotNull()).select("slug", "resolved_version")
    present, n_present = stages.keep("present", lambda: present_docs(store.docs, store.chunks).select("doc_id"), n=one)

    def placed() -> DataFrame:
        rows = chosen.select("slug", "url").join(version, "slug", "left").join(pages.select("slug", F.lit(True).alias("paged")).distinct(), "slug", "left")
        rows = rows.withColumn("doc_id", F.when(F.col("resolved_version").isNotNull(), ids.doc_id(F.col("url"), F.col("resolved_version"))))
        return rows.join(_few(present.withColumn("here", F.lit(True)), n_present["n"]), "doc_id", "left")

    new = F.col("doc_id").isNotNull() & F.col("here").isNull() & F.col("paged").isNotNull()
    known, n_known = stages.keep("known", placed, wanted=F.count_if(new), unpinned=n_null("doc_id"), unpaged=F.count_if(F.col("doc_id").isNotNull() & F.col("here").isNull() & F.col("paged").isNull()))
    wanted = known.where(new).select("doc_id", "slug", "url", "resolved_version")
    parsed, n_parsed = stages.keep(
        "parsed", lambda: parse_pages(pages.join(_few(wanted.select("slug"), n_known["wanted"]), "slug", "left_semi"), "slug", "html"), failed=F.count("error")
    )
    failed = parsed.where("error is not null").select(F.col("doc").alias("slug"), "error")
    blocks = parsed.where("error is null").drop("error")

    def chunked() -> DataFrame:
        rows = structural_chunks(blocks).withColumnRenamed("doc", "slug").join(_few(wanted, n_known["wanted"]), "slug")
        made = ids.chunk_id(F.col("url"), F.col("resolved_version"), F.col("chunk_index"))
        rows = rows.select("doc_id", made.alias("chunk_id"), F.col("chunk_index").cast("long").alias("chunk_index"), "heading_path", "chunk_type", "text")
        rows = with_contexts(rows, valid_pins(context_pins, rows, model, prompt_version), generate)
        return rows if "context_error" in rows.columns else rows.withColumn("context_error", F.lit(None).cast("string"))

    chunks, n_chunks = stages.keep("chunks", chunked, chunks=one, missing=F.count_if(F.col("origin") == "missing"), failed=F.count("context_error"))

    def titled() -> DataFrame:
        titles = blocks.where("kind = 'heading' and level = 1").groupBy("doc").agg(F.min_by("text", "pos").alias("title"))
        whole = wanted.join(_few(failed.select("slug"), n_parsed["failed"]), "slug", "left_anti")
        return whole.join(titles.withColumnRenamed("doc", "slug"), "slug", "left").select("doc_id", "slug", "url", F.coalesce("title", "slug").alias("title"))

    docs, n_docs = stages.keep("docs", titled, docs=one)
    lost = F.when(F.col("doc_id").isNull(), "no pin").when(F.col("here").isNull() & F.col("paged").isNull(), "no page")
    errors = known.select("slug", lost.alias("error")).where("error is not null").unionByName(failed)
    if n_chunks["failed"]:
        unmade = chunks.where("context_error is not null").join(_few(wanted.select("doc_id", "slug"), n_known["wanted"]), "doc_id")
        errors = errors.unionByName(unmade.select("slug", F.concat(F.lit("context chunk "), F.col("chunk_index").cast("string"), F.lit(": "), "context_error").alias("error")))
    n_errors = n_known["unpinned"] + n_known["unpaged"] + n_parsed["failed"] + n_chunks["failed"]
    whole = only is None and not n_errors

    def leaving() -> DataFrame:
        stored = store.docs.select("doc_id")
        gone = stored.join(present, "doc_id", "left_anti").unionByName(docs.select("doc_id"))
        if whole:
            gone = gone.unionByName(prune_plan(stored.join(present, "doc_id", "left_semi"), known.where("doc_id is not null")))
        return gone.distinct()

    gone, n_gone = stages.keep("gone", leaving, n=one)
    pruned = n_present["n"] - present.join(gone, "doc_id", "left_anti").count() if whole and n_gone["n"] else 0
    cleared = delete_docs(store, gone) if n_gone["n"] else store
    all_chunks = cleared.chunks.unionByName(chunks.drop("origin", "context_error"))
    stored_docs = cleared.docs.unionByName(docs)
    found, _ = stages.keep("references", lambda: references(all_chunks, extractors, "doc_id"))
    heads, named = anchor_index(all_chunks, min_body_chars), document_anchors(manifest, pins, all_chunks)
    resolved, _ = stages.keep("resolved", lambda: resolve(candidates(found, heads, scopes(manifest, pins), named)))
    columns = store.edges.columns
    made = lambda: adjacent_edges(all_chunks).select(columns).unionByName(reference_edges(resolved).select(columns))
    edges, n_edges = stages.keep("edges", made, edges=one)
    counts = {
        "built": n_docs["docs"], "skipped": n_present["n"] - pruned, "chunks": n_chunks["chunks"], "contexts": n_chunks["chunks"] - n_chunks["missing"],
        "contexts_missing": n_chunks["missing"], "pruned": pruned, "edges": n_edges["edges"], "errors": n_errors,
    }
    spark = store.docs.sparkSession
    note = f"{counts['contexts_missing']} of {counts['chunks']} chunks have no context" if counts["contexts_missing"] else None
    if note and require_context:
        errors = errors.unionByName(spark.createDataFrame([("*", note)], "slug string, error string"))
        counts["errors"] += 1
    status = "partial" if counts["errors"] else "ok"
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    run = spark.createDataFrame([(run_id or f"build-{uuid.uuid4().hex[:8]}", status, json.dumps(counts), None if require_context else note)], "ingest_run_id string, status string, stats string, note string")
    run = run.select("ingest_run_id", at.alias("finished_at"), "status", "stats", "note")
    sources = add_sources(store.sources, chosen.select(F.col("url").alias("canonical_url"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in store.sources.schema if f.name != "canonical_url"]))
    kept = replace_edges(cleared.edges, edges, ["references", "adjacent"])
    return Built(Store(sources, stored_docs, all_chunks, kept), run, errors, counts)
