"""The citation graph: which chunk defines a section, and which citation points to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.ids import doc_id, edge_id
from quillstone.operators.citations import anchor_list, references
from quillstone.operators.joins import join_hot, marked, repeated
from quillstone.plans.stages import Stages
from quillstone.sources.planning import arxiv_id, host_matches

#: Kinds that name one document wherever it is cited.
GLOBAL_KINDS = ("arxiv", "doi")
#: Documents that may cite one document, up to which its anchors go to them.
MOST_USERS = 16
# Fixed value: the shape of a DOI in an address.
DOI = r"(?Ui)\b(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)"


def documents_of(manifest: DataFrame, pins: DataFrame) -> DataFrame:
    """(slug, doc_id): the manifest's address with the version that the pin resolved."""
    pinned = pins.where(F.col("resolved_version").isNotNull()).select("slug", "resolved_version")
    return manifest.select("slug", "url").join(pinned, "slug").select("slug", doc_id(F.col("url"), F.col("resolved_version")).alias("doc_id"))


def anchor_index(chunks: DataFrame, min_body_chars: int = 0) -> DataFrame:
    """(doc_id, kind, value, target): the chunk that stands for each section of a document.

    The first definer by chunk_index wins. If a header in the text has less than min_body_chars
    after it, the document's next chunk is the target, where there is one; a heading path's own
    section is where it is. One exchange, of ids and the few anchors, serves the look-ahead and the choice.
    """
    order = Window.partitionBy("doc_id").orderBy("chunk_index")
    found = F.transform(anchor_list(F.col("text"), F.col("heading_path")), lambda x: x.withField("body", F.length("text") - x["end"]).dropFields("end"))
    listed = chunks.select("doc_id", "chunk_index", "chunk_id", found.alias("found"))
    rows = listed.withColumn("next", F.lead("chunk_id").over(order)).select("doc_id", "chunk_index", "chunk_id", "next", F.explode("found").alias("a"))
    thin = F.col("a.body").isNotNull() & (F.col("a.body") < min_body_chars) & F.col("next").isNotNull()
    target = F.when(thin, F.col("next")).otherwise(F.col("chunk_id"))
    return rows.groupBy("doc_id", "a.kind", "a.value").agg(F.min_by(target, F.struct("chunk_index", "a.line")).alias("target"))


def document_anchors(manifest: DataFrame, pins: DataFrame, chunks: DataFrame) -> DataFrame:
    """The same columns for what names a whole document in its address (arXiv id, DOI): its first chunk."""
    url = F.col("url")
    arxiv = F.when(host_matches(url, ["arxiv.org"]), arxiv_id(url))
    doi = F.lower(F.regexp_extract(url, DOI, 1))
    named = manifest.join(documents_of(manifest, pins), "slug").select(
        "doc_id", F.inline(F.array(F.struct(F.lit("arxiv").alias("kind"), arxiv.alias("value")), F.struct(F.lit("doi").alias("kind"), doi.alias("value"))))
    )
    heads = chunks.groupBy("doc_id").agg(F.min_by("chunk_id", "chunk_index").alias("target"))
    return named.where("value is not null and value <> ''").join(heads, "doc_id").select("doc_id", "kind", "value", "target").distinct()


def scopes(manifest: DataFrame, pins: DataFrame) -> DataFrame:
    """(doc_id, scope_doc): a document may cite itself and those that its manifest row refers to, where known."""
    known = documents_of(manifest, pins)
    wide = manifest.select("slug", F.explode(F.array_union(F.array("slug"), F.coalesce("references", F.array().cast("array<string>")))).alias("other"))
    return (
        wide.join(known, "slug")
        .join(known.select(F.col("slug").alias("other"), F.col("doc_id").alias("scope_doc")), "other")
        .select("doc_id", "scope_doc")
        .distinct()
    )


def candidates(refs: DataFrame, index: DataFrame, scope: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """(chunk_id, doc_id, kind, value, raw, again, targets): each reference with the distinct chunks it may mean; of more than two, the smallest and largest.

    refs: chunk_id, doc_id, kind, value, raw. Global kinds match any document, in index and named; the others match
    over (scope document, kind, value) in index. A document without scope has itself. So that references aren't looked for
    again, they are written once, and they are shuffled once: a document's anchors go to the documents that may cite it,
    where those that are equal become one row. Only those of a document that more than MOST_USERS
    may cite stay, and the references go there. Whatever a thousandth of all chunks cite stays where it is: see join_hot().
    `again` says which references may share chunk and wording with another one; where none do, it is constant.
    """
    wide, keys = F.col("kind").isin(*GLOBAL_KINDS), ["chunk_id", "doc_id", "kind", "value", "raw"]
    stages, counters = Stages(refs.sparkSession), {"wide": F.count_if(wide), "own": F.count_if(~wide)}
    refs, n = stages.keep("refs", lambda: refs.select(*keys), **counters)
    twice = repeated(refs, "chunk_id", "raw")
    if twice is not None:
        refs, n = stages.keep("once", lambda: refs.distinct(), **counters)
        twice = repeated(refs, "chunk_id", "raw")
    refs = marked(refs, twice, "chunk_id", "raw")
    ends = lambda frame, *by: frame.groupBy(*by).agg(F.min("least").alias("least"), F.max("most").alias("most"))
    both = lambda frame: frame.select("*", F.col("target").alias("least"), F.col("target").alias("most"))
    common, n_common = stages.keep("common", lambda: scope.groupBy("scope_doc").agg(F.count(F.lit(1)).alias("users")).where(F.col("users") > MOST_USERS).select("scope_doc"), n=F.count(F.lit(1)))
    near = scope.join(common, "scope_doc", "left_anti") if n_common["n"] else scope
    # of each document those that may cite it, itself where it has no scope
    users = near.select(F.col("scope_doc").alias("doc_id"), F.col("doc_id").alias("user")).unionByName(scope.select("doc_id", F.lit(None).cast("string").alias("user")))
    scoped = F.max(F.col("user").isNull()).alias("scoped")
    reach = users.groupBy("doc_id").agg(F.collect_set("user").alias("users"), scoped)
    known = ends(both(index.where(~wide)), "doc_id", "kind", "value").join(reach, "doc_id", "left")
    alone = F.when(F.coalesce("scoped", F.lit(False)), F.array().cast("array<string>")).otherwise(F.array("doc_id"))
    reached = known.select(F.explode(F.array_union(F.coalesce("users", F.array().cast("array<string>")), alone)).alias("doc_id"), "kind", "value", "least", "most")
    columns = [*keys, "again", "least", "most"]
    found = join_hot(refs.where(~wide), ends(reached, "doc_id", "kind", "value"), ["doc_id", "kind", "value"], total=n["own"]).select(columns)
    if n_common["n"]:
        far = scope.join(common, "scope_doc", "left_semi")
        asked, _ = stages.keep("asked", lambda: join_hot(refs.where(~wide), far, ["doc_id"], "inner", total=n["own"]))
        held = ends(both(index.where(~wide).join(common.withColumnRenamed("scope_doc", "doc_id"), "doc_id", "left_semi")), "doc_id", "kind", "value").withColumnRenamed("doc_id", "scope_doc")
        found = ends(found.unionByName(join_hot(asked, held, ["scope_doc", "kind", "value"], "inner").select(columns)), *keys, "again")
    if n["wide"]:
        every = index.where(wide) if named is None else index.where(wide).unionByName(named.where(wide).select(index.columns))
        found = found.unionByName(join_hot(refs.where(wide), ends(both(every), "kind", "value"), ["kind", "value"], total=n["wide"]).select(columns))
    return found.select(*keys, "again", F.array_distinct(F.filter(F.array("least", "most"), lambda x: x.isNotNull())).alias("targets"))


def resolve(found: DataFrame) -> DataFrame:
    """Adds outcome and target: exactly one candidate resolves; a reference to its own chunk is `self`."""
    n = F.size("targets")
    one = F.get("targets", F.lit(0))
    outcome = F.when(n > 1, "ambiguous").when(n == 0, "unresolved").when(one == F.col("chunk_id"), "self").otherwise("resolved")
    return found.withColumn("outcome", outcome).withColumn("target", F.when(n == 1, one))


def reference_edges(resolved: DataFrame, record_unresolved: bool = True) -> DataFrame:
    """Edges of resolved references (confidence 1) and, if wanted, of unresolved ones (0, named outside)."""
    kept = resolved.where(F.col("outcome").isin("resolved", *(["unresolved"] if record_unresolved else [])))
    to = F.when(F.col("outcome") == "resolved", F.col("target"))
    rows = kept.select(
        F.col("chunk_id").alias("from_chunk"),
        to.alias("to_chunk"),
        F.when(F.col("outcome") == "unresolved", F.concat_ws(":", "kind", "value")).alias("to_external_ref"),
        F.lit("references").alias("edge_type"),
        F.col("raw").alias("provenance"),
        F.when(F.col("outcome") == "resolved", 1.0).otherwise(0.0).alias("confidence"),
        *[c for c in kept.columns if c == "again"],
    )
    return identified(rows)


def adjacent_edges(chunks: DataFrame) -> DataFrame:
    """An edge from each chunk to the document's next one; ids of chunks that repeat are looked for first, as only theirs can give an edge twice."""
    twice = repeated(chunks, "chunk_id")
    order = Window.partitionBy("doc_id").orderBy("chunk_index")
    rows = chunks.select(F.col("chunk_id").alias("from_chunk"), F.lead("chunk_id").over(order).alias("to_chunk")).where("to_chunk is not null")
    rows = marked(rows, twice, "from_chunk")
    none = F.lit(None).cast("string")
    return identified(
        rows.select("from_chunk", "to_chunk", none.alias("to_external_ref"), F.lit("adjacent").alias("edge_type"), none.alias("provenance"), F.lit(1.0).alias("confidence"), "again")
    )


def identified(edges: DataFrame) -> DataFrame:
    """Edges with edge_id, one for each id (the external name decides between rows with one id).

    If there is `again`, only edges that have it may share an id, so the others stay where they are.
    """
    ids = edge_id(F.col("from_chunk"), F.col("to_chunk"), F.col("edge_type"), F.col("provenance"))
    rest = [c for c in edges.columns if c not in ("edge_id", "again")]
    last = F.max_by(F.struct(*rest), F.coalesce("to_external_ref", F.lit("")))
    once = lambda frame: frame.select(ids.alias("edge_id"), *rest).groupBy("edge_id").agg(last.alias("e")).select("edge_id", "e.*")
    if "again" not in edges.columns:
        return once(edges)
    return edges.where(~F.col("again")).select(ids.alias("edge_id"), *rest).unionByName(once(edges.where("again")))


def build_graph(chunks: DataFrame, manifest: DataFrame, pins: DataFrame, extractors=("legal", "academic"), min_body_chars: int = 0, record_unresolved: bool = True, with_references: bool = True) -> tuple[DataFrame, DataFrame]:
    """All edges, and one row of counts: adjacent, resolved, unresolved, ambiguous, self_citations.

    Without references, only the adjacent edges are made; replace_edges() then leaves stored references alone.
    """
    if not with_references:
        near = adjacent_edges(chunks)
        none = chunks.sparkSession.createDataFrame([], "outcome string")
        return near, graph_stats(near, none, record_unresolved)
    refs = references(chunks, extractors, "doc_id")
    resolved = resolve(candidates(refs, anchor_index(chunks, min_body_chars), scopes(manifest, pins), document_anchors(manifest, pins, chunks)))
    near = adjacent_edges(chunks)
    edges = near.unionByName(reference_edges(resolved, record_unresolved))
    return edges, graph_stats(near, resolved, record_unresolved)


def graph_stats(near: DataFrame, resolved: DataFrame, record_unresolved: bool = True) -> DataFrame:
    n = lambda what: F.count_if(F.col("outcome") == what)
    counts = resolved.agg(n("resolved").alias("resolved"), n("unresolved").alias("unresolved"), n("ambiguous").alias("ambiguous"), n("self").alias("self_citations"))
    total = F.col("adjacent") + F.col("resolved") + (F.col("unresolved") if record_unresolved else F.lit(0))
    return near.agg(F.count(F.lit(1)).alias("adjacent")).crossJoin(counts).withColumn("edges", total)


def replace_edges(old: DataFrame, new: DataFrame, types: list[str]) -> DataFrame:
    """Old edges of other types with the new ones: a rebuild replaces what it builds."""
    return old.where(~F.col("edge_type").isin(types)).unionByName(new.where(F.col("edge_type").isin(types)))


def edges_from(edges: DataFrame, chunk: str) -> DataFrame:
    return edges.where(F.col("from_chunk") == chunk).orderBy("edge_type", "edge_id")


def edge_counts(edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """(from_doc, to_doc, n) of resolved reference edges, for all pairs at once."""
    own = chunks.select("chunk_id", "doc_id")
    return (
        edges.where("edge_type = 'references' and to_chunk is not null")
        .join(own.select(F.col("chunk_id").alias("from_chunk"), F.col("doc_id").alias("from_doc")), "from_chunk")
        .join(own.select(F.col("chunk_id").alias("to_chunk"), F.col("doc_id").alias("to_doc")), "to_chunk")
        .groupBy("from_doc", "to_doc")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def is_stale(manifest: DataFrame, pins: DataFrame, docs: DataFrame) -> DataFrame:
    """One row: whether the store has none of the manifest's documents although there are some."""
    known = documents_of(manifest, pins).select("doc_id").distinct()
    here = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    return known.agg(F.count(F.lit(1)).alias("known")).crossJoin(here.agg(F.count(F.lit(1)).alias("present"))).select(
        "known", "present", ((F.col("known") > 0) & (F.col("present") == 0)).alias("stale")
    )
