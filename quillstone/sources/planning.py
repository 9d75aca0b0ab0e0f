"""What to fetch and from where: URL rules, the manifest and its checks, pins and what is cached."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats, file endings and the field names of manifests and pins.
FORMATS = ("html", "pdf", "other")
EXTENSIONS = {"html": ".html", "pdf": ".pdf"}
REQUIRED = ("doc_id", "url", "format", "license", "license_ok", "version")

_LISTS = ("tier_roles", "collision_terms", "references", "conflict_with")
MANIFEST = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("slug", "url", "format", "license")]
    + [T.StructField("license_ok", T.BooleanType())]
    + [T.StructField(x, T.StringType()) for x in ("version", "domain", "raw_cache", "rationale")]
    + [T.StructField(x, T.ArrayType(T.StringType())) for x in _LISTS]
)
PIN = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("doc_id", "recipe", "resolved_version", "content_hash", "content_type", "final_url", "format")]
    + [T.StructField(x, T.StringType()) for x in ("fetched_at", "source_url", "license")]
    + [T.StructField("license_ok", T.BooleanType()), T.StructField("raw_filename", T.StringType())]
)


class ManifestError(ValueError):
    """The manifest breaks a rule."""


@dataclass(frozen=True)
class CorpusConfig:
    """Sections of the settings; a section that is absent is empty."""

    fetch: dict = field(default_factory=dict)
    parse: dict = field(default_factory=dict)
    chunk: dict = field(default_factory=dict)
    contextualize: dict = field(default_factory=dict)
    citations: dict = field(default_factory=dict)
    graph: dict = field(default_factory=dict)
    index: dict = field(default_factory=dict)

    @classmethod
    def of(cls, raw: dict | None) -> CorpusConfig:
        return cls(**{k: (raw or {}).get(k) or {} for k in cls.__dataclass_fields__})


def load_config(path: str) -> CorpusConfig:
    return CorpusConfig.of(_yaml(path))


def _yaml(path: str):
    try:
        import yaml
    except ImportError:  # JSON is YAML too
        import json

        return json.loads(Path(path).read_text(encoding="utf-8"))
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def manifest_frame(spark: SparkSession, raw: object) -> DataFrame:
    """Rows of a parsed manifest, with defaults; a manifest of another shape raises ManifestError."""
    if not isinstance(raw, list):
        raise ManifestError("the manifest is not a list")
    rows = []
    for number, entry in enumerate(raw):
        if not isinstance(entry, dict):
            raise ManifestError(f"entry {number} is not a mapping")
        missing = [k for k in REQUIRED if entry.get(k) is None]
        if missing:
            raise ManifestError(f"entry {number} lacks {', '.join(missing)}")
        own = entry | {"slug": entry["doc_id"], "domain": entry.get("domain") or "unspecified"}
        text = lambda k, own=own: None if own.get(k) is None else str(own[k])
        rows.append(
            tuple(own["license_ok"] is True if f.name == "license_ok" else [str(x) for x in own.get(f.name) or []] if f.name in _LISTS else text(f.name) for f in MANIFEST)
        )
    return spark.createDataFrame(rows, MANIFEST)


def manifest_violations(manifest: DataFrame) -> DataFrame:
    """(slug, rule) for each rule that a row breaks: format, license, duplicate."""
    n = F.count(F.lit(1)).over(Window.partitionBy("slug"))
    broken = F.array(
        F.when(~F.col("format").isin(*FORMATS) | F.col("format").isNull(), F.lit("format")),
        F.when(~F.coalesce(F.col("license_ok"), F.lit(False)), F.lit("license")),
        F.when(n > 1, F.lit("duplicate")),
    )
    return manifest.select("slug", broken.alias("rules")).select("slug", F.explode(F.filter("rules", lambda x: x.isNotNull())).alias("rule"))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    manifest = manifest_frame(spark, _yaml(path))
    broken = manifest_violations(manifest).take(1)
    if broken:
        raise ManifestError(f"{broken[0].slug}: {broken[0].rule}")
    return manifest


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_matches(url: Column, hosts: Sequence[str], enabled: bool = True) -> Column:
    """Whether the URL's host is one of `hosts` or lies below one."""
    if not enabled or not hosts:
        return F.lit(False)
    host = _host(url)
    found = F.lit(False)
    for h in hosts:
        found = found | (host == h.lower()) | host.endswith(f".{h.lower()}")
    return found


def recipe(url: Column) -> Column:
    """local: no scheme, file, or a drive letter; arxiv: that host or one below; generic: the rest."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    local = (F.length(scheme) <= 1) | (scheme == "file")
    return F.when(local, "local").when(host_matches(url, ["arxiv.org"]), "arxiv").otherwise("generic")


def arxiv_id(url: Column) -> Column:
    """What follows /abs/, /pdf/ or /html/, or the last part of the path, without .pdf and version."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    marked = F.regexp_extract(path, r"/(?:abs|pdf|html)/(.+)$", 1)
    last = F.regexp_extract(path, r"([^/]*)/*$", 1)
    tail = F.when(marked != "", F.regexp_replace(marked, "^/+|/+$", "")).otherwise(last)
    return F.regexp_replace(F.regexp_replace(tail, r"\.pdf$", ""), r"v\d+$", "")


def arxiv_urls(url: Column, version: Column) -> tuple[Column, Column]:
    """The HTML and the PDF address of one version."""
    name = F.concat(arxiv_id(url), version)
    return F.concat(F.lit("https://arxiv.org/html/"), name), F.concat(F.lit("https://arxiv.org/pdf/"), name)


def plan_fetches(manifest: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """(slug, recipe, target_url) of the chosen rows; a chosen slug that the manifest lacks raises ManifestError."""
    if only is not None:
        known = {r.slug for r in manifest.where(F.col("slug").isin(list(only))).select("slug").distinct().collect()}
        if set(only) - known:
            raise ManifestError(f"not in the manifest: {', '.join(sorted(set(only) - known))}")
        manifest = manifest.where(F.col("slug").isin(list(only)))
    kind = recipe(F.col("url"))
    target = F.when(kind == "arxiv", arxiv_urls(F.col("url"), F.col("version"))[0]).otherwise(F.col("url"))
    return manifest.select("slug", kind.alias("recipe"), target.alias("target_url"))


def raw_name(slug: Column, fmt: Column) -> Column:
    ext = F.lit(".bin")
    for name, suffix in EXTENSIONS.items():
        ext = F.when(fmt == name, F.lit(suffix)).otherwise(ext)
    return F.concat(slug, ext)


def paths(slug: Column, raw_dir: str, contexts_dir: str, parsed_dir: str) -> Column:
    """Where a source's pin, contexts and parsed document lie."""
    at = lambda d, suffix: F.concat(F.lit(f"{d}/"), slug, F.lit(suffix))
    return F.struct(at(raw_dir, ".meta.json").alias("meta"), at(contexts_dir, ".json").alias("contexts"), at(parsed_dir, ".json").alias("parsed"))


def json_records(texts: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """The JSON objects of texts that hold one object, over any lines, or one object a line.

    What is broken, or is no object, gives no row.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    value = F.col(column)
    lines = F.filter(F.transform(F.split(value, "\n"), lambda x: F.trim(F.replace(x, F.lit("\r"), F.lit("")))), lambda x: x != "")
    by_line = F.forall(lines, lambda x: x.startswith("{") & x.endswith("}"))
    pieces = texts.select(F.explode(F.when(by_line, lines).otherwise(F.array(F.regexp_replace(value, r"\A\s+", "")))).alias("v")).where(F.col("v").startswith("{"))
    checked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return pieces.select(F.from_json("v", checked).alias("r")).where("r is not null and r._corrupt_record is null").select("r.*").drop("_corrupt_record")


def read_json(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """json_records() of whole files."""
    return json_records(spark.read.text(glob, wholetext=True), "value", schema)


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def restore_json(spark: SparkSession, path: str) -> None:
    """Brings back what a write_json() that was cut off between its two renames had put aside."""
    fs, at = _fs(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(at(path)) and fs.exists(at(f"{path}.old")):
        fs.rename(at(f"{path}.old"), at(path))


def write_json(rows: DataFrame, path: str) -> None:
    """A folder of JSON lines in place of the one that is there, which may be what the rows are read from.

    The new files are whole before the old ones are put aside, and these go last: at any time one of
    the two folders is complete, and restore_json() finds it.
    """
    spark = rows.sparkSession
    fs, at = _fs(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    restore_json(spark, path)
    rows.write.mode("overwrite").json(f"{path}.new")
    fs.delete(at(f"{path}.old"), True)
    if fs.exists(at(path)) and not fs.rename(at(path), at(f"{path}.old")):
        raise OSError(f"{path} can't be put aside")
    if not fs.rename(at(f"{path}.new"), at(path)):
        raise OSError(f"{path}.new can't be renamed")
    fs.delete(at(f"{path}.old"), True)


def pin_records(texts: DataFrame, column: str) -> DataFrame:
    """Pins (see PIN, doc_id as slug) of JSON texts."""
    return json_records(texts, column, PIN).where("doc_id is not null").withColumnRenamed("doc_id", "slug")


def read_pins(spark: SparkSession, glob: str) -> DataFrame:
    """One row for each pin in files that hold one object or one a line; a broken one gives no row."""
    return pin_records(spark.read.text(glob, wholetext=True), "value")


def write_pins(pins: DataFrame, path: str) -> None:
    """Pins (slug, ...) as JSON lines that read_pins() reads."""
    write_json(pins.withColumnRenamed("slug", "doc_id"), path)


def local_path(url: Column) -> Column:
    """Where a local source lies: the path of a file:// address with its %XX decoded, or the address itself."""
    plus = F.replace(F.regexp_replace(url, r"(?i)^file://(?:localhost)?", ""), F.lit("+"), F.lit("%2B"))
    return F.when(F.lower(F.substring(url, 1, 7)) == "file://", F.url_decode(plus)).otherwise(url)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def fetched(manifest: DataFrame, answers: DataFrame) -> DataFrame:
    """(slug, recipe, status, format, final_url, error) given what a connector has got.

    answers: url, content_hash, error. An arXiv source is taken as HTML or, if that failed, as PDF, and
    other sources from their address in their own format. A source without an answer, or with errors only,
    has status `error` and the last error; no source stops the others.
    """
    kind = recipe(F.col("url"))
    html, pdf = arxiv_urls(F.col("url"), F.col("version"))
    tries = F.when(kind == "arxiv", F.array(html, pdf)).otherwise(F.array(F.when(kind == "local", local_path(F.col("url"))).otherwise(F.col("url"))))
    rows = manifest.select("slug", F.col("format").alias("own"), kind.alias("recipe"), F.posexplode(tries).alias("nth", "try"))
    got = answers.select(F.col("url").alias("try"), "content_hash", "error")
    ok = F.col("content_hash").isNotNull()
    form = F.when(F.col("recipe") != "arxiv", F.col("own")).when(F.col("nth") == 0, "html").otherwise("pdf")
    rows = rows.join(got, "try", "left").withColumn("x", F.struct("nth", form.alias("format"), "try"))
    found = rows.groupBy("slug", "recipe").agg(F.min(F.when(ok, F.col("x"))).alias("x"), F.max_by("error", "nth").alias("error"))
    failed = F.col("x").isNull()
    return found.select(
        "slug", "recipe", F.when(failed, "error").otherwise("ok").alias("status"), "x.format", F.col("x.try").alias("final_url"),
        F.when(failed, F.coalesce("error", F.lit("no answer"))).alias("error"),
    )


def should_retry(status: Column, attempt: Column, retries: int) -> Column:
    """Whether a request is made again: after no answer (null status) or one of 500 and above, up to `retries` times; 4xx fail at once."""
    return (status.isNull() | (status >= 500)) & (attempt < retries)


def read_raw(spark: SparkSession, glob: str) -> DataFrame:
    """(raw_filename, content, content_hash) of raw files."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("raw_filename"), "content", content_hash(F.col("content")).alias("content_hash"))


def cached(pins: DataFrame, files: DataFrame) -> DataFrame:
    """Slugs whose pin names a raw file that exists."""
    return pins.where(F.col("raw_filename").isNotNull()).join(files.select("raw_filename"), "raw_filename", "left_semi").select("slug")


def fetch_decisions(manifest: DataFrame, pins: DataFrame, files: DataFrame) -> DataFrame:
    """(slug, recipe, status, resolved_version): cached sources keep their pin; of the others, local ones
    get the hash of their bytes (files has raw_filename = url) and remote ones the manifest's version."""
    have = cached(pins, files).withColumn("have", F.lit(True))
    local = files.select(F.col("raw_filename").alias("url"), F.concat(F.lit("sha256:"), F.col("content_hash")).alias("hashed"))
    rows = manifest.join(have, "slug", "left").join(pins.select("slug", F.col("resolved_version").alias("pinned")), "slug", "left").join(local, "url", "left")
    kind = recipe(F.col("url"))
    status = F.when(F.col("have"), "cached").when((kind == "local") & F.col("hashed").isNull(), "error").otherwise("ok")
    version = F.when(F.col("have"), F.col("pinned")).when(kind == "local", F.col("hashed")).otherwise(F.col("version"))
    return rows.select("slug", kind.alias("recipe"), status.alias("status"), version.alias("resolved_version"))
