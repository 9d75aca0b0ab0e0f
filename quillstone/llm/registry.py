"""The queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import chat
from quillstone.llm.ball_kmeans import cluster_vectors
from quillstone.llm.common import table
from quillstone.llm.decontamination import contaminated
from quillstone.llm.exact_dedup import exact_dedup
from quillstone.llm.line_dedup import drop_lines
from quillstone.llm.minhash import near_duplicates
from quillstone.llm.pii import find_personal_data
from quillstone.llm.pieces import encode_documents
from quillstone.llm.quality import score_quality
from quillstone.llm.sharding import shard_documents
from quillstone.llm.spelling import SLIP, count_words, group_spellings
from quillstone.llm.suffix_dedup import remove_repeats
from quillstone.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes; n_links is left to the operator, since it counts the links by which the search went."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("n_links")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(count_words(table(spark, sf_dir, "documents"), slip=SLIP))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


_ALL = (
    op1_sharding, op2_quality_classifier, op3_pii, op4_sentencepiece, op5_chat_formatting, op6_benchmark_decontamination, op7_exact_dedup, op8_toxicity,
    op9_suffix_dedup, op10_minhash_near_dedup, op11_line_dedup, op12_spelling_variants, op13_centroid_clustering,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


#: Equal words of a document and an item by alignment; the best window starts at one of them or is the last that fits.
_OVERLAPS = r"""
    WITH i AS (
        SELECT item_id, row_number() OVER () AS ir, string_split(norm, ' ') AS t
        FROM (SELECT DISTINCT item_id, trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM benchmark)
    ), d AS (
        SELECT doc_id, row_number() OVER () AS dr, string_split(norm, ' ') AS t
        FROM (SELECT DISTINCT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM documents)
    ), iw AS (
        SELECT item_id, ir, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM i WHERE t <> ['']
    ), dw AS (
        SELECT doc_id, dr, len(t) AS m, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM d
    ), e AS (
        SELECT doc_id, dr, item_id, ir, n, iw.p AS p, dw.p - iw.p AS shift, least(n, 13) AS width,
               greatest(1, 1 - (dw.p - iw.p)) AS lo, least(n, m - (dw.p - iw.p)) - least(n, 13) + 1 AS hi
        FROM dw JOIN iw ON dw.w = iw.w
    ), c AS (
        SELECT *, count(*) OVER (PARTITION BY dr, ir, shift ORDER BY p RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM e WHERE hi >= lo
    ), a AS (
        SELECT any_value(doc_id) AS doc_id, any_value(item_id) AS item_id, any_value(n) AS n, any_value(width) AS width, count(*) AS matched,
               greatest(coalesce(max(c) FILTER (p <= hi), 0), count(*) FILTER (p >= hi)) AS best
        FROM c GROUP BY dr, ir, shift
    )
    SELECT doc_id, item_id, max(best) AS window_matches, max(matched) AS matched, max(n) AS item_tokens
    FROM a WHERE best >= width - CASE WHEN width = 13 THEN 2 WHEN width >= 8 THEN 1 ELSE 0 END
    GROUP BY doc_id, item_id
"""
#: All windows of 100 bytes, as hexadecimal digits, from blocks of 1,000 starts; tables whose ids are present and differ.
_REPEATS = """
    WITH b AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents
    ), parts AS (
        SELECT doc_id, n, k * 1000 AS start, substring(x, 2000 * k + 1, 2198) AS y FROM b, unnest(range(0, n // 1000 + 1)) AS u(k)
    ), w AS (
        SELECT doc_id, start + j AS s, substring(y, 2 * j + 1, 200) AS h FROM parts, unnest(range(0, least(1000, n - start - 99))) AS u(j)
    ), later AS (
        SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM w) WHERE r > 1
    ), marked AS (
        SELECT doc_id, s, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, -1) AS opens FROM later
    ), runs AS (
        SELECT doc_id, min(s) AS lo, max(s) + 100 AS hi
        FROM (SELECT doc_id, s, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked) GROUP BY doc_id, g
    ), ends AS (
        SELECT doc_id, lo, hi FROM runs UNION ALL SELECT doc_id, n, n FROM b
    ), pieces AS (
        SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi), 0) AS since FROM ends
    )
    SELECT doc_id, any_value(n) AS n_bytes, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) FILTER (hi > lo) AS n_spans,
           sha256(unhex(string_agg(substring(x, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo, hi))) AS kept_sha256
    FROM pieces JOIN b USING (doc_id) GROUP BY doc_id
"""
#: All pairs of different texts that share a shingle, and what links them up.
_CLASSES = r"""
    WITH RECURSIVE r AS (
        SELECT doc_id, CASE WHEN norm = '' THEN chr(10) || doc_id ELSE norm END AS node, norm
        FROM (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM documents)
    ), texts AS (
        SELECT row_number() OVER () AS id, node, string_split(any_value(norm), ' ') AS t FROM r GROUP BY node
    ), bags AS (
        SELECT id, array_to_string(t[p : p + 4], ' ') AS s, count(*) AS c
        FROM (SELECT id, t, unnest(range(1, greatest(2, len(t) - 3))) AS p FROM texts WHERE t <> ['']) GROUP BY ALL
    ), sizes AS (
        SELECT id, sum(c) AS n FROM bags GROUP BY id
    ), shared AS (
        SELECT a.id AS a, b.id AS b, sum(least(a.c, b.c)) AS n FROM bags a JOIN bags b ON a.s = b.s AND a.id <> b.id GROUP BY a.id, b.id
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE shared.n / CAST(x.n + y.n - shared.n AS DOUBLE) >= 0.8
    ), reach AS (
        SELECT id AS a, id AS b FROM texts UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), placed AS (
        SELECT doc_id, root FROM r JOIN texts USING (node) JOIN (SELECT a AS id, min(b) AS root FROM reach GROUP BY a) USING (id)
    )
    SELECT doc_id, min(doc_id) OVER (PARTITION BY root) AS class_id, count(*) OVER (PARTITION BY root) AS class_size,
           doc_id = min(doc_id) OVER (PARTITION BY root) AS kept
    FROM placed
"""
#: Tables whose ids are present and differ.
_LINES = r"""
    WITH d AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents
    ), l AS (
        SELECT doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, unnest(t) AS line, generate_subscripts(t, 1) AS p FROM d)
    ), k AS (
        SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    ), m AS (
        SELECT l.doc_id, p, line, coalesce(l.doc_id <> k.first, false) AS gone FROM l LEFT JOIN k ON l.key = k.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
"""

#: CRC-32 by its table of 256 remainders, made here bit by bit; near words by equal remains after one character is left out or masked.
_SPELLINGS = r"""
    WITH RECURSIVE remainders AS (
        SELECT range AS b, 0 AS step, range AS x FROM range(256)
        UNION ALL
        SELECT b, step + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) FROM remainders WHERE step < 8
    ), crc AS (
        SELECT list(x ORDER BY b) AS t FROM remainders WHERE step = 8
    ), runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 5 GROUP BY ALL
    ), hashed AS (
        SELECT w, n, xor(4294967295, list_reduce(
            list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END))),
            lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]))) AS h
        FROM runs, crc
    ), words AS MATERIALIZED (
        SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % 97 = 0 THEN w[: h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS w, n FROM hashed
        ) WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3
    ), cut AS (
        SELECT w, n, p, w[: p - 1] || w[p + 1 :] AS rest FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS p FROM words)
    ), near AS MATERIALIZED (
        SELECT a.w, b.w AS o, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.w <> b.w
        UNION SELECT a.w, b.w, b.n FROM cut a JOIN words b ON a.rest = b.w
        UNION SELECT b.w, a.w, a.n FROM cut a JOIN words b ON a.rest = b.w
    ), best AS (
        SELECT w, o, n, count(*) OVER (PARTITION BY w) AS n_near FROM near QUALIFY row_number() OVER (PARTITION BY w ORDER BY n DESC, o) = 1
    ), placed AS (
        SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * words.n THEN o END AS form, CASE WHEN best.n >= 2 * words.n THEN best.n END AS form_n
        FROM words LEFT JOIN best USING (w)
    ), ways AS (
        SELECT w, w AS here, form AS next FROM placed UNION ALL SELECT ways.w, ways.next, placed.form FROM ways JOIN placed ON placed.w = ways.next
    )
    SELECT w AS word, form, here AS root, n, n_near, form_n FROM placed JOIN (SELECT w, here FROM ways WHERE next IS NULL) USING (w)
"""


def _means(clusters: int = 8, rounds: int = 10) -> str:
    """Plain rounds of assignment and means, one after the other; tables whose ids are present and differ."""
    steps = [f"""
        e AS MATERIALIZED (
            SELECT vec_id, k, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
            FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k FROM embeddings WHERE len(embedding) = 64)
            QUALIFY count(*) FILTER (x IS NOT NULL AND isfinite(x)) OVER (PARTITION BY vec_id) = 64
        ), c0 AS MATERIALIZED (
            SELECT j, k, x AS c FROM e JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j FROM (SELECT DISTINCT vec_id FROM e)
            ) USING (vec_id) WHERE j < {clusters}
        )"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT vec_id, j, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM e JOIN c{r} USING (k) GROUP BY vec_id, j
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1
        )""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS MATERIALIZED (
            SELECT j, k, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c FROM (SELECT j, k, sum(x) AS s, count(*) AS n FROM e JOIN a{r} USING (vec_id) GROUP BY j, k)
            UNION ALL SELECT j, k, c FROM c{r} WHERE j NOT IN (SELECT j FROM a{r})
        )""")
    return "WITH" + ",".join(steps) + f"""
        SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} JOIN (SELECT j, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256 FROM c{rounds} GROUP BY j) USING (j)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_formatting": chat.SQL,
        "op6_benchmark_decontamination": _OVERLAPS,
        "op7_exact_dedup": r"""
            WITH d AS (
                SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
            )
            SELECT doc_id,
                   min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size,
                   doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
                   sha256(norm) AS text_sha256
            FROM d
        """,
        "op9_suffix_dedup": _REPEATS,
        "op10_minhash_near_dedup": _CLASSES,
        "op11_line_dedup": _LINES,
        "op12_spelling_variants": _SPELLINGS,
        "op13_centroid_clustering": _means(),
    }
