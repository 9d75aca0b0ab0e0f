"""Small document tables with the cases that every operator has to stand."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names an operator could use itself.
CLASH = T.StructType(
    DOCS.fields
    + [T.StructField(x, T.StringType()) for x in ("h", "gid", "shard", "_n", "kept", "score", "node", "pos", "label", "norm", "count", "text_sha256")]
)


def docs(spark, texts, ids=None, schema=DOCS):
    ids = list(range(len(texts))) if ids is None else ids
    more = (len(schema.fields) - 5) * ("x",)
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), *more) for i, t in zip(ids, texts)], schema)
