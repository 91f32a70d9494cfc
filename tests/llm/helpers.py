"""Small tables for the tests of this folder."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Extra columns with the names that the operators use inside.
EXTRA = ["_id", "_text", "_row", "kept", "label", "text_sha256"]


def docs_frame(spark, rows, extra=False):
    """rows: (doc_id, text) or (doc_id, text, lang); with ``extra``, clashing columns too."""
    schema = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    if extra:
        schema += [T.StructField(c, T.StringType()) for c in EXTRA]
        data = [(*d, *["x"] * len(EXTRA)) for d in data]
    return spark.createDataFrame(data, T.StructType(schema))


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def real_docs(spark, n=None):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()][:n]
