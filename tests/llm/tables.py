"""Small tables of the tests (a module of its own: `conftest` names several modules in one run)."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows, schema=DOCS):
    """(doc_id, text) pairs as a documents table."""
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], schema).repartition(3)


def clash(df):
    """The table with further columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["doc_key", "lines", "fp", "digest", "row", "part", "bucket", "words", "near", "gone", "left",
             "split", "others", "maybe", "repeats", "keep_id", "kept", "spans", "blob", "line_counts", "tail"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])
