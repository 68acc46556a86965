"""Exact deduplication against a persistent digest index (operator 5).

The index is a table bucketed and sorted by digest.  A batch is digested once, its groups are
formed with map-side aggregation, and a sort-merge anti-join leaves the digests that the index
does not know, which are then appended.

Defined cases: a null text counts as empty; all empty texts are one group; a null `doc_id` is an
id below every other; rows that repeat one doc_id with equal texts are one row to the operator
and get the same answer; an empty batch gives no rows and leaves the index as it was; further
columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.llm.common import SPACE_CHARS, fresh_path, shuffle_width, stored

INDEX_SCHEMA = "digest binary, keep_id long, keep_chars long, batch_id string"


def digested(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, digest): SHA-256 of the text without white space."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.translate(text, SPACE_CHARS, ""), 256)).alias("digest"))


class DigestIndex:
    """A table of known digests, bucketed and sorted by digest, in a shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or fresh_path(spark, "digest_index")
        self.buckets = buckets or shuffle_width(spark)
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        if not spark.catalog.tableExists(self.table):
            spark.sql(f"CREATE TABLE {self.table} ({INDEX_SCHEMA}) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame, batch_id: str) -> None:
        """Add the digests that are not there yet.  One Spark commit: a failed attempt leaves
        nothing, a repeated one finds its digests known and adds nothing."""
        new = groups.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
        (new.select("digest", "keep_id", "keep_chars", F.lit(batch_id).alias("batch_id"))
            .write.insertInto(self.table))

    def drop(self) -> None:
        """Forget the catalog entry; the files stay in the index folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def dedup_batch(docs: DataFrame, index: DigestIndex, batch_id: str = "batch") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size (rows of this batch), kept,
    text_sha256, n_chars.  Texts known to the index before the batch keep the indexed row."""
    rows = stored(digested(docs), "digests")
    groups = stored(
        rows.groupBy("digest")
        .agg(F.min(F.struct((-F.col("n_chars")).alias("less"), "doc_id")).alias("best"),
             F.count("*").alias("group_size"))
        .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"),
                (-F.col("best.less")).alias("keep_chars")), "digest_groups")
    index.append(groups, batch_id)
    known = index.rows().select("digest", F.col("keep_id").alias("index_id"))
    # Most texts stand alone and are their own keeper: only the others need an answer.
    answers = stored(
        groups.hint("merge").join(known, "digest")
        .filter("group_size > 1 OR NOT index_id <=> keep_id")
        .select("digest", "group_size", "index_id"), "digest_answers")
    own = F.col("index_id").isNull() & F.col("group_size").isNull()
    return (rows.join(answers, "digest", "left")
            .withColumn("keep_id", F.when(own, F.col("doc_id")).otherwise(F.col("index_id")))
            .select("doc_id", "keep_id", F.coalesce("group_size", F.lit(1)).alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "n_chars"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
           FROM documents),
w AS (SELECT doc_id, n, h,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY h) AS group_size
      FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256, n AS n_chars FROM w
"""
