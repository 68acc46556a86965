"""The corpus pipeline: each stage applies one training-data operator to what the last one kept.

Every stage is written as Parquet to the shared folder and read again as the next one's input, so
a lost executor costs tasks of one stage.  All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm import common, decontamination, language_id, line_dedup, packing, simhash_dedup

#: A document is rejected if no language is found, or none with this share of the text.  A short
#: clean text with one foreign line (a licence, say) has a main language of about a half.
MIN_LANGUAGE_SHARE = 0.35
#: Also if a gram of it is so much less likely in its languages than among random bytes (an unlearned
#: script, random letters).  Unseen grams stand at -3.9; numbers and keys pull a short clean text to -1.4.
MIN_EVIDENCE = -2.0


def identify_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents without a letter, without a main language or in no learned language."""
    found = language_id.language_id(docs, common.documents(spark, sf_dir))
    bad = ((F.col("lang_pred") == language_id.UNKNOWN) | (F.col("score") < MIN_LANGUAGE_SHARE)
           | F.coalesce(F.col("evidence") < MIN_EVIDENCE, F.lit(False)))
    gone = found.filter(bad).select("doc_key").distinct()
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    return docs.join(gone, key == gone["doc_key"], "left_anti")


def dedup_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated lines; documents of which no visible line is left go."""
    counts = "line_counts"
    while counts in docs.columns:
        counts += "_"
    done = line_dedup.dedup_lines(docs, counts)
    shorter = F.col(counts).getField("removed") > 0
    done = done.filter(~F.coalesce(shorter & (F.btrim("text", F.lit(common.SPACE_CHARS)) == ""), F.lit(False)))
    if "n_chars" in docs.columns:
        length = F.when(shorter, F.char_length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def dedup_near(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash_dedup.drop_near_copies(docs)


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaking(docs, common.benchmark(spark, sf_dir))


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can't tokenise or infer languages: tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
