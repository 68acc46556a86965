"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopfold.llm import (
    centroids, common, decontamination, exact_dedup, language_id, line_dedup, packing, quality, ranked_search,
    simhash_dedup, suffix_dedup, token_counts, token_output, topk_search)


def op1_suffix_dedup(spark, sf_dir):
    n_kept = F.octet_length("kept").cast("long")
    return suffix_dedup.remove_repeats(common.documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - n_kept).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark, sf_dir):
    """All documents, maintained: one id in 20 is loaded under another source and revised, one is
    deleted and inserted again; a batch that is sent twice changes nothing."""
    docs = common.documents(spark, sf_dir)
    part = F.when(F.col("doc_id").isNull(), -1).otherwise(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(20)))
    rollup = token_counts.TokenRollup(spark)
    rollup.apply("1-load", docs.withColumn("op", F.lit("insert")).withColumn(
        "source", F.when(part == 0, F.lit("unsorted")).otherwise(F.col("source"))))
    changes = docs.filter(part.isin(0, 1)).withColumn("op", F.when(part == 0, "revise").otherwise("delete"))
    for _ in range(2):
        rollup.apply("2-change", changes)
    rollup.apply("3-again", docs.filter(part == 1).withColumn("op", F.lit("insert")))
    return rollup.totals()


def op3_line_dedup(spark, sf_dir):
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "line_counts.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_quality_grades(spark, sf_dir):
    return quality.grade_documents(common.documents(spark, sf_dir), common.labels(spark, sf_dir))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_batch(common.documents(spark, sf_dir), exact_dedup.DigestIndex(spark))


def op6_token_output(spark, sf_dir):
    path = common.fresh_path(spark, "token_files")
    token_output.write_token_files(common.documents(spark, sf_dir), path)
    return token_output.read_token_files(spark, path)


def op7_packing(spark, sf_dir):
    return packing.pack(common.documents(spark, sf_dir))


def op8_decontamination(spark, sf_dir):
    return decontamination.leaks(common.documents(spark, sf_dir), common.benchmark(spark, sf_dir)).drop("doc_key")


def op9_simhash_dedup(spark, sf_dir):
    return simhash_dedup.simhash_groups(common.documents(spark, sf_dir)).drop("doc_key")


def op10_language_id(spark, sf_dir):
    return language_id.language_id(common.documents(spark, sf_dir)).drop("doc_key")


def op11_centroid_clustering(spark, sf_dir):
    return centroids.clustering_report(common.embeddings(spark, sf_dir))


def op12_topk_search(spark, sf_dir):
    is_query = F.col("vec_id") % topk_search.QUERY_EVERY == 0
    return topk_search.exact_top_k(common.embeddings(spark, sf_dir), is_query).drop("query_row")


def op13_ranked_search(spark, sf_dir):
    return ranked_search.ranked_search(common.documents(spark, sf_dir), common.benchmark(spark, sf_dir)).drop("item_row")


OPERATORS = (op1_suffix_dedup, op2_token_counts, op3_line_dedup, op4_quality_grades, op5_exact_dedup,
             op6_token_output, op7_packing, op8_decontamination, op9_simhash_dedup, op10_language_id,
             op11_centroid_clustering, op12_topk_search, op13_ranked_search)


def queries() -> dict:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": exact_dedup.ORACLE_SQL, "op11_centroid_clustering": centroids.oracle_sql(),
            "op12_topk_search": topk_search.ORACLE_SQL, "op13_ranked_search": ranked_search.ORACLE_SQL}
