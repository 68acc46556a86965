"""Connected components as DataFrame rounds (minimum label with pointer jumping)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b longs); root is the smallest node reached.

    Each round takes the smallest label among the neighbours (aggregated map-side) and then the
    label's own label, so paths shrink to half; every round is written to the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        hooked = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = stored(hooked.join(jump, "mid")
                     .select("node", F.least("mid", "far").alias("root"), "old"), "labels")
        if new.filter("root <> old").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")
