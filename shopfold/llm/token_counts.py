"""Token counts as delta-maintained rollups (operator 2).

A rollup folder has a ledger of signed rows for each document and tokenizer version, and the
additive deltas by source, language and version, both in one folder for each batch.  A batch of
inserts, revisions and deletes is counted once; the rows it replaces are looked up in the ledger
and entered with the opposite sign.  A batch is committed when its delta folder is complete;
applying it again changes nothing, and an attempt that broke off is overwritten.

Defined cases: a null text has no tokens but counts as a document; null source or language is a
group of its own; of several changes to one doc_id in a batch the one with the highest `seq`
counts (without `seq`, or for equal ones, the largest text hash); inserting a known id revises
it; deleting an unknown id does nothing; rows with a null doc_id can't be addressed, so each is
inserted as a document of its own and other changes to a null id do nothing; empty batches commit
an empty delta; further columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.llm.common import fresh_path, memo_tokenizer, slices, stored
from shopfold.session import path_exists

#: version name -> (vocabulary file, whether a word takes its leading space)
TOKENIZERS = {"byte_bpe_50k/1": ("byte_bpe_50k.json", True),
              "word_bpe_49k/1": ("word_bpe_49k.json", False)}
LEDGER = ("doc_id long, source string, lang string, tokenizer string, docs long, "
          "tokens long, chars long")


def token_counts(changes: DataFrame, tokenizers: dict[str, tuple[str, bool]]) -> DataFrame:
    """The columns of `changes` but the text, with text hash, chars, and a map version -> tokens."""
    kept = [c for c in changes.columns if c != "text"]

    def run(batches):
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            counts = [{} for _ in texts]
            for name, (file, keeps_space) in tokenizers.items():
                encoder = memo_tokenizer(file, keeps_space)
                at = 0
                for a, b in slices([len(t) for t in texts], 2_000_000):
                    for ids in encoder.encode(texts[a:b]):
                        counts[at][name] = len(ids) // 4
                        at += 1
            out = pdf.drop(columns="text")
            out["counts"] = counts
            yield out

    kinds = dict(changes.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    rows = changes.select(*kept, "text", F.xxhash64("text").alias("_hash"),
                          F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("_chars"))
    return rows.mapInPandas(run, f"{schema}, _hash long, _chars long, counts map<string,long>")


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str | None = None,
                 tokenizers: dict[str, tuple[str, bool]] | None = None):
        self.spark = spark
        self.path = path or fresh_path(spark, "token_rollup")
        self.tokenizers = tokenizers or TOKENIZERS

    def _folder(self, kind: str, batch_id: str = "") -> str:
        return f"{self.path}/{kind}" + (f"/batch={batch_id}" if batch_id else "")

    def committed(self, batch_id: str) -> bool:
        return path_exists(self.spark, self._folder("deltas", batch_id) + "/_SUCCESS")

    def _batches(self) -> list[str]:
        """Committed batches; a ledger folder without its delta folder is not read."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self._folder("deltas"))
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top)]
        return sorted(b for n in names if n.startswith("batch=") and self.committed(b := n[6:]))

    def _read(self, kind: str) -> DataFrame:
        paths = [self._folder(kind, b) for b in self._batches()]
        if not paths:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*paths)

    def state(self) -> DataFrame:
        """What the committed batches left: one row for each document and version."""
        return (self._read("ledger").groupBy("doc_id", "source", "lang", "tokenizer")
                .agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")])
                .filter("docs > 0"))

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """`changes`: doc_id, text, source, lang, op ('insert', 'revise' or 'delete') and, if
        wanted, seq.  False if the batch was committed before."""
        if self.committed(batch_id):
            return False
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")
        rows = changes.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"), F.col("op"), seq.alias("seq"),
            F.when(F.col("op") != "delete", F.col("text")).alias("text"))
        counted = stored(token_counts(rows, self.tokenizers), "token_counts")
        final = (counted.filter("doc_id IS NOT NULL").groupBy("doc_id")
                 .agg(F.max(F.struct("seq", "_hash", "op", "source", "lang", "_chars",
                                     F.map_entries("counts").alias("counts"))).alias("c"))
                 .select("doc_id", "c.op", "c.source", "c.lang", "c._chars", "c.counts"))
        nameless = counted.filter("doc_id IS NULL AND op = 'insert'").select(
            "doc_id", "op", "source", "lang", "_chars", F.map_entries("counts").alias("counts"))
        plus = (final.filter("op <> 'delete'").union(nameless)
                .select("doc_id", "source", "lang", "_chars", F.explode("counts").alias("n"))
                .select("doc_id", "source", "lang", F.col("n.key").alias("tokenizer"),
                        F.lit(1).cast("long").alias("docs"), F.col("n.value").alias("tokens"),
                        F.col("_chars").alias("chars")))
        entries = plus
        if self._batches():
            minus = self.state().join(final.select("doc_id"), "doc_id", "left_semi")
            entries = plus.union(minus.select(
                "doc_id", "source", "lang", "tokenizer",
                *[(-F.col(c)).alias(c) for c in ("docs", "tokens", "chars")]))
        ledger = self._folder("ledger", batch_id)
        entries.write.mode("overwrite").parquet(ledger)
        (self.spark.read.schema(LEDGER).parquet(ledger)
            .groupBy("source", "lang", "tokenizer")
            .agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")])
            .withColumn("doc_id", F.lit(None).cast("long"))
            .write.mode("overwrite").parquet(self._folder("deltas", batch_id)))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens, chars: the sum of the committed deltas."""
        return (self._read("deltas").groupBy("source", "lang", "tokenizer")
                .agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "chars")])
                .filter("docs > 0"))
