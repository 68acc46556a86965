"""Line deduplication over a deletion neighbourhood (operator 3).

Lines are compared with white space collapsed.  A line goes if an earlier line (by doc_id, then
line number) equals it, or lies within one edit (insertion, deletion or substitution of a
character) of it; the earliest stays.  Equal lines go whatever their length, down to MIN_CHARS
(blank lines stay); lines of fewer than MIN_EDIT_CHARS go only for an equal one.

Emitting every deletion variant of every line would be a row for each character of the corpus,
so variants are emitted where a partner is possible, in two lossless steps:

1. within one edit, either the first or the last `_shared_length` characters of two lines are
   the same: lines that share neither with another distinct line have no partner;
2. with the line cut into BLOCKS parts, all parts but the edited one agree: lines that share
   "all but part j" with another distinct line emit the deletion variants of part j.

Equal variants meet by grouping, never as pairs: for a substitution the variants have the same
gap, for an insertion one is the whole part of the shorter line.  Each group yields its earliest
line, whose edit distance to the members is verified on the texts.

Defined cases: a null text has no lines and stays null; blank lines stay; rows that repeat a
doc_id with the same text are one document and keep the same lines, with different texts they
follow each other by text hash; null doc_ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import fresh_path, shuffle_width, stored

MIN_CHARS = 1
MIN_EDIT_CHARS = 32
BLOCKS = 16
#: Order of a line: documents by id, equal ids by text hash, then the line number.
ORDER = ["doc_id", "doc_key", "line_no"]


def _shared_length(n: int) -> int:
    """Length of the first (last) part that a line of n characters shares with a partner of n or
    n + 1 characters whose one edit lies behind (before) it."""
    return n // 32 * 16


def line_table(docs: DataFrame) -> DataFrame:
    """One row for each line that may go: its place, a 64-bit id and length of the collapsed
    line, and the keys of the parts that a partner within one edit would share."""
    def run(batches):
        import xxhash
        hash64 = xxhash.xxh3_64_intdigest
        for pdf in batches:
            rows = []
            for doc_id, key, text in zip(pdf["doc_id"], pdf["doc_key"], pdf["text"]):
                for k, line in enumerate((text or "").split("\n")):
                    line = " ".join(line.split())
                    n = len(line)
                    if n < MIN_CHARS:
                        continue
                    keys = []
                    if n >= MIN_EDIT_CHARS:
                        for part in {_shared_length(n), _shared_length(n - 1)} - {0}:
                            keys.append(hash64("<" + line[:part]) >> 1)
                            keys.append(hash64(">" + line[-part:]) >> 1)
                    rows.append((doc_id, key, k, hash64(line) - (1 << 63), n, keys))
            out = pd.DataFrame(rows, columns=["doc_id", "doc_key", "line_no", "line_id", "n", "keys"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.mapInPandas(
        run, "doc_id long, doc_key long, line_no int, line_id long, n int, keys array<long>")


def _document_rows(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc_key"), "text")


def _block_rows(lines: DataFrame) -> DataFrame:
    """For each line, as the shorter or the longer of two, and each part j: the key of all but j
    and the part itself."""
    n = F.char_length("line")
    cut = lines.select(*ORDER, "line", F.explode(F.array(n, n - 1)).alias("m")).select(
        *ORDER, "line", "m", (n > F.col("m")).alias("longer"),
        F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("j"))
    low = F.floor(F.col("m") * F.col("j") / BLOCKS).cast("int")
    high = F.floor(F.col("m") * (F.col("j") + 1) / BLOCKS).cast("int")
    rest = F.col("m") - high
    return cut.select(
        *ORDER, "longer", F.struct("m", "j", F.xxhash64(
            F.substring("line", F.lit(1), low), F.lit("|"),
            F.substring("line", n - rest + 1, rest)).alias("rest")).alias("part"),
        F.substring("line", low + 1, n - rest - low).alias("text"))


def near_lines(lines: DataFrame) -> DataFrame:
    """Places of the lines within one edit of an earlier one.  `lines`: ORDER and the distinct
    collapsed `line` of each."""
    place = F.struct(*ORDER)
    parts = stored(_block_rows(lines), "line_parts")
    shared = parts.groupBy("part").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b")
    parts = parts.join(shared.select("part"), "part", "left_semi")
    size = F.char_length("text")
    gaps = F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        i.alias("gap"), F.concat(F.substring("text", F.lit(1), i - 1),
                                 F.substring("text", i + 1, size)).alias("variant"))))
    whole = F.array(F.struct(F.lit(0).alias("gap"), F.col("text").alias("variant")))
    variants = parts.select(*ORDER, "part", "longer", F.explode(
        F.when(F.col("longer"), gaps).otherwise(F.concat(F.coalesce(gaps, F.array().cast(
            "array<struct<gap:int,variant:string>>")), whole))).alias("v"))
    # Substitutions meet at the same gap (of lines of one length); insertions meet the whole part.
    keyed = stored(variants.select(
        *ORDER, "longer", F.xxhash64("part", F.when(F.col("longer"), 0).otherwise(F.col("v.gap")),
                                     "v.variant").alias("key"),
        (~F.col("longer") & (F.col("v.gap") > 0)).alias("substitution")), "line_variants")
    # Within an insertion group the whole part belongs to one line and the others are one longer:
    # a line's partner is the earliest of the other kind; within a substitution group, of its own.
    side = F.when(F.col("substitution"), 2).when(F.col("longer"), 1).otherwise(0)
    heads = (keyed.withColumn("meets", F.when(side == 2, 2).otherwise(1 - side))
             .groupBy("key", F.col("meets").alias("side")).agg(F.min(place).alias("head")))
    met = (keyed.withColumn("side", side).join(heads, ["key", "side"])
           .filter(F.col("head") < place)
           .select(*ORDER, F.col("head.doc_id").alias("h_doc_id"), F.col("head.doc_key").alias("h_doc_key"),
                   F.col("head.line_no").alias("h_line_no")).distinct())
    # Verify on the texts.
    same = [F.col(f"h_{c}").eqNullSafe(F.col(f"t_{c}")) for c in ORDER]
    other = lines.select(*[F.col(c).alias(f"t_{c}") for c in ORDER], F.col("line").alias("h_line"))
    mine = [met[c].eqNullSafe(lines[c]) for c in ORDER]
    return (met.join(other, same[0] & same[1] & same[2])
            .join(lines, mine[0] & mine[1] & mine[2])
            .filter(F.levenshtein("line", "h_line", 1).between(0, 1))
            .select(*[met[c] for c in ORDER]).distinct())


def _collapsed(rows: DataFrame) -> DataFrame:
    """ORDER and the collapsed text of the lines that `maybe` lists."""
    def run(batches):
        for pdf in batches:
            out = []
            for doc_id, key, text, maybe in zip(pdf["doc_id"], pdf["doc_key"], pdf["text"], pdf["maybe"]):
                lines = text.split("\n")
                out.extend((doc_id, key, k, " ".join(lines[k].split())) for k in maybe)
            frame = pd.DataFrame(out, columns=[*ORDER, "line"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return rows.filter("size(maybe) > 0").select("doc_id", "doc_key", "text", "maybe").mapInPandas(
        run, "doc_id long, doc_key long, line_no int, line string")


def _with_first_answers(docs: DataFrame) -> DataFrame:
    """The documents in buckets by doc_key, with the numbers of their lines that repeat an
    earlier one, and of those that may lie within one edit of another.  The texts are shuffled
    once; in their buckets they meet the later answers in place."""
    spark = docs.sparkSession
    places = stored(line_table(_document_rows(docs)), "line_places")
    place = F.struct(*ORDER)
    first = F.struct(*[f"first_{c}" for c in ORDER])
    lines = stored(
        places.groupBy("line_id", "n").agg(F.min(place).alias("first"), F.first("keys").alias("keys"),
                                           F.count("*").alias("copies"))
        .select("line_id", "n", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ORDER], "keys", "copies"),
        "distinct_lines")
    repeats = (places.select(*ORDER, "line_id", "n")
               .join(lines.filter("copies > 1").drop("keys", "copies"), ["line_id", "n"])
               .filter(place > first).select("doc_key", "line_no", F.lit(False).alias("maybe")))
    # The first line of each text stands for it: one row for each key of a part it may share.
    keyed = lines.select(F.col("first_doc_key").alias("doc_key"), F.col("first_line_no").alias("line_no"),
                         F.explode("keys").alias("key"))
    one = F.struct("doc_key", "line_no")
    shared = keyed.groupBy("key").agg(F.min(one).alias("a"), F.max(one).alias("b")).filter("a <> b").select("key")
    maybe = (keyed.join(shared, "key", "left_semi").select("doc_key", "line_no").distinct()
             .withColumn("maybe", F.lit(True)))
    listed = repeats.union(maybe).groupBy("doc_key").agg(
        F.collect_set(F.when(~F.col("maybe"), F.col("line_no"))).alias("repeats"),
        F.collect_set(F.when(F.col("maybe"), F.col("line_no"))).alias("maybe"))
    none = F.array().cast("array<int>")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc_key"), "text",
        (F.struct(*others) if others else F.lit(None).cast("string")).alias("others"))
    table = f"line_docs_{uuid.uuid4().hex}"
    (rows.join(listed, "doc_key", "left")
         .select("doc_id", "doc_key", "text", "others", F.coalesce("repeats", none).alias("repeats"),
                 F.coalesce("maybe", none).alias("maybe"))
         .write.bucketBy(shuffle_width(spark), "doc_key").option("compression", "zstd")
         .option("path", fresh_path(spark, "line_docs")).saveAsTable(table))
    return spark.table(table)


def dedup_lines(docs: DataFrame, counts_name: str = "line_counts") -> DataFrame:
    """The documents with their columns and what is left of the text, and a struct `counts_name`
    with n (lines before), removed, and near (those removed for a line within one edit)."""
    rows = _with_first_answers(docs)
    lines = stored(_collapsed(rows).dropDuplicates(ORDER), "line_texts")
    near = near_lines(lines).groupBy("doc_key").agg(F.collect_set("line_no").alias("near"))
    none = F.array().cast("array<int>")
    gone = F.array_union("repeats", "near")
    done = (rows.join(near, "doc_key", "left").withColumn("near", F.coalesce("near", none))
            .withColumn("gone", gone).withColumn("split", F.split("text", "\n"))
            .withColumn("left", F.array_join(F.filter(
                "split", lambda _, k: ~F.array_contains(F.col("gone"), k)), "\n")))
    counts = F.struct(F.coalesce(F.size("split"), F.lit(0)).alias("n"), F.size("gone").alias("removed"),
                      F.size("near").alias("near"))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("left")}
    return done.select(*[columns[c].alias(c) if c in columns else F.col("others").getField(c).alias(c)
                         for c in docs.columns], counts.alias(counts_name))
