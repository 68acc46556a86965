"""Benchmark decontamination over item-sized SimHash windows (operator 8).

A document leaks a benchmark item if some window of the item's length in words has a weighted
(multiset) Jaccard similarity of MIN_SIMILARITY or more with it over word shingles.  DataFrame
functions only:

1. A window that similar holds enough of the item's shingles (`_needed`).  The places of shingles
   that some item has are found by a join on the shingle hash; a window may be moved right to
   its first such place (or to the document's end) without losing one, so windows are placed
   there, and only where enough places lie within the item's length.
2. Windows and items get 64-bit SimHash fingerprints of their shingle multisets.  A shingle's
   second, third, ... occurrence votes with a hash of its own: the multiset becomes a set of the
   same Jaccard, and no repeated shingle outweighs the others.  Fingerprints are cut into BLOCKS blocks; within RADIUS bits, one block differs in at most RADIUS // BLOCKS
   bits, so the items' blocks are indexed under every value that near and the windows' blocks
   are joined to them by equality: all fingerprints within RADIUS are found.
3. The candidates' similarity is computed exactly.

At similarity 0.8 a fingerprint differs in 9.6 bits on average (standard deviation 2.9), so
RADIUS = 19 loses about 0.05-0.1 % of the windows at the very threshold, and fewer the more
similar they are (none of 20,000 simulated at 0.9; a likelihood, not a guarantee).

Defined cases: items and documents without words match nothing; items shorter than a shingle are
one shingle; a document shorter than an item is one window; null ids are ids of their own;
repeated rows give one result row for each (doc_id, item_id); empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import stored

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 5
#: The items' shingle hashes are broadcast up to this many bytes, and shuffled beyond.
BROADCAST_BYTES = 32 << 20
_SPACE = " \t\n\x0b\f\r"


def _words(column: str):
    text = F.btrim(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(_SPACE))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, r"[\x20\x09-\x0D]+"))


def _shingles(words, k: int):
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k))))


def _needed(m, m_window, similarity: float):
    """Least number of common shingles of two multisets of these sizes at that similarity."""
    share = similarity / (1 + similarity)
    return F.greatest(F.lit(1), F.ceil((m + m_window) * share - 1e-9).cast("int"))


def _numbered(rows: DataFrame, hashes: str) -> DataFrame:
    """`rows` with a hash for each (hash, occurrence number) in `hashes`, in any order; the first
    occurrence keeps its hash.  Row by row, in the time of a sort; rows without a repeat stay."""
    all_, s, at = F.col(hashes), F.col("_sorted"), F.col("_runs")
    rows = rows.withColumn("_sorted", F.when(F.size(F.array_distinct(all_)) < F.size(all_), F.sort_array(all_)))
    rows = rows.withColumn("_runs", F.when(s.isNotNull(), F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (s[i] != s[F.greatest(i - 1, F.lit(0))]))))
    runs = F.zip_with(at, F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(s))), lambda a, b: F.transform(
        F.sequence(F.lit(1), b - a), lambda c: F.when(c == 1, s[a]).otherwise(F.xxhash64(s[a], c))))
    return rows.withColumn(hashes, F.coalesce(F.flatten(runs), all_)).drop("_sorted", "_runs")


def _fingerprints(rows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    """`keys` and fp: bit b is 1 if it is 1 in over half the hashes (bits 0 and 32, 1 and 33, ...
    are counted in the halves of one long)."""
    h = F.col("_h")
    rows = _numbered(rows, hashes)
    lanes = [F.sum(F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1 | 1 << 32))).alias(f"_s{b}") for b in range(32)]
    sums = rows.select(*keys, F.explode(hashes).alias("_h")).groupBy(*keys).agg(F.count("*").alias("_n"), *lanes)
    n, bits = F.col("_n"), []
    for b in range(32):
        low = F.col(f"_s{b}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(F.col(f"_s{b}"), 32)
        bits.append(F.when(low * 2 > n, F.lit(1 << b)).otherwise(F.lit(0).cast("long")))
        bits.append(F.when(high * 2 > n, F.lit(_signed(1 << (b + 32)))).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(n_blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each block."""
    edges = [64 * b // n_blocks for b in range(n_blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block_values(fp, n_blocks: int):
    return [F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)).cast("long")
            for low, width in _blocks(n_blocks)]


def _probe(block: int, value):
    return lambda mask: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(mask).alias("value"))


def hamming_candidates(windows: DataFrame, items: DataFrame, same: list[str],
                       radius: int = RADIUS, n_blocks: int = BLOCKS) -> DataFrame:
    """Pairs of rows of `windows` and `items` with equal `same` columns whose fingerprints `fp`
    differ in at most `radius` bits, with `bit_distance`.  No other column may be common."""
    near = radius // n_blocks
    probes = []
    for b, (value, (_, width)) in enumerate(zip(_block_values(F.col("item_fp"), n_blocks), _blocks(n_blocks))):
        masks = [sum(1 << x for x in c) for k in range(near + 1) for c in combinations(range(width), k)]
        probes.append(F.transform(F.array(*map(F.lit, masks)).cast("array<long>"), _probe(b, value)))
    index = items.withColumnRenamed("fp", "item_fp")
    index = index.withColumn("_p", F.explode(F.concat(*probes))).select("*", "_p.*").drop("_p")
    own = F.array(*[F.struct(F.lit(b).alias("block"), v.alias("value"))
                    for b, v in enumerate(_block_values(F.col("fp"), n_blocks))])
    keyed = windows.withColumn("_p", F.explode(own)).select("*", "_p.*").drop("_p")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    return (keyed.join(index, [*same, "block", "value"]).withColumn("bit_distance", distance)
            .filter(F.col("bit_distance") <= radius).drop("block", "value", "fp", "item_fp").distinct())


def leaks(docs: DataFrame, bench: DataFrame, min_similarity: float = MIN_SIMILARITY,
          radius: int = RADIUS, n_blocks: int = BLOCKS) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words, bit_distance (of the best window), and
    doc_key, which tells documents of one doc_id apart."""
    words = F.col("words")
    items = bench.select(F.col("item_id").cast("long").alias("item_id"),
                         F.xxhash64(F.col("item_id").cast("long"), "text").alias("item_key"),
                         _words("text").alias("words")).filter(F.size("words") > 0).distinct()
    k = F.least(F.size(words), F.lit(SHINGLE_WORDS))
    items = items.withColumn("k", k).withColumn("hashes", reduce(
        lambda other, n: F.when(F.col("k") == n, _shingles(words, n)).otherwise(other),
        range(1, SHINGLE_WORDS), _shingles(words, SHINGLE_WORDS)))
    items = stored(items.select("item_key", "item_id", "k", "hashes", F.size("hashes").alias("m")), "items")
    shingles = stored(items.select("item_key", "k", F.explode("hashes").alias("h"))
                      .groupBy("item_key", "k", "h").agg(F.count("*").alias("times")), "item_shingles")
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most SHINGLE_WORDS values
    if not sizes:
        sizes = [SHINGLE_WORDS]
    small = 40 * shingles.count() <= BROADCAST_BYTES

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc_key"), "text")
    found = []
    for n in sizes:
        wanted = shingles.filter(F.col("k") == n).select("h", "item_key")
        wanted = F.broadcast(wanted) if small else wanted
        spread = (keyed.select("doc_key", _words("text").alias("words"))
                  .select("doc_key", F.size("words").alias("n_words"), F.posexplode(_shingles(words, n)).alias("place", "h")))
        found.append(spread.join(wanted, "h").select("doc_key", "n_words", "item_key", "place"))
    places = (reduce(DataFrame.union, found).groupBy("doc_key", "item_key")
              .agg(F.first("n_words").alias("n_words"), F.array_sort(F.collect_set("place")).alias("places"))
              .join(items.select("item_key", "k", "m"), "item_key"))
    n_shingles = F.col("n_words") - F.col("k") + 1
    places = places.withColumn("m_window", F.least(F.col("m"), n_shingles))
    places = places.withColumn("t", _needed(F.col("m"), F.col("m_window"), min_similarity))
    at = F.col("places")
    starts = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(at) - F.col("t")),
                 lambda i: at[i + F.col("t") - 1] - at[i] < F.col("m_window")),
        lambda i: F.least(at[i], n_shingles - F.col("m_window")))
    windows = (places.filter(F.size(at) >= F.col("t"))
               .select("doc_key", F.explode(F.transform(F.array_distinct(starts), lambda s: F.struct(
                   "item_key", "k", "m", "m_window", s.alias("start")))).alias("window"))
               .groupBy("doc_key").agg(F.collect_list("window").alias("windows")))
    texts = keyed.join(windows, "doc_key").withColumn("words", _words("text"))
    pick = reduce(lambda other, n: F.when(F.col("w.k") == n, F.slice(
        F.col(f"hashes{n}"), F.col("w.start") + 1, F.col("w.m_window"))).otherwise(other),
        sizes, F.lit(None).cast("array<long>"))
    cut = stored(texts.select("doc_id", "doc_key", "windows", *[_shingles(words, n).alias(f"hashes{n}") for n in sizes])
                 .select("doc_id", "doc_key", F.explode("windows").alias("w"), *[f"hashes{n}" for n in sizes])
                 .select("doc_id", "doc_key", "w.*", pick.alias("hashes"))
                 .dropDuplicates(["doc_key", "item_key", "start"]), "windows")

    at_item = ["doc_key", "item_key", "start"]
    window_fps = _fingerprints(cut, [*at_item, "k", "m", "m_window"], "hashes")
    item_fps = _fingerprints(items, ["item_key", "k", "m"], "hashes")
    near = stored(hamming_candidates(
        window_fps.withColumnRenamed("item_key", "window_key"),
        item_fps, ["k", "m"], radius, n_blocks), "near_windows")
    window = ["doc_key", "window_key", "start"]
    counts = (cut.withColumnRenamed("item_key", "window_key")
              .select(*window, F.explode("hashes").alias("h")).groupBy(*window, "h").agg(F.count("*").alias("held")))
    common = (near.join(counts, window).join(shingles.select("item_key", "h", "times"), ["item_key", "h"])
              .groupBy(*window, "item_key", "m", "m_window", "k", "bit_distance")
              .agg(F.sum(F.least("held", "times")).alias("common")))
    similar = common.withColumn("similarity", F.col("common") / (F.col("m") + F.col("m_window") - F.col("common")))
    best = (similar.filter(F.col("similarity") >= min_similarity - 1e-12).groupBy("doc_key", "item_key")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("bit_distance")).alias("d"),
                                (F.col("m_window") + F.col("k") - 1).alias("n"))).alias("b")))
    ids = cut.select("doc_key", "doc_id").distinct()
    return (best.join(ids, "doc_key").join(items.select("item_key", "item_id"), "item_key").select(
        "doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.s")).alias("start_word"),
        F.col("b.n").alias("n_words"), (-F.col("b.d")).alias("bit_distance"), "doc_key"))


def drop_leaking(docs: DataFrame, bench: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """The documents without a leak, with their columns."""
    bad = leaks(docs, bench, min_similarity).select("doc_key").distinct()
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    return docs.join(bad, key == bad["doc_key"], "left_anti")
