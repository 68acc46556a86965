"""SimHash near-deduplication (operator 9).

Fingerprints of 64 bits are split into blocks; two fingerprints at `max_bits` or fewer differing
bits agree in all but `max_bits` blocks, so they share the key made of some choice of the other
blocks (pigeonhole).  Fingerprints are made distinct first, so a group of copies is one entry.
Keys with few fingerprints are joined pair by pair; keys with many would give a square number
of pairs, so there each fingerprint is keyed by the rest of its bits with every choice of
`max_bits` bits blanked out: equal keys are exactly the links, in at most 2**max_bits entries.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer words
than a shingle make one shingle; an empty table gives no rows; rows that repeat a doc_id each get
a row; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import stored
from shopfold.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Keys with more fingerprints than this take the blanked-bits way (both ways are exact).
PAIRWISE_UP_TO = 48


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit b is 1 if it is 1 in over half the XXH64 values of the word shingles."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    ones, n, size = np.zeros(64, dtype=np.int64), 0, min(shingle_words, len(words))
    for a in range(0, len(words) - size + 1, 50_000):
        part = words[a:a + 50_000 + size - 1]
        grams = map(b" ".join, zip(*(part[k:len(part) - size + 1 + k] for k in range(size))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, doc_key, fp): the fingerprint as a signed long; the key tells rows of one doc_id
    with different texts apart."""
    def run(batches):
        for pdf in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "doc_key": pdf["doc_key"],
                                "fp": fps.view(np.int64)})

    doc_id = F.col("doc_id").cast("long")
    return (docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc_key"), "text")
            .mapInPandas(run, "doc_id long, doc_key long, fp long"))


def _block(column, k: int, n_blocks: int):
    low, high = 64 * k // n_blocks, 64 * (k + 1) // n_blocks
    return F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, n_blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (`fp`): every pair at max_bits or fewer bits
    is linked, directly or (in a shared blanked key) through the smallest of the key."""
    n_blocks = n_blocks or max_bits + 2
    choices = list(combinations(range(n_blocks), n_blocks - max_bits))
    fp = F.col("fp")
    keyed = stored(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(c).alias("choice"),
                 F.xxhash64(*[_block(fp, k, n_blocks) for k in blocks]).alias("key"))
        for c, blocks in enumerate(choices)])).alias("k")).select("fp", "k.choice", "k.key"),
        "simhash_keys")
    sizes = keyed.groupBy("choice", "key").count().filter("count > 1")
    shared = stored(keyed.join(sizes, ["choice", "key"]), "simhash_shared")
    few = shared.filter(F.col("count") <= PAIRWISE_UP_TO)
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (few.select("choice", "key", fp.alias("a"))
             .join(few.select("choice", "key", fp.alias("b")), ["choice", "key"])
             .filter((F.col("a") < F.col("b")) & (distance <= max_bits)).select("a", "b"))
    many = shared.filter(F.col("count") > PAIRWISE_UP_TO)
    # The bits outside the shared blocks, with every choice of max_bits of them blanked out.
    masks = []
    for blocks in choices:
        free = [b for k in range(n_blocks) if k not in blocks
                for b in range(64 * k // n_blocks, 64 * (k + 1) // n_blocks)]
        masks.append([_signed(~sum(1 << b for b in bits)) for bits in combinations(free, max_bits)])
    table = F.array(*[F.array(*[F.lit(m) for m in row]) for row in masks])
    blanked = many.select("fp", "choice", F.posexplode(F.element_at(table, F.col("choice") + 1))
                          .alias("mask", "bits"))
    stars = (blanked.groupBy("choice", "mask", fp.bitwiseAND(F.col("bits")).alias("left"))
             .agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1")
             .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
             .filter("a <> b"))
    return pairs.union(stars).distinct()


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _firsts(rows: DataFrame, one, max_bits: int) -> DataFrame:
    """Each fp of `rows` with the least `one` of its component."""
    classes = stored(rows.groupBy("fp").agg(F.min(one).alias("first_id")), "classes")
    roots = components(near_links(classes.select("fp"), max_bits))
    rooted = stored(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    merged = stored(rooted.join(lowest, "root").select("fp", "component_id"), "merged")
    return stored(classes.join(merged, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")), "answers")


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its component),
    doc_key."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    return rows.join(_firsts(rows, F.col("doc_id"), max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "doc_key")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with its columns: the smallest doc_id (null ids last), then the
    smallest doc_key.  Of rows that repeat both id and text any one stays."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    one = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    stays = F.col("doc_key") == F.col("component_id.doc_key")
    listed = stored(rows.join(_firsts(rows, one, max_bits), "fp").groupBy("doc_key")
                    .agg(F.max(stays).alias("stays"), F.count("*").alias("copies"))
                    .filter(~F.col("stays") | (F.col("copies") > 1)), "listed_copies")
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    twice = listed.filter("stays")
    return docs.join(listed, key == listed["doc_key"], "left_anti").unionAll(
        docs.join(twice, key == twice["doc_key"], "left_semi").dropDuplicates(["doc_id", "text"]))
