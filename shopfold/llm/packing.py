"""Packing documents into sequences by cutting-stock column generation (operator 7).

Every document is cut into whole sequences of `SEQUENCE` ids and one tail.  Tails are grouped in
length classes; a linear program over patterns (which classes share a sequence) is solved by
column generation, an unbounded-knapsack dynamic program pricing the columns.  The rounded-down
pattern counts are handed to the documents by their rank within the class.  The tails left over
by rounding (fewer than patterns times tails in a pattern, whatever the input's size) are laid
end to end and cut at the sequence boundaries.

The histogram (one row for each class) and the patterns are all that reaches the driver.

Defined cases: a null text counts as empty and is packed as its end id alone; a repeated doc_id
is packed once for each row; a null doc_id is packed like any other; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopfold.llm.common import memo_tokenizer, shuffle_width, slices, stored

SEQUENCE = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = np.array([1], dtype="<u4").tobytes()
#: Tails whose lengths differ by less than this share a class (its upper end is planned with).
CLASS_WIDTH = 4
#: The plan is within this share of the linear program's optimum, or stops at so many columns.
GAP, MAX_COLUMNS = 1e-3, 1500
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


# --- the plan -----------------------------------------------------------------

def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best total value and how often each item is taken."""
    use = np.flatnonzero(values > 1e-12)
    taken = np.zeros(len(values), dtype=np.int64)
    if not len(use):
        return 0.0, taken
    v, s = values[use], sizes[use]
    order = np.argsort(s, kind="stable")
    v, s, use = v[order], s[order], use[order]
    fits = np.searchsorted(s, np.arange(capacity + 1), side="right")
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        best[w], pick[w] = best[w - 1], -1
        if k := fits[w]:
            got = best[w - s[:k]] + v[:k]
            j = int(got.argmax())
            if got[j] > best[w] + 1e-15:
                best[w], pick[w] = got[j], j
    w = capacity
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            taken[use[pick[w]]] += 1
            w -= int(s[pick[w]])
    return float(best[capacity]), taken


def first_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A starting basis: fill a sequence with the largest sizes that are left and fit, use it as
    often as lasts, and go on.  Each pattern uses up one size, so the basis is triangular."""
    left = demand.astype(float)
    m, tiny = len(sizes), 1e-9 * demand.max()
    patterns, times, done = np.zeros((m, m)), np.zeros(m), np.zeros(m, dtype=bool)
    largest = np.argsort(-sizes, kind="stable").tolist()
    for k in range(m):
        if (left <= tiny).all():  # several were used up together: the rest of the basis is idle
            spare = np.flatnonzero(~done)
            patterns[np.arange(k, m), spare] = 1
            break
        room = capacity
        for c in largest:
            if left[c] > tiny and sizes[c] <= room:
                patterns[k, c] += 1
                room -= int(sizes[c])
        used = np.flatnonzero(patterns[k])
        last = used[np.argmin(left[used] / patterns[k, used])]
        times[k] = left[last] / patterns[k, last]
        left[used] = np.maximum(left[used] - times[k] * patterns[k, used], 0.0)
        left[last], done[last] = 0.0, True
    return patterns, times


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination over the few rows that a column touches.  (np.linalg.inv can wait
    for ever for its threads when the process has started Spark's JVM before.)"""
    m = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(m)])
    for c in range(m):
        pivot = c + int(np.argmax(np.abs(work[c:, c])))
        if not work[pivot, c]:
            raise np.linalg.LinAlgError("Singular matrix")
        if pivot != c:
            work[[c, pivot]] = work[[pivot, c]]
        work[c] /= work[c, c]
        rows = np.flatnonzero(work[:, c])
        rows = rows[rows != c]
        work[rows] -= work[rows, c][:, None] * work[c]
    return work[:, m:]


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_columns: int = MAX_COLUMNS,
                  gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows: how many of each size) and the whole number of times to use each.

    Revised simplex on  min sum(x)  with  A x = demand, x >= 0, columns made by `price`.  If the
    best column is worth v, no plan is better than 1 / v of this one (Farley's bound): stopping
    at v <= 1 + gap, or at `max_columns`, leaves a feasible plan."""
    m = len(sizes)
    # Slightly uneven demands keep the simplex from standing still at ties.
    uneven = demand * (1 + 1e-6 * np.random.default_rng(7).random(m))
    patterns, x = first_patterns(sizes, uneven, capacity)
    basis = patterns.T.copy()
    inverse = inverse_of(basis)
    for step in range(max_columns):
        if step and step % 100 == 0:  # clear rounding errors
            inverse = inverse_of(basis)
            x = np.maximum(inverse @ uneven, 0.0)
        value, column = price(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + gap:
            break
        d = inverse @ column
        ratio = np.full(m, np.inf)
        np.divide(x, d, out=ratio, where=d > 1e-7)
        if not np.isfinite(ratio.min()):
            break
        # Of the rows that give way first, the one with the largest pivot.
        first = np.flatnonzero(ratio <= ratio.min() + 1e-9 * (1 + x.max()))
        out = int(first[np.argmax(d[first])])
        step_size = ratio[out]
        x = np.maximum(x - step_size * d, 0.0)
        x[out] = step_size
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
        basis[:, out] = column
    times = np.floor(x + 1e-3).astype(np.int64)
    patterns = np.rint(basis.T).astype(np.int64)
    used = times > 0
    patterns, times = patterns[used], times[used]
    # Rounding errors in x must not plan more of a class than there is.
    for c in range(m):
        for p in np.flatnonzero((patterns[:, c] > 0) & (times > 0)).tolist() if len(times) else ():
            if (over := int(patterns[:, c] @ times - demand[c])) <= 0:
                break
            times[p] = max(0, times[p] - -(-over // int(patterns[p, c])))
    return patterns[times > 0], times[times > 0]


def allocations(classes: np.ndarray, patterns: np.ndarray, times: np.ndarray) -> list[tuple]:
    """(class, first rank, end rank, tails per sequence, first slot, first sequence)."""
    rows, next_rank = [], dict.fromkeys(classes.tolist(), 0)
    first_sequence = 0
    for pattern, n in zip(patterns, times.tolist()):
        slot = 0
        for c, k in zip(classes.tolist(), pattern.tolist()):
            if k and n:
                rows.append((c, next_rank[c], next_rank[c] + k * n, k, slot, first_sequence))
                next_rank[c] += k * n
                slot += k
        first_sequence += n
    return rows


# --- the documents ------------------------------------------------------------

def _crcs(ids: bytes, cuts) -> list[int]:
    return [zlib.crc32(ids[4 * a:4 * b]) for a, b in cuts]


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, doc_tokens, whole (whole sequences), tail (ids after them), doc_crc, and the
    checksums of the whole sequences and the tail."""
    def run(batches):
        encoder = memo_tokenizer(tokenizer, True)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            rows = []
            for a, b in slices([len(t) for t in texts], 2_000_000):
                for ids in encoder.encode(texts[a:b]):
                    ids += END_ID
                    n = len(ids) // 4
                    edges = [(k, min(k + sequence, n)) for k in range(0, n, sequence)]
                    rows.append((n, n // sequence, n % sequence, zlib.crc32(ids), _crcs(ids, edges)))
            out = pd.DataFrame(rows, columns=["doc_tokens", "whole", "tail", "doc_crc", "crcs"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").array)
            yield out

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, doc_tokens long, whole long, tail long, doc_crc long, crcs array<long>"))


def _numbered(rows: DataFrame, keys: list[str], amount, name: str, width: int) -> DataFrame:
    """`name`: the sum of `amount` over the rows of equal keys before this one.

    Groups are dealt out over salts; sums within a salt are windows, and the salts' own sums
    (a row for each key and salt) give each salt its base, so no group meets in one task."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(width)).cast("int"))
    rows = rows.withColumn("_amount", amount)
    sums = rows.groupBy(*keys, "_salt").agg(F.sum("_amount").alias("_sum"))
    order = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(order), F.lit(0))).drop("_sum")
    inside = (Window.partitionBy(*keys, "_salt").orderBy("doc_id", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_before", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .join(bases, [*keys, "_salt"])
            .withColumn(name, F.col("_before") + F.col("_base"))
            .drop("_salt", "_amount", "_before", "_base"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE,
         class_width: int = CLASS_WIDTH) -> DataFrame:
    """One row for each piece (see PIECES)."""
    spark = docs.sparkSession
    width = 4 * shuffle_width(spark)
    pieces = stored(token_pieces(docs, tokenizer, sequence)
                    .withColumn("row", F.monotonically_increasing_id()), "pieces")
    tails = pieces.filter("tail > 0").select(
        "row", "doc_id", "doc_tokens", "doc_crc", "tail", "whole",
        F.element_at("crcs", -1).alias("crc"),
        F.ceil(F.col("tail") / class_width).cast("int").alias("class"))

    # One row for each class: at most sequence / class_width of them.
    histogram = sorted(tails.groupBy("class").count().collect())
    classes = np.array([r["class"] for r in histogram], dtype=np.int64)
    demand = np.array([r["count"] for r in histogram], dtype=np.int64)
    patterns, times = (cutting_stock(classes, demand, sequence // class_width)
                       if len(classes) else (np.zeros((0, 0), int), np.zeros(0, int)))
    n_planned = int(times.sum())
    plan = spark.createDataFrame(
        allocations(classes, patterns, times) or [(-1, 0, 0, 1, 0, 0)],
        "class int, low long, high long, each long, slot long, sequence long")

    ranked = _numbered(tails, ["class"], F.lit(1), "rank", width)
    # The plan has a row for each class of each pattern: at most (classes)**2, so it may be broadcast.
    placed = stored(ranked.join(
        F.broadcast(plan), (ranked["class"] == plan["class"]) & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")), "left").drop(plan["class"]), "placed")
    turn = F.col("rank") - F.col("low")
    planned = placed.filter("low IS NOT NULL").select(
        "doc_id", (F.col("whole") * sequence).alias("start"), F.col("tail").alias("length"),
        F.col("crc").alias("ids_crc32"), "doc_tokens",
        (F.col("sequence") + F.floor(turn / F.col("each"))).alias("sequence_id"),
        (F.col("slot") + turn % F.col("each")).alias("place"))
    before = (Window.partitionBy("sequence_id").orderBy("place")
              .rowsBetween(Window.unboundedPreceding, -1))
    planned = planned.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    left_over, n_left = _left_over(docs, placed.filter("low IS NULL"), n_planned, tokenizer, sequence)
    whole = _numbered(pieces.filter("whole > 0").select("row", "doc_id", "doc_tokens", "whole", "crcs"),
                      [], F.col("whole"), "first", width)
    whole = (whole.select("doc_id", "doc_tokens", "first", F.posexplode(
        F.slice("crcs", F.lit(1), F.col("whole").cast("int"))).alias("k", "ids_crc32"))
        .select("doc_id", (F.col("k") * sequence).cast("long").alias("start"),
                F.lit(sequence).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                (F.col("first") + F.col("k") + n_planned + n_left).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset")))
    names = [c.split()[0] for c in PIECES.split(", ")]
    return planned.select(names).union(left_over.select(names)).union(whole.select(names))


def _left_over(docs: DataFrame, rows: DataFrame, first_sequence: int, tokenizer: str,
               sequence: int) -> tuple[DataFrame, int]:
    """The tails that no rounded pattern took, end to end, cut at the sequence boundaries.

    Their number is bounded by the patterns, not by the input, so one window and a broadcast of
    their ids are bounded too.  Their checksums need the ids: those few texts are encoded again."""
    line = (Window.orderBy(F.desc("tail"), "doc_id", "row")
            .rowsBetween(Window.unboundedPreceding, -1))
    laid = stored(rows.select("row", "doc_id", "doc_crc", "doc_tokens", "whole", "tail")
                  .withColumn("at", F.coalesce(F.sum("tail").over(line), F.lit(0))), "left_over")
    total = laid.agg(F.sum("tail")).first()[0] or 0

    def run(batches):
        encoder = memo_tokenizer(tokenizer, True)
        for pdf in batches:
            out = []
            ids_of = encoder.encode([t or "" for t in pdf["text"]])
            for ids, doc_id, want, n, whole, tail, at in zip(
                    ids_of, pdf["doc_id"], pdf["doc_crc"], pdf["doc_tokens"], pdf["whole"],
                    pdf["tail"], pdf["at"]):
                ids += END_ID
                if zlib.crc32(ids) != want:
                    continue  # another text under the same doc_id
                a, end = at, at + tail
                while a < end:
                    b = min(end, (a // sequence + 1) * sequence)
                    s = whole * sequence + a - at
                    out.append((doc_id, s, b - a, zlib.crc32(ids[4 * s:4 * (s + b - a)]), n,
                                first_sequence + a // sequence, a % sequence))
                    a = b
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    # Rows that repeat a doc_id and its text would each meet each entry: one text is enough.
    found = (docs.select(F.col("doc_id").cast("long").alias("text_id"), "text")
             .join(F.broadcast(laid), F.col("text_id").eqNullSafe(F.col("doc_id")))
             .groupBy("row", F.xxhash64("text").alias("h"))
             .agg(*[F.first(c).alias(c) for c in
                    ("doc_id", "doc_crc", "doc_tokens", "whole", "tail", "at", "text")])
             .select("doc_id", "doc_crc", "doc_tokens", "whole", "tail", "at", "text"))
    return found.mapInPandas(run, PIECES), -(-int(total) // sequence)
