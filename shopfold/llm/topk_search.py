"""Exact top-k inner-product search with Fagin's threshold algorithm (operator 12).

The vectors are dealt into blocks, and in a block every dimension has its list of vectors sorted
by that component.  For a query the lists are read from the end that its component's sign favours;
after t entries of each list no unread vector can score more than the query times the components
at depth t.  The k-th best score known so far gives the depth where that bound falls below it, and
the vectors read up to there are scored; every other vector cannot be among the k best.  Where the
lists would have to be read so deep that they name most of the block, the whole block is scored at
once instead of entry by entry, which can't miss one either.

One block is searched first: each query's k-th score there is a floor for all other blocks.  Queries
meet blocks as groups of at most about BLOCK vectors and QUERIES queries by equi-join on the block
numbers, so memory is bounded and nothing is broadcast.  Scores are exact integers: the number type
of the products is chosen by the largest possible sum.

Defined cases: vectors that are null or hold a null or non-finite component take no part; vectors
are compared with those of their own length only; a null vec_id is a candidate that comes last among
equal scores, never a query; rows that repeat a vec_id are rows of their own, and a query is left out
of its own candidates as a row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfold.llm.centroids import SCALE, integers, whole_components
from shopfold.llm.common import NO_ID, bound_batches, id_in, id_out, stored

K = 5
QUERY_EVERY = 50
#: Vectors of a block and queries of a group (about: they are dealt by hash).
BLOCK = 32_768
QUERIES = 2_048
#: Entries first read from each list while nothing is known of the k-th score.
FIRST_DEPTH = 8
#: Scores held at a time.
SCORES = 4_000_000
#: In place of a k-th score: fewer than k are known.
UNKNOWN = -(1 << 63)


def _exact(largest: int):
    """A number type that holds sums up to `largest` exactly."""
    for bits, kind in ((24, np.float32), (53, np.float64), (63, np.int64)):
        if largest < 1 << bits:
            return kind
    return object


def _largest(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def _best(rows, cols, scores, k):
    """The k best of each row by score, then column."""
    order = np.lexsort((cols, -scores, rows)) if scores.dtype != object else np.array(
        sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], cols[i])), dtype=np.int64)
    rows, cols, scores = rows[order], cols[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = rank < k
    return rows[keep], cols[keep], scores[keep]


def block_top_k(v: np.ndarray, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int = K):
    """(query, vector, score) of the k best vectors of a block that reach the query's floor.

    `v` (vectors by rising tie order) and `q` are integers; own[i] is the place of query i among the
    vectors or -1; floor[i] is a score that k other vectors reach, or UNKNOWN.
    """
    n, d = v.shape
    kind = _exact(d * _largest(v) * _largest(q))
    v, q = v.astype(kind), q.astype(kind)
    lists = np.argsort(v, axis=0, kind="stable")          # ascending in every dimension
    values = np.take_along_axis(v, lists, axis=0)
    depths = np.unique(np.minimum([0, *(FIRST_DEPTH << s for s in range(40) if FIRST_DEPTH << s < n), n - 1], n - 1))
    low, high = values[depths].T, values[n - 1 - depths].T  # components not yet passed at each depth
    kth = floor.astype(np.int64)
    out = []

    def planned(rows):
        """Depth at which each query's bound falls below its k-th score (n: never)."""
        bound = np.maximum(q[rows], 0) @ high + np.minimum(q[rows], 0) @ low
        below = (bound < kth[rows][:, None]) & (kth[rows] > UNKNOWN)[:, None]
        return np.where(below.any(axis=1), depths[below.argmax(axis=1)], n)

    def read(row, depth):
        """Score the vectors named in the first `depth` entries of the query's lists."""
        up = q[row] > 0
        seen = np.zeros(n, dtype=bool)
        seen[lists[n - depth:, up]] = True
        seen[lists[:depth, ~up & (q[row] < 0)]] = True
        if own[row] >= 0:
            seen[own[row]] = False
        cols = np.nonzero(seen)[0]
        scores = v[cols] @ q[row]
        return _best(np.full(len(cols), row), cols, scores, k)

    rows = np.arange(len(q))
    if d and n > 4 * d * FIRST_DEPTH:
        for row in rows[kth == UNKNOWN]:
            scores = read(row, FIRST_DEPTH)[2]
            if len(scores) >= k:
                kth[row] = scores[-1]
        depth = planned(rows) if len(rows) else rows
        few = depth * d * 4 <= n
        for row in rows[few & (depth > 0)]:
            found = read(row, depth[row])
            keep = found[2] >= kth[row]
            out.append(tuple(part[keep] for part in found))
        rows = rows[~few]
    step = max(1, SCORES // max(1, n))
    for a in range(0, len(rows), step):
        part = rows[a:a + step]
        scores = q[part] @ v.T
        least = kth[part]
        wide = least == UNKNOWN
        if wide.any() and n > k + 1 and kind is not object:  # k + 1: the query itself may be among them
            least = least.copy()
            least[wide] = np.partition(scores[wide], n - k - 1, axis=1)[:, n - k - 1].astype(np.int64)
        r, c = np.nonzero(scores >= least.astype(kind)[:, None])
        hit = scores[r, c]
        keep = c != own[part][r]
        out.append(_best(part[r[keep]], c[keep], hit[keep], k))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, cols, scores = (np.concatenate(p) for p in zip(*out))
    return rows, cols, np.array([int(s) for s in scores], dtype=np.int64)


def _searched(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score): the k best of each group for each of its queries.
    Vectors: dim, block, part, row, vec_id, v; queries: q_dim, q_block, q_part, q_row, q_id, q, floor."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        left = left.sort_values("vec_id", kind="stable")
        rows = left["row"].to_numpy()
        by_row = np.argsort(rows)
        asking = right["q_row"].to_numpy()
        place = by_row[np.minimum(np.searchsorted(rows, asking, sorter=by_row), len(rows) - 1)]
        own = np.where(rows[place] == asking, place, -1)
        q, c, s = block_top_k(np.stack(left["v"].to_numpy()), np.stack(right["q"].to_numpy()), own,
                              right["floor"].to_numpy(), k)
        return pd.DataFrame({"query_row": asking[q], "query_id": right["q_id"].to_numpy()[q],
                             "vec_id": left["vec_id"].to_numpy()[c], "score": s})

    return vectors.groupBy("dim", "block", "part").cogroup(queries.groupBy("q_dim", "q_block", "q_part")).applyInPandas(
        run, "query_row long, query_id long, vec_id long, score long")


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK,
                queries: int = QUERIES) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: the k best other rows for every row that `is_query`
    selects (a condition on vec_id)."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kept = stored(
        vectors.select(id_in("vec_id"), "embedding")
        .filter(whole_components(F.col("embedding")))
        .select("vec_id", integers(F.col("embedding")).alias("v"), F.size("embedding").alias("dim"))
        .withColumn("row", F.monotonically_increasing_id()), "topk_vectors")
    asked = kept.filter(F.col("vec_id") < NO_ID).filter(is_query)
    n_blocks = max(1, -(-kept.count() // block))
    n_parts = max(1, -(-asked.count() // queries))
    deal = F.xxhash64("row")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cards = kept.withColumn("block", F.pmod(deal, F.lit(n_blocks)).cast("int"))
    asks = asked.select(F.col("row").alias("q_row"), F.col("vec_id").alias("q_id"), F.col("v").alias("q"),
                        F.col("dim").alias("q_dim"), F.pmod(deal, F.lit(n_parts)).cast("int").alias("q_part"))
    first = stored(_searched(
        cards.filter("block = 0").withColumn("part", numbers(n_parts)),
        asks.withColumn("q_block", F.lit(0)).withColumn("floor", F.lit(UNKNOWN)), k), "topk_first")
    found = first
    if n_blocks > 1:
        floors = first.groupBy(F.col("query_row").alias("q_row")).agg(
            F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        rest = (asks.join(floors, "q_row", "left").withColumn("floor", F.coalesce("floor", F.lit(UNKNOWN)))
                .withColumn("q_block", F.explode(F.sequence(F.lit(1), F.lit(n_blocks - 1)))))
        found = first.unionByName(_searched(
            cards.filter("block > 0").withColumn("part", numbers(n_parts)), rest, k))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", id_out("vec_id"), "score"))


ORACLE_SQL = f"""
with kept as materialized (
  select vec_id, row_number() over () as row_no,
         list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.row_no, q.vec_id query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) score
  from kept q join kept c on c.row_no <> q.row_no and len(c.v) = len(q.v) where q.vec_id % {QUERY_EVERY} = 0),
ranked as (
  select *, cast(row_number() over (partition by row_no order by score desc, vec_id nulls last) as integer) rank
  from pairs)
select query_id, rank, vec_id, score from ranked where rank <= {K}
"""
