"""Centroid clustering with a Walsh-Hadamard progressive search (operator 11).

Vectors and centroids are integers.  Their Walsh-Hadamard transform is exact in integers and keeps
squared distances up to the factor of the vector length, so the squared coefficient differences,
added from coarse (few sign changes) to fine, bound the distance from below at every step.  After
each step the centroid with the least sum so far is measured in full; centroids whose sum already
exceeds the best full distance are strictly worse and go.  The rest end with all coefficients, so
distances and ties (smaller number first) are exact.

Each round is one Spark job over the stored coefficients; a task sends one row a cluster with the
count and the coefficient sums, and the driver gets at most clusters x length sums.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component
take no part; a null vec_id is clustered but never chosen as a start; rows that repeat a vec_id
are vectors of their own (equal hashes start in component order); fewer vectors than clusters give
as many clusters as vectors; an empty table gives no rows; further columns are ignored.  Distances
that don't fit a long raise OverflowError.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import NO_ID, bound_batches, id_in, id_out, stored

CLUSTERS = 40
ROUNDS = 5
LENGTH = 64
SCALE = 256
#: Coefficients added before each elimination.
STEPS = (4, 4, 8, 16, 32)
#: Below this, sums of squared coefficient differences of 64 components fit 64-bit integers.
SMALL = 1 << 27


def walsh(length: int) -> np.ndarray:
    """The Hadamard matrix (length a power of two), rows by rising number of sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < length:
        h = np.block([[h, h], [h, -h]])
    if len(h) != length:
        raise ValueError("the vector length must be a power of two")
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def transformed(vectors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    if len(vectors) and max(-int(vectors.min()), int(vectors.max())) >= 1 << 62 - len(matrix).bit_length():
        raise OverflowError("squared distances of such vectors do not fit a long")
    return vectors @ matrix.T


def nearest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of y (smallest number of equals) for each row of x, and the squared
    distance times the length; both are coefficients."""
    n, k = len(x), len(y)
    if n and max(np.abs(x).max(), np.abs(y).max()) >= SMALL:
        x, y = x.astype(object), y.astype(object)
    done = np.zeros((n, k), dtype=x.dtype)
    alive = np.ones((n, k), dtype=bool)
    never = (1 << 63) - 1 if x.dtype != object else 1 << 200
    best = np.full(n, never, dtype=x.dtype)
    at = 0
    steps = [*STEPS, x.shape[1]] if n else []
    for step in steps:
        to = min(at + step, x.shape[1])
        if to == at:
            break
        rows, cols = np.nonzero(alive)
        for a in range(0, len(rows), 50_000):
            r, c = rows[a:a + 50_000], cols[a:a + 50_000]
            gap = x[r, at:to] - y[c, at:to]
            done[r, c] += (gap * gap).sum(axis=1)
        at = to
        if at < x.shape[1]:
            lead = np.where(alive, done, never).argmin(axis=1)
            gap = x - y[lead]
            best = np.minimum(best, (gap * gap).sum(axis=1))
            alive &= done <= best[:, None]
    done = np.where(alive, done, never)
    cluster = done.argmin(axis=1)
    return cluster, done[np.arange(n), cluster]


def whole_components(embedding: Column) -> Column:
    """True for arrays without null or non-finite components."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(embedding: Column, scale: int = SCALE) -> Column:
    return F.transform(embedding, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))


def _coefficients(vectors: DataFrame, length: int) -> DataFrame:
    """(vec_id, x): the stored coefficients of the integer vectors."""
    matrix = walsh(length)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = transformed(np.stack(pdf["v"].to_numpy()), matrix)
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "x": list(x)})

    return stored(vectors.select("vec_id", "v").mapInPandas(run, "vec_id long, x array<long>"), "coefficients")


def _moved(coefficients: DataFrame, centroids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """One round: every centroid at the floor of the mean of its vectors; empty ones stay."""
    y = transformed(centroids, matrix)
    k, length = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, length), dtype=object), np.zeros(k, dtype=np.int64)
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_numpy())
            cluster, _ = nearest(x, y)
            for c in np.unique(cluster):
                mine = x[cluster == c]
                small = np.abs(mine).max() < 1 << 40
                sums[c] += (mine if small else mine.astype(object)).sum(axis=0).astype(object)
                counts[c] += len(mine)
        used = np.nonzero(counts)[0]
        if len(used):
            yield pd.DataFrame({"cluster": used.astype(np.int32), "n": counts[used],
                                "sums": [[str(s) for s in sums[c]] for c in used]})

    parts = coefficients.mapInPandas(run, "cluster int, n long, sums array<string>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    moved = centroids.astype(object)
    sums: dict[int, list[int]] = {}
    counts = {}
    for row in totals:
        sums.setdefault(row.cluster, [0] * length)[row.at] = int(row.total)
        counts[row.cluster] = int(row.n)
    for c, total in sums.items():  # the transform of the transform is the vector times the length
        back = np.array(total, dtype=object) @ matrix.astype(object)
        moved[c] = back // length // counts[c]
    return moved.astype(np.int64)


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    length: int = LENGTH, salt: str = "2:", scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector, and the final centroids (bounded: clusters x
    length integers)."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kept = vectors.select(id_in("vec_id"), F.col("embedding")).filter(
        (F.size("embedding") == length) & whole_components(F.col("embedding"))).select(
        "vec_id", integers(F.col("embedding"), scale).alias("v"))
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    starts = kept.filter(F.col("vec_id") < NO_ID).orderBy(order, "v").limit(clusters).collect()
    schema = "vec_id long, cluster int, distance long"
    if not starts:
        return spark.createDataFrame([], schema), np.zeros((0, length), dtype=np.int64)
    matrix = walsh(length)
    centroids = np.array([row.v for row in starts], dtype=np.int64)
    coefficients = _coefficients(kept, length)
    for _ in range(rounds):
        centroids = _moved(coefficients, centroids, matrix)
    y = transformed(centroids, matrix)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                cluster, far = nearest(np.stack(pdf["x"].to_numpy()), y)
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "cluster": cluster.astype(np.int32),
                                    "distance": (far // length).astype(np.int64)})

    return stored(coefficients.mapInPandas(run, schema).withColumn("vec_id", id_out("vec_id")), "clustered"), centroids


def clustering_report(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    assigned, centroids = cluster_vectors(vectors, clusters, rounds)
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, sums[c], sum(sums.values()),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(sums)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH) -> str:
    """The same rows in DuckDB, by plain distances."""
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    sql = [f"""with kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v,
         row_number() over () as row_no
  from embeddings where len(embedding) = {length}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (
  select cast(row_number() over (order by sha256('2:' || vec_id), v) - 1 as integer) cluster, v c
  from kept where vec_id is not null qualify row_number() over (order by sha256('2:' || vec_id), v) <= {clusters})"""]
    for r in range(rounds + 1):
        sql.append(f"""a{r} as materialized (
  select row_no, any_value(vec_id) vec_id, any_value(v) v,
         arg_min(cluster, (d, cluster)) cluster, min(d) distance
  from (select row_no, vec_id, v, cluster, cast({far} as bigint) d from kept, c{r}) group by row_no)""")
        if r < rounds:
            sql.append(f"""c{r + 1} as materialized (
  select cluster, coalesce(m.c, old.c) c from c{r} old left join (
    select cluster, list(f order by place) c from (
      select cluster, place, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) f
      from (select cluster, unnest(v) x, generate_subscripts(v, 1) place from a{r}) group by cluster, place)
    group by cluster) m using (cluster))""")
    sql.append(f"""t as (select cluster, sum(distance) s from a{rounds} group by cluster)
select a.vec_id, a.cluster, a.distance, cast(t.s as bigint) cluster_inertia,
       cast((select sum(s) from t) as bigint) inertia, sha256(array_to_string(c.c, ',')) centroid_sha256
from a{rounds} a join t using (cluster) join c{rounds} c using (cluster)""")
    return ",\n".join(sql[:-1]) + ",\n" + sql[-1]
