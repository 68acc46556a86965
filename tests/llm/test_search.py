"""Clustering, exact top-k and ranked lexical search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import clash, make_docs

from shopfold.llm import centroids, ranked_search, topk_search

VECTORS = "vec_id long, embedding array<double>, label int"


def table(spark, rows):
    return clash(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3))


def whole(v, length=None):
    return v is not None and (length is None or len(v) == length) and all(
        x is not None and math.isfinite(x) for x in v)


def ints(v):
    return [math.floor(256 * x) for x in v]


@pytest.fixture(scope="module")
def vectors():
    r = random.Random(5)
    rows = [(i, [r.gauss(0, .1) for _ in range(64)]) for i in range(260)]
    copies = rows[17][1]
    rows += [(300 + i, list(copies)) for i in range(40)] + [(50, list(copies)), (50, rows[3][1]), (None, rows[4][1])]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [math.nan] + [0.0] * 63), (404, [math.inf] + [0.0] * 63),
             (405, [None] + [0.0] * 63), (450, [0.0] * 64), (500, [1.0, -2.0]), (501, [3.0, 1.0])]
    return rows


# --- operator 11 -----------------------------------------------------------------

def brute_clusters(rows, k, rounds):
    kept = [(i, ints(v)) for i, v in rows if whole(v, 64)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c
                   for n, c in enumerate(centres)]
    found = [(i, near(v)) for i, v in kept]
    inertia = {}
    for _, (d, n) in found:
        inertia[n] = inertia.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, (d, n) in found), key=str)


@pytest.mark.parametrize("k,rounds", [(40, 2), (7, 5)])
def test_clusters_equal_plain_distances(spark, vectors, k, rounds):
    got = centroids.clustering_report(table(spark, vectors), k, rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(vectors, k, rounds)


def test_fewer_vectors_than_clusters_and_none(spark, vectors):
    few = [(9, [0.5] * 64), (9, [0.5] * 64), (8, [-0.5] * 64)]
    got = sorted((tuple(r) for r in centroids.clustering_report(table(spark, few)).collect()), key=str)
    assert got == brute_clusters(few, 40, 5)
    for rows in ([], [(1, None)]):
        empty = centroids.clustering_report(table(spark, rows))
        assert empty.count() == 0 and len(empty.columns) == 6


def test_progressive_search_is_exact_for_any_size_of_numbers():
    rng = np.random.default_rng(1)
    matrix = centroids.walsh(64)
    assert (matrix @ matrix.T == 64 * np.eye(64)).all()
    for trial in range(24):
        top = (3, 200, 1 << 22, 1 << 40)[trial % 4]
        v, c = rng.integers(-top, top + 1, (30, 64)), rng.integers(-top, top + 1, (40, 64))
        c[7], v[0] = c[3], c[3]
        cluster, far = centroids.nearest(centroids.transformed(v, matrix), centroids.transformed(c, matrix))
        plain = ((v[:, None].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
        assert (cluster == plain.argmin(axis=1)).all()
        assert [int(f) // 64 for f in far] == [plain[i, k] for i, k in enumerate(cluster)]
    with pytest.raises(OverflowError):
        centroids.transformed(np.array([[1 << 60] * 64]), matrix)


# --- operator 12 -----------------------------------------------------------------

def brute_top(rows, every, k):
    kept = [(n, i, ints(v)) for n, (i, v) in enumerate(rows) if whole(v)]
    out = []
    for n, i, q in kept:
        if i is None or i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j) for m, j, v in kept
                        if m != n and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,queries", [(32_768, 2_048), (40, 3)])
def test_top_k_equals_brute_force(spark, vectors, block, queries):
    got = topk_search.exact_top_k(table(spark, vectors), F.col("vec_id") % 10 == 0, block=block, queries=queries)
    assert got.columns == ["query_row", "query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.drop("query_row").collect()), key=str) == brute_top(vectors, 10, 5)


def test_top_k_of_no_rows(spark):
    for rows in ([], [(1, [1.0])], [(50, [1.0])]):
        assert topk_search.exact_top_k(table(spark, rows), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_search_of_a_block():
    rng = np.random.default_rng(2)
    for trial in range(160):
        n, d, m = int(rng.integers(1, 700)), int(rng.integers(1, 9)), int(rng.integers(1, 12))
        top = (3, 200, 1 << 25, 1 << 29)[trial % 4]
        v = rng.integers(-top, top + 1, (n, d))
        if trial % 3 == 0:  # few large components: the lists are left early
            v = v ** 3 // (top * top)
        own = rng.choice(np.append(np.arange(n), -1), m)
        q = np.where(own[:, None] >= 0, v[own], rng.integers(-top, top + 1, (m, d)))
        scores = q.astype(object) @ v.T.astype(object)
        want, floor = [], np.full(m, topk_search.UNKNOWN)
        for i in range(m):
            best = sorted((j for j in range(n) if j != own[i]), key=lambda j: (-scores[i, j], j))[:5]
            if trial % 2 and len(best) == 5 and rng.random() < .5:
                floor[i] = scores[i, best[-1]]
            want += [(i, j, scores[i, j]) for j in best]
        got = zip(*(p.tolist() for p in topk_search.block_top_k(v, q, own, floor)))
        assert sorted(got, key=lambda t: (t[0], -t[2], t[1])) == want


# --- operator 13 -----------------------------------------------------------------

def brute_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranks(docs, items, k):
    docs = [(i, brute_terms(t)) for i, t in docs]
    docs = [(i, t, Counter(t)) for i, t in docs if t]
    n_docs, n_terms = len(docs), sum(len(t) for _, t, _ in docs)
    df = {}
    for _, _, counts in docs:
        for w in counts:
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        words, ranked = brute_terms(text), []
        for i, t, counts in docs:
            m = 100 - 75 + (75 * len(t) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (10 ** 9 * counts[w] // (1000 * counts[w] + 8 * m))
                        for w in words if w in counts)
            if score > 0:
                ranked.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def searched(prose):
    docs = [(i, prose(i, 5 + 7 * i % 90, 120)) for i in range(300)]
    docs += [(1000 + i, prose(7, 40, 120)) for i in range(60)]  # copies: equal scores
    docs += [(7, prose(8, 30, 120)), (None, prose(7, 40, 120)), (None, prose(7, 40, 120)), (400, None), (401, ""),
             (402, " .,\n\x00 "), (403, prose(9, 30_000, 300)), (404, "ÄÖ★ Äö KelvinK ABC_abc-Abc 7up")]
    items = [(i, prose(5000 + i, 4 + i % 40, 120)) for i in range(70)]
    items += [(900, prose(7, 40, 120)), (901, prose(7, 40, 120).upper()), (900, prose(8, 3, 120)), (902, None),
              (903, ""), (904, "never seen"), (905, "ÄÖ★ abc ABC 7UP kelvinK"), (None, prose(7, 9, 120)),
              (906, prose(11, 9_000, 300))]
    return docs, items


def ranks(spark, docs, items, **options):
    benchmark = clash(spark.createDataFrame(items, "item_id long, text string").repartition(2))
    found = ranked_search.ranked_search(clash(make_docs(spark, docs)), benchmark, **options)
    assert found.columns == ["item_row", "item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.drop("item_row").collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"vocabulary_limit": 10, "chunk_terms": 3000, "seed_every": 3}])
def test_ranks_equal_brute_force(spark, searched, options):
    assert ranks(spark, *searched, **options) == brute_ranks(*searched, ranked_search.K)


def test_ranks_of_empty_tables(spark, searched):
    docs, items = searched
    assert ranks(spark, [], items) == [] and ranks(spark, docs[:5], []) == []
    assert ranks(spark, [(1, None), (2, "..")], items) == []


def test_dual_tree_of_small_nodes_and_large_numbers():
    """Deep trees over many items, with weights for which 64-bit floats are not exact, too."""
    r = random.Random(3)
    for repeats in (1, 10 ** 6):
        items = [(row, row, sorted(r.sample(range(60), 5)), [repeats * r.randint(1, 3) for _ in range(5)], [4] * 5)
                 for row in range(150)]
        tree, = ranked_search.item_trees(items, {0: 1}, 1000, 9000, 3)
        assert tree.kind is (np.float64 if repeats == 1 else np.int64)
        want = {}
        for batch in range(4):
            n = 333
            lists = [sorted(r.sample(range(60), 6)) for _ in range(n)]
            tfs = np.array([r.randint(1, 4) for _ in range(6 * n)])
            vectors = tree.impacts(np.concatenate(lists), tfs, np.full(n, 9), np.arange(0, 6 * n + 1, 6))
            ids = np.array(r.sample(range(10 ** 6), n))
            for item, vector in zip(tree.items, tree.levels[0]):
                scores = vectors.astype(np.int64) @ vector.astype(np.int64)
                want.setdefault(item[0], []).extend((-int(s), int(d)) for s, d in zip(scores, ids) if s > 0)
            tree.walk(vectors, ids)
        got = {}
        for row, _, doc_id, score in tree.rows():
            got.setdefault(row, []).append((-score, doc_id))
        assert got == {row: sorted(best)[:3] for row, best in want.items()}
