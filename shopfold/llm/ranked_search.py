"""Ranked lexical search with a dual tree (operator 13).

Every item (query) is ranked against every document by an integer BM25 sum over the item's terms.
Items and documents are vectors over the items' terms: an item holds how often it has a term, a
document what one occurrence in the item would score.  Both are kept in hierarchies whose nodes hold
the maximum of every coordinate, so the product of two nodes' maxima bounds the score of each item
below the one with each document below the other.  A pair of nodes is left out, with all that lies
below, when its bound is under the weakest k-th score of the node's items; no such document can be
among the k best, so the results are exact.

Work on Spark: the documents are tokenised once and only the items' terms are kept, document counts
come from a grouped count, then every task walks its documents in batches, each with a tree of its
own, against the items' trees; k-th scores carry over from batch to batch, and start from those of a
first walk over one document in SEED_EVERY, which are lower bounds of the final ones.  A task returns
at most k rows an item; a window takes the final k.

What tasks get as a broadcast has a bound: the vocabulary up to VOCABULARY terms (a larger one is
joined with the documents' terms instead), and items in chunks of about CHUNK_TERMS terms, one walk
over the stored terms for each chunk.

Defined cases: a null text or one without a term has no terms and is neither counted nor found; an
item without a term that some document holds has no rows; every row of either table is an item or
document of its own, repeated ids included; a null doc_id comes last among equal scores; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfold.llm.common import NO_ID, bound_batches, id_in, id_out, stored

K = 10
#: Terms are runs of digits, letters and all that lies beyond ASCII; A-Z are lowered.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEPT else 0x20 for b in range(256)).lower()
VOCABULARY = 200_000
CHUNK_TERMS = 500_000
SEED_EVERY = 64
#: Fan-out of the trees, items of one tree, and numbers of one dense matrix.
FAN = 8
TREE_ITEMS = 512
CELLS = 2_000_000
#: Term entries of one batch of documents.
BATCH_TERMS = 400_000


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- counting -------------------------------------------------------------------

def _counted(table: DataFrame, key: str, known=None) -> DataFrame:
    """(row, key, n, words, tfs): number of terms and the distinct ones with their counts.  With a
    broadcast `known` (term -> id) only its terms are listed, by id."""
    kind = "long" if known is not None else "string"

    def run(batches):
        ids = None if known is None else known.value
        for pdf in batches:
            n, words, tfs = [], [], []
            for text in pdf["text"]:
                found = terms(text)
                n.append(len(found))
                counts = Counter(found)
                if ids is None:
                    words.append([w.decode("utf-8") for w in counts])
                    tfs.append(list(counts.values()))
                else:
                    mine = [(ids[w], c) for w, c in counts.items() if w in ids]
                    words.append([w for w, _ in mine])
                    tfs.append([c for _, c in mine])
            yield pd.DataFrame({"row": pdf["row"], key: pdf[key], "n": n, "words": words, "tfs": tfs})

    return (table.select(id_in(key), "text")
            .withColumn("row", F.monotonically_increasing_id()).select("row", key, "text")
            .mapInPandas(run, f"row long, {key} long, n long, words array<{kind}>, tfs array<long>"))


def _document_terms(docs: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """The stored (row, doc_id, n, words, tfs) of every document, words as ids of the vocabulary."""
    spark = docs.sparkSession
    if vocabulary.count() <= limit:
        known = spark.sparkContext.broadcast({r.term.encode(): r.id for r in vocabulary.collect()})
        return stored(_counted(docs, "doc_id", known), "document_terms")
    every = stored(_counted(docs, "doc_id"), "document_words")
    one = every.select("row", F.explode(F.arrays_zip("words", "tfs")).alias("w")).select(
        "row", F.col("w.words").alias("term"), F.col("w.tfs").alias("tf"))
    mine = one.join(vocabulary, "term").groupBy("row").agg(F.collect_list(F.struct("id", "tf")).alias("w"))
    none = F.array().cast("array<long>")
    return stored(every.select("row", "doc_id", "n").join(mine, "row", "left").select(
        "row", "doc_id", "n", F.coalesce(F.col("w.id"), none).alias("words"),
        F.coalesce(F.col("w.tf"), none).alias("tfs")), "document_terms")


# --- the trees --------------------------------------------------------------------

def _tree(leaves: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima, level 0 the vectors (padded with zeros to whole nodes), the last one a
    single node or few."""
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        pad = -len(below) % FAN
        if pad:
            below = levels[-1] = np.vstack([below, np.zeros((pad, below.shape[1]), dtype=below.dtype)])
        levels.append(below.reshape(-1, FAN, below.shape[1]).max(axis=1))
    return levels


def _alike(vectors: np.ndarray) -> np.ndarray:
    """An order that puts vectors with the same strongest coordinate together."""
    if not vectors.size:
        return np.arange(len(vectors))
    return np.lexsort((-vectors.max(axis=1), vectors.argmax(axis=1)))


class ItemTree:
    """Some items with their hierarchy and their k best documents so far."""

    def __init__(self, items: list[tuple], floors: dict[int, int], n_docs: int, n_terms: int, k: int):
        """items: (row, item_id, words, counts, dfs)."""
        self.k, self.n_docs, self.n_terms = k, n_docs, n_terms
        self.words = np.unique(np.concatenate([np.asarray(i[2], dtype=np.int64) for i in items]))
        df = np.zeros(len(self.words), dtype=np.int64)
        vectors = np.zeros((len(items), len(self.words)), dtype=np.int64)
        for at, (_, _, words, counts, dfs) in enumerate(items):
            col = np.searchsorted(self.words, words)
            vectors[at, col] = counts
            df[col] = dfs
        self.weights = np.array([weight(n_docs, int(d)) for d in df], dtype=np.int64)
        largest = 1_000_000 * int(self.weights.max()) * int(vectors.sum(axis=1).max())
        self.kind = np.float64 if largest < 1 << 53 else np.int64  # sums are exact
        order = _alike(vectors * self.weights)
        self.items = [items[i] for i in order]
        self.levels = _tree(vectors[order].astype(self.kind))
        n = len(self.levels[0])
        # A document counts if it beats (score, doc_id) of the k-th; the floor itself is enough.
        n = len(self.levels[0])
        self.kth = np.full(n, NO_ID, dtype=np.int64)  # padding: never reached
        self.kth_id = np.full(n, -NO_ID, dtype=np.int64)
        for i, item in enumerate(self.items):
            self.kth[i] = floors.get(item[0], 1) - 1
        self.found: list[list[tuple]] = [[] for _ in self.items]
        self._note()

    def _note(self):
        """The smallest k-th score below each node of each level; a score of zero never counts."""
        low = np.maximum(self.kth, 1)
        self.weakest = [low]
        for upper in self.levels[1:]:
            low = low.reshape(-1, FAN).min(axis=1)
            low = np.concatenate([low, np.full(len(upper) - len(low), NO_ID)])  # padding
            self.weakest.append(low)

    def impacts(self, ids: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, indptr: np.ndarray):
        """Dense document vectors: the score of one occurrence of each term in an item."""
        norm = np.array([25 + 75 * int(n) * self.n_docs // self.n_terms for n in lengths], dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
        mine = self.words[at] == ids
        row = np.repeat(np.arange(len(lengths)), np.diff(indptr))[mine]
        col, tf = at[mine], tfs[mine]
        out = np.zeros((len(lengths), len(self.words)), dtype=self.kind)
        out[row, col] = self.weights[col] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[row]))
        return out

    def walk(self, vectors: np.ndarray, doc_ids: np.ndarray) -> None:
        """Offer documents to the items, from the roots of both trees."""
        order = _alike(vectors)
        self._docs, self._doc_ids = _tree(vectors[order]), doc_ids[order]
        self._visit(len(self._docs) - 1, np.arange(len(self._docs[-1])),
                    len(self.levels) - 1, np.arange(len(self.levels[-1])))

    def _visit(self, doc_level, docs, item_level, items) -> None:
        """Pairs of sibling document nodes and item nodes, the most promising documents first."""
        left, right = self._docs[doc_level][docs], self.levels[item_level]
        few = len(items) * 4 <= len(right)
        bound = left @ right[items].T if few else (left @ right.T)[:, items]
        if not doc_level and not item_level:
            return self._offer(bound.astype(np.int64), self._doc_ids[docs], items)
        for at in np.argsort(-(bound - self.weakest[item_level][items]).max(axis=1), kind="stable"):
            reached = items[bound[at] >= self.weakest[item_level][items]]
            if not len(reached):
                continue
            if item_level:
                reached = (reached[:, None] * FAN + np.arange(FAN)).ravel()
            below = docs[at:at + 1]
            if doc_level:
                below = np.arange(docs[at] * FAN, (docs[at] + 1) * FAN)
                below = below if doc_level > 1 else below[below < len(self._doc_ids)]
            self._visit(max(0, doc_level - 1), below, max(0, item_level - 1), reached)

    def _offer(self, scores, doc_ids, items) -> None:
        least, ids = self.kth[items], self.kth_id[items]
        better = (scores > least) | ((scores == least) & (doc_ids[:, None] < ids))
        columns = np.nonzero(better.any(axis=0))[0]
        for at in columns:
            i = items[at]
            docs = np.nonzero(better[:, at])[0]
            # Scores fall, ids rise.
            best = sorted(self.found[i] + [(-int(scores[d, at]), int(doc_ids[d])) for d in docs])[:self.k]
            self.found[i] = best
            if len(best) == self.k:
                self.kth[i], self.kth_id[i] = -best[-1][0], best[-1][1]
        if len(columns):
            self._note()

    def rows(self):
        for item, best in zip(self.items, self.found):
            for score, doc_id in best:
                yield item[0], item[1], doc_id, -score


def item_trees(items, floors, n_docs, n_terms, k) -> list[ItemTree]:
    """Trees of at most TREE_ITEMS items whose dense vectors have about CELLS numbers at most."""
    trees, part, words = [], [], set()
    for item in sorted(items, key=lambda i: (sorted(i[2])[:1], i[0])):
        more = words.union(item[2])
        if part and (len(part) == TREE_ITEMS or (len(part) + 1) * len(more) > CELLS):
            trees.append(ItemTree(part, floors, n_docs, n_terms, k))
            part, more = [], set(item[2])
        part, words = [*part, item], more
    return [*trees, ItemTree(part, floors, n_docs, n_terms, k)] if part else trees


def _walk(docs: DataFrame, items, floors, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_row, item_id, doc_id, score): at most k rows an item from each task."""
    shared = docs.sparkSession.sparkContext.broadcast((items, floors))

    def run(batches):
        trees = item_trees(*shared.value, n_docs, n_terms, k)
        for pdf in batches:
            sizes = pdf["words"].map(len).to_numpy()
            start = 0
            while start < len(pdf):
                end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), BATCH_TERMS)))
                part = pdf.iloc[start:end]
                indptr = np.concatenate([[0], np.cumsum(sizes[start:end])])
                ids, tfs = np.concatenate(part["words"].to_numpy()), np.concatenate(part["tfs"].to_numpy())
                doc_ids, lengths = part["doc_id"].to_numpy(), part["n"].to_numpy()
                for tree in trees:
                    step = max(FAN * FAN, CELLS // len(tree.words))
                    for a in range(0, len(part), step):
                        b = min(a + step, len(part))
                        places = slice(indptr[a], indptr[b])
                        tree.walk(tree.impacts(ids[places], tfs[places], lengths[a:b], indptr[a:b + 1] - indptr[a]),
                                  doc_ids[a:b])
                start = end
        found = [row for tree in trees for row in tree.rows()]
        yield pd.DataFrame(found, columns=["item_row", "item_id", "doc_id", "score"], dtype="int64")

    return docs.mapInPandas(run, "item_row long, item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, vocabulary_limit: int = VOCABULARY,
                  chunk_terms: int = CHUNK_TERMS, seed_every: int = SEED_EVERY) -> DataFrame:
    """item_row, item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    bound_batches(spark)
    asked = stored(_counted(items, "item_id"), "item_words")
    vocabulary = stored(asked.select(F.explode("words").alias("term")).distinct()
                        .withColumn("id", F.monotonically_increasing_id()), "item_vocabulary")
    counted = _document_terms(docs, vocabulary, vocabulary_limit)
    total = counted.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    schema = "item_row long, item_id long, doc_id long, score long"
    held = counted.select(F.explode("words").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    linked = stored(
        asked.select(F.col("row").alias("item_row"), "item_id", F.explode(F.arrays_zip("words", "tfs")).alias("w"))
        .select("item_row", "item_id", F.col("w.words").alias("term"), F.col("w.tfs").alias("tf"))
        .join(vocabulary, "term").join(held, "id").groupBy("item_row", "item_id")
        .agg(F.collect_list(F.struct("id", "tf", "df")).alias("w")), "linked_items")
    n_chunks = -(-(linked.agg(F.sum(F.size("w"))).first()[0] or 0) // chunk_terms)
    holding = counted.filter(F.size("words") > 0)
    found = spark.createDataFrame([], schema)
    for chunk in range(n_chunks):
        part = [(r.item_row, r.item_id, [w.id for w in r.w], [w.tf for w in r.w], [w.df for w in r.w])
                for r in linked.filter(F.pmod(F.xxhash64("item_row"), F.lit(n_chunks)) == chunk).collect()]
        if not part:
            continue
        seeds = holding.filter(F.pmod(F.xxhash64("row"), F.lit(seed_every)) == 0)
        first = _walk(seeds, part, {}, total.docs, total.terms, k)
        by_score = Window.partitionBy("item_row").orderBy(F.col("score").desc())
        floors = {r.item_row: r.score for r in first.withColumn("at", F.row_number().over(by_score))
                  .filter(F.col("at") == k).collect()}
        found = found.unionAll(stored(_walk(holding, part, floors, total.docs, total.terms, k), "ranked_chunk"))
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_row", id_out("item_id"), "rank", id_out("doc_id"), "score"))


_TERMS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE_SQL = f"""
with d as materialized (select row_number() over () dr, doc_id, {_TERMS} ts from documents where text is not null),
i as materialized (select row_number() over () ir, item_id, {_TERMS} ts from benchmark where text is not null),
g as (select count(*) nn, cast(sum(len(ts)) as bigint) ll from d where len(ts) > 0),
tf as materialized (select dr, t, count(*) tf from (select dr, unnest(ts) t from d) group by all),
w as materialized (
  select t, cast(floor(1000 * ln(cast(2 * any_value(nn) + 2 as double) / (2 * count(*) + 1))) as bigint) w
  from tf, g group by t),
m as materialized (select dr, doc_id, 25 + (75 * len(ts) * nn) // ll m from d, g where len(ts) > 0),
q as materialized (select ir, item_id, t, count(*) c from (select ir, item_id, unnest(ts) t from i) group by all),
s as (
  select ir, item_id, dr, doc_id,
         cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) score
  from q join w using (t) join tf using (t) join m using (dr) group by all),
ranked as (
  select *, cast(row_number() over (partition by ir order by score desc, doc_id nulls last) as integer) rank
  from s where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {K}
"""
