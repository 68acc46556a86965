"""Language identification by multilingual mixture inference (operator 10).

Hashed 4-byte grams give each language a distribution, learned from a bounded sample of labelled
rows.  A text is cut into stretches of grams; expectation-maximisation estimates the share of
each language in it.  Nested language sets (by share) are refitted, and the set with the best
penalised likelihood is selected; the answer is its language of the largest share.

Defined cases: a null text, or one without a letter, is `und` with score 0; shorter texts than a
gram are padded with spaces; with nothing to learn from, every document is `und`; ties go to the
first language in order; rows are answered one by one, so repeated rows get equal answers;
further columns are ignored.  Texts shorter than a stretch have null evidence.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopfold.llm.common import slices

#: At most so many labelled documents of each language are learned from.
SAMPLE_PER_LANGUAGE = 1500
#: Parts of a language in which ids are ranked, and tasks that count the sample's grams.
RANK_PARTS = 64
COUNT_PARTS = 8
#: Of one text, a stretch of so many grams belongs to one language.
STRETCH = 48
TABLE_BITS = 16
#: Share of the uniform distribution mixed into each language (unseen grams say nothing).
SMOOTHING = 0.02
#: Log-likelihood that one more language has to gain, per logarithm of the stretches.
PENALTY = 3.0
ROUNDS = 8
UNKNOWN = "und"


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def grams(text: str) -> np.ndarray:
    """Table index of each 4-byte gram of the lower-cased text with a space at either end."""
    raw = np.frombuffer((" " + text.lower() + "   ").encode("utf-8", "replace"), dtype=np.uint8)
    x = raw.astype(np.uint32)
    word = x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24
    return (word * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)


def train(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Log-probabilities of the grams by language, from `docs` (doc_id, text, lang).

    The sample is fixed by a hash of the id.  Ids are ranked in RANK_PARTS parts of each language
    first, so that the ranking of a frequent language is no single task; an id counts once, with
    the text of the smallest hash, however many rows repeat it.  Grams are counted where the
    texts lie, and one array a part and language meets the others'."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    ids = rows.select("doc_id", "lang").distinct().withColumn("at", F.xxhash64("doc_id"))
    for keys in (["lang", F.pmod("at", F.lit(RANK_PARTS))], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("at", "doc_id")
        ids = ids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample_per_language)
    # At most sample_per_language ids for each language: bounded, so it may be broadcast.
    chosen = F.broadcast(ids.select(F.col("doc_id").alias("id"), F.col("lang").alias("of")))
    # A null id is an id, too.
    sample = (rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("of")))
              .groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def count(batches):
        totals = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                total = totals.setdefault(lang, np.zeros(1 << TABLE_BITS, dtype=np.int64))
                total += np.bincount(grams(text), minlength=1 << TABLE_BITS)
        if totals:
            yield pd.DataFrame({"lang": list(totals), "total": [t.tobytes() for t in totals.values()]})

    def add(pdf):
        total = sum(np.frombuffer(t, dtype=np.int64) for t in pdf["total"])
        p = (1 - SMOOTHING) * total / max(1.0, total.sum()) + SMOOTHING / len(total)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]],
                             "logp": [np.log(p).astype(np.float32).tobytes()]})

    got = (sample.repartition(COUNT_PARTS).select("lang", "text").mapInPandas(count, "lang string, total binary")
           .groupBy("lang").applyInPandas(add, "lang string, logp binary").collect())
    return {r["lang"]: np.frombuffer(r["logp"], dtype=np.float32)
            for r in sorted(got, key=lambda r: r["lang"])}


def _em(like: np.ndarray, allowed: np.ndarray, doc: np.ndarray, starts: np.ndarray,
        counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each document, and its log-likelihood."""
    shares = np.where(allowed, np.maximum(shares, 1e-3), 0.0)
    shares /= shares.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = like * shares[doc]
        joint /= joint.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(joint, starts, axis=0) / counts[:, None]
    fit = np.add.reduceat(np.log((like * shares[doc]).sum(axis=1)), starts)
    return shares, fit


def infer(texts: list[str], tables: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the selected languages' shares (n x languages), the set's size, and its
    evidence: mean log-likelihood of a gram over the uniform distribution (NaN for texts shorter
    than a stretch, which show too little)."""
    index = [grams(t) for t in texts]
    lengths = np.array([len(g) for g in index])
    logs = tables[np.concatenate(index)]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    counts = (lengths + STRETCH - 1) // STRETCH
    doc = np.repeat(np.arange(len(texts)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    within = np.arange(len(doc)) - starts[doc]
    score = np.add.reduceat(logs, first[doc] + within * STRETCH, axis=0).astype(np.float64)
    peak = score.max(axis=1)
    score -= peak[:, None]
    like = np.exp(np.maximum(score, -60.0))
    n = tables.shape[1]
    everything = np.ones((len(texts), n), dtype=bool)
    full, _ = _em(like, everything, doc, starts, counts, np.full((len(texts), n), 1.0 / n))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best, fits = np.full(len(texts), -np.inf), np.zeros(len(texts))
    chosen, size = full.copy(), np.zeros(len(texts), dtype=np.int64)
    # Documents whose shares leave no room for k languages need no fit of k languages.
    for k in range(1, n + 1):
        rows = np.flatnonzero((rank < k).sum(axis=1) == k) if k == 1 else np.flatnonzero(
            np.sort(full, axis=1)[:, -k] * counts >= 0.25)
        if not len(rows):
            break
        keep = np.isin(doc, rows)
        renumber = np.zeros(len(texts), dtype=np.int64)
        renumber[rows] = np.arange(len(rows))
        c = counts[rows]
        s = np.concatenate([[0], np.cumsum(c)[:-1]])
        share, fit = _em(like[keep], rank[rows] < k, renumber[doc[keep]], s, c, full[rows])
        value = fit - PENALTY * (k - 1) * np.log(c + 1.0)
        better = value > best[rows]
        at = rows[better]
        best[at], chosen[at], size[at], fits[at] = value[better], share[better], k, fit[better]
    evidence = (np.add.reduceat(peak, starts) + fits) / lengths + TABLE_BITS * np.log(2)
    return chosen, size, np.where(lengths < STRETCH, np.nan, evidence)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, doc_key (tells rows of one doc_id with different texts apart), lang_pred, score
    (share of the predicted language), n_langs, evidence (see `infer`; null where there is none);
    from the text alone."""
    langs = list(model)
    tables = np.stack([model[k] for k in langs], axis=1) if langs else None

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            pred, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
            sizes, evidence = np.zeros(n, dtype=np.int32), np.full(n, np.nan)
            texts = pdf["text"].tolist()
            rows = [i for i, t in enumerate(texts) if has_letter(t)] if langs else []
            for a, b in slices([len(texts[i]) for i in rows], 1_000_000):
                part = rows[a:b]
                share, size, evidence[part] = infer([texts[i] for i in part], tables)
                top = share.argmax(axis=1)
                pred[part] = [langs[t] for t in top]
                score[part] = np.clip(share[np.arange(len(part)), top], 0.0, 1.0)
                sizes[part] = size
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "doc_key": pdf["doc_key"],
                                "lang_pred": pred, "score": score, "n_langs": sizes,
                                "evidence": pd.array(evidence, dtype="Float64")})

    doc_id = F.col("doc_id").cast("long")
    return (docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc_key"), "text")
            .mapInPandas(run, "doc_id long, doc_key long, lang_pred string, score double, n_langs int, "
                              "evidence double"))


def language_id(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """Learn from the rows of `training` (default: `docs`) that are not held out; answer all."""
    model = train((docs if training is None else training).filter(~F.coalesce(held_out(), F.lit(False))))
    return predict(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "lang_pred", "score", "n_langs", "evidence", "doc_key")
