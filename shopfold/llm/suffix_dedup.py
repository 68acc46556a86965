"""Suffix-array deduplication by longest previous factors (operator 1).

A byte goes if a DEPTH-byte string that covers it also starts in a document with a smaller
doc_id.  Over the suffixes in suffix order, the earlier suffix with the longest common prefix is
the previous or the next one with a smaller position (here: document); so the longest previous
factor is the larger of the two common prefixes, and a suffix whose factor reaches DEPTH starts
a removed string.  Suffixes need sorting to DEPTH bytes only.

One suffix array of a corpus fits no machine, so suffixes are first brought together that can
match: every DEPTH-byte string has an anchor, the GRAM bytes in it with the smallest hash, and
equal strings have equal anchors.  Neighbouring suffixes share an anchor, so a run of them
travels as one stretch of text to the bucket of the anchor's hash (a text is sent about three
times over, compressed).  In a bucket, each suffix range of equal anchors is ordered and its
factors are computed.

Copies are settled early: of equal stretches in one chunk of documents only those of the
smallest doc_id travel (the others are known to go), so a passage in many documents costs a
bucket one stretch from each chunk.  Where a text repeats itself (a run of spaces, a rule), the
stretches behind each other are equal, as short as the period; such a run travels as one stretch
and the number of times it stands there.

Defined cases: a null text counts as empty; texts shorter than DEPTH lose nothing; a null doc_id
is smaller than every other; rows that repeat a doc_id are no earlier documents to each other; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfold.llm.common import shuffle_width, slices

DEPTH = 50
GRAM = 10
#: Bytes of text that are cut into stretches together, and of stretches that are sorted together.
CHUNK_BYTES = 2 << 20
_ANCHORS = DEPTH - GRAM + 1  # grams in a string
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = 0xD6E8FEB86659FD93
_LETTERS = np.random.default_rng(20).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_NULL_ID = -(1 << 63)
_POWERS: dict[str, np.ndarray] = {}


# --- numpy on one chunk or bucket ----------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the rolling hash, and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _POWERS[name] = np.cumprod(row)
    return _POWERS["up"], _POWERS["down"]


class _Rolling:
    """64-bit hashes of substrings of `data`."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[data] * up[:len(data)], out=self._sums[1:])

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        h = (self._sums[start + length] - self._sums[start]) * self._down[start]
        return h ^ (h >> np.uint64(31))


def _words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one integer (zeros after the end)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    out = np.empty(n, dtype=np.uint64)
    for r in range(min(8, n)):
        count = (n - r + 7) // 8
        out[r::8] = np.frombuffer(padded[r:r + 8 * count].tobytes(), dtype="<u8")
    return out


def _gram_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on (the last few positions are not used)."""
    second = np.zeros_like(words)
    second[:len(words) - (GRAM - 8)] = words[GRAM - 8:]
    h = words * _C1 ^ (second * _C2 >> np.uint64(7)) * _C3
    h ^= h >> np.uint64(29)
    h *= _C3
    return h ^ (h >> np.uint64(32))


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The substrings end to end, and where each starts."""
    ends = np.cumsum(lengths)
    at = ends - lengths
    if not len(ends):
        return np.zeros(0, dtype=np.uint8), at
    return data[np.arange(ends[-1]) + np.repeat(starts - at, lengths)], at


def stretches(data: np.ndarray, doc_starts: np.ndarray, doc_lengths: np.ndarray):
    """Runs of suffixes that share an anchor: start, number of suffixes, anchor position."""
    empty = np.zeros(0, dtype=np.int64)
    long = doc_lengths >= DEPTH
    if not long.any():
        return empty, empty, empty
    n = len(data)
    packed = _gram_hashes(_words8(data)) >> np.uint64(32) << np.uint64(32)
    packed |= np.arange(n, dtype=np.uint64)
    width = 1
    while width * 2 <= _ANCHORS:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    if rest := _ANCHORS - width:
        packed = np.minimum(packed[:-rest], packed[rest:])
    anchor = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)[:n - DEPTH + 1]
    mark = np.zeros(len(anchor) + 1, dtype=np.int8)
    mark[doc_starts[long]] = 1
    mark[doc_starts[long] + doc_lengths[long] - DEPTH + 1] = -1
    valid = np.cumsum(mark[:-1], dtype=np.int8) > 0
    turn = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    change = np.zeros(len(anchor) + 1, dtype=bool)
    change[turn] = True
    before, after = np.concatenate([[False], valid[:-1]]), np.concatenate([valid[1:], [False]])
    first = np.flatnonzero(valid & (~before | change[:-1]))
    last = np.flatnonzero(valid & (~after | change[1:]))
    return first, last - first + 1, anchor[first]


def _same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the substrings from `one` and from `other` on are the same."""
    out = np.zeros(len(one), dtype=bool)
    for a in range(0, len(one), 50_000):
        part = slice(a, a + 50_000)
        left, at = _gather(data, one[part], lengths[part])
        right, _ = _gather(data, other[part], lengths[part])
        out[part] = np.logical_and.reduceat(left == right, at)
    return out


def repeated_runs(hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, counts: np.ndarray,
                  docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches that do not just repeat the one before them in the text, and how many equal
    ones stand there behind each other."""
    sizes = counts + DEPTH - 1
    again = ((hashes[1:] == hashes[:-1]) & (counts[1:] == counts[:-1]) & (docs[1:] == docs[:-1])
             & (starts[1:] == starts[:-1] + counts[:-1]))
    maybe = np.flatnonzero(again)
    again[maybe] = _same_bytes(data, starts[maybe], starts[maybe + 1], sizes[maybe])
    kept = np.flatnonzero(np.concatenate([[True], ~again]))
    return kept, np.diff(np.append(kept, len(starts)))


def covered_by_smaller(hashes: np.ndarray, ids: np.ndarray, data: np.ndarray, starts: np.ndarray,
                       lengths: np.ndarray) -> np.ndarray:
    """Which substrings equal one with a smaller id; the substrings must be in ascending id order."""
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    head = np.empty(len(order), dtype=np.int64)
    head[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    found = np.flatnonzero((ids[head] < ids) & (lengths[head] == lengths))
    out = np.zeros(len(ids), dtype=bool)
    out[found] = _same_bytes(data, starts[found], starts[head[found]], lengths[found])
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each one, or -1 (pointer jumping)."""
    at = np.arange(len(values)) - 1
    open_ = np.flatnonzero((at >= 0) & (values[at] >= values))
    while len(open_):
        at[open_] = at[at[open_]]
        p = at[open_]
        open_ = open_[(p >= 0) & (values[p] >= values[open_])]
    return at


def longest_previous_factors(suffixes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of `suffixes` (n x depth bytes) the longest prefix it shares with a row of a
    smaller id: the larger common prefix with the previous and the next smaller in suffix order."""
    n, depth = suffixes.shape
    words = -(-depth // 8)
    padded = np.zeros((n, 8 * words), dtype=np.uint8)
    padded[:, :depth] = suffixes
    keys = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(tuple(keys[:, k] for k in range(words - 1, -1, -1)))
    rows, rank = suffixes[order], ids[order]
    previous = previous_smaller(rank)
    following = n - 1 - previous_smaller(rank[::-1])[::-1]  # n where there is none
    factor = np.zeros(n, dtype=np.int64)
    for other in (previous, following):
        at = np.flatnonzero((other >= 0) & (other < n))
        for a in range(0, len(at), 50_000):
            part = at[a:a + 50_000]
            differ = rows[part] != rows[other[part]]
            lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
            factor[part] = np.maximum(factor[part], lcp)
    out = np.empty(n, dtype=np.int64)
    out[order] = factor
    return out


def removed_suffixes(data: np.ndarray, starts: np.ndarray, counts: np.ndarray,
                     ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of stretches in ascending id order: (stretch, first, last) runs of removed suffixes."""
    rolling = _Rolling(data)
    lengths = counts + DEPTH - 1
    copies = covered_by_smaller(rolling.hash(starts, lengths), ids, data, starts, lengths)
    whole = np.flatnonzero(copies)
    left = np.flatnonzero(~copies)
    each = counts[left]
    owner = np.repeat(left, each)
    ends = np.cumsum(each)
    within = np.arange(len(owner)) - np.repeat(ends - each, each)
    at = starts[owner] + within
    hashes = rolling.hash(at, DEPTH)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    met = np.zeros(len(order), dtype=bool)
    met[order[1:][same]] = True
    met[order[:-1][same]] = True
    gone = np.zeros(len(order), dtype=bool)
    twice = np.flatnonzero(met)
    if len(twice):
        rows = data[at[twice][:, None] + np.arange(DEPTH)]
        gone[twice] = longest_previous_factors(rows, ids[owner[twice]]) >= DEPTH
    joined = gone[1:] & gone[:-1] & (owner[1:] == owner[:-1])
    first = np.flatnonzero(gone & ~np.concatenate([[False], joined]))
    last = np.flatnonzero(gone & ~np.concatenate([joined, [False]]))
    return (np.concatenate([whole, owner[first]]),
            np.concatenate([np.zeros(len(whole), dtype=np.int64), within[first]]),
            np.concatenate([counts[whole] - 1, within[last]]))


# --- what travels ---------------------------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard
    raw = b"".join([np.array([len(a) for a in arrays], dtype="<u8").tobytes(), *(a.tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    types = kinds.split()
    sizes, at, out = np.frombuffer(raw, "<u8", len(types)), 8 * len(types), []
    for kind, n in zip(types, sizes.tolist()):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


#: Documents (id, key); stretches (document, start in it, suffixes, times, anchor's place, bytes);
#: settled stretches (document, start, suffixes, times).
_STRETCHES = "<i8 <i8 <u4 <u4 <u1 <u4 <u1 <u1 <u4 <u4 <u1 <u4"
_SPANS = "<i8 <u4 <u4"
#: Documents of a part: id, key, null id, bytes, text.
_TEXTS = "<i8 <i8 <u1 <u4 <u1"


def _chunk_rows(texts: list[bytes], ids: np.ndarray, keys: np.ndarray, n_buckets: int):
    """(bucket, packed stretches) of some documents in ascending id order."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    doc_starts = np.cumsum(lengths) - lengths
    start, count, anchor = stretches(data, doc_starts, lengths)
    if not len(start):
        return
    doc = np.searchsorted(doc_starts, start, side="right") - 1
    size = count + DEPTH - 1
    hashes = _Rolling(data).hash(start, size)
    kept, times = repeated_runs(hashes, data, start, count, doc)
    hashes, start, count, anchor, doc, size = (c[kept] for c in (hashes, start, count, anchor, doc, size))
    settled = covered_by_smaller(hashes, ids[doc], data, start, size)
    gram = _gram_hashes_at(data, anchor)
    bucket = ((gram >> np.uint64(8)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket * 2 + settled, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        mine = order[edges[b]:edges[b + 1]]
        n_sent = int(np.count_nonzero(~settled[mine]))
        docs, local = np.unique(doc[mine], return_inverse=True)
        place = (start[mine] - doc_starts[doc[mine]]).astype("<u4")
        often = times[mine].astype("<u4")
        sent, gone = slice(0, n_sent), slice(n_sent, None)
        text, _ = _gather(data, start[mine[sent]], size[mine[sent]])
        yield b, _pack(ids[docs], keys[docs], local[sent].astype("<u4"), place[sent],
                       count[mine[sent]].astype("u1"), often[sent], (anchor - start)[mine[sent]].astype("u1"),
                       text, local[gone].astype("<u4"), place[gone], count[mine[gone]].astype("u1"), often[gone])


def _gram_hashes_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """_gram_hashes, at some positions only."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    weights = np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))
    out = np.empty(len(at), dtype=np.uint64)
    for a in range(0, len(at), 100_000):
        part = at[a:a + 100_000, None]
        first = (padded[part + np.arange(8)] * weights).sum(axis=1, dtype=np.uint64)
        second = (padded[part + np.arange(GRAM - 8, GRAM)] * weights).sum(axis=1, dtype=np.uint64)
        h = first * _C1 ^ (second * _C2 >> np.uint64(7)) * _C3
        h ^= h >> np.uint64(29)
        h *= _C3
        out[a:a + 100_000] = h ^ (h >> np.uint64(32))
    return out


def _bucket_spans(blobs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document key, start, end) of the removed bytes that the stretches of a bucket show.  Of a
    stretch that stands there several times the same suffixes go each time; they follow each other
    in less than DEPTH bytes, so what they cover is one span."""
    ids, keys, places, counts, times, offsets, texts = [], [], [], [], [], [], []
    out = []
    for blob in blobs:
        d_id, d_key, doc, place, count, often, offset, text, *gone = _unpack(blob, _STRETCHES)
        for column, values in ((ids, d_id[doc]), (keys, d_key[doc]), (places, place), (counts, count),
                               (times, often), (offsets, offset), (texts, text)):
            column.append(values)
        g_doc, g_place, g_count, g_times = (c.astype(np.int64) for c in gone)
        out.append((d_key[g_doc], g_place, g_place + g_count * g_times + DEPTH - 1))
    ids, keys, places = np.concatenate(ids), np.concatenate(keys), np.concatenate(places).astype(np.int64)
    counts, offsets = np.concatenate(counts).astype(np.int64), np.concatenate(offsets).astype(np.int64)
    times, data = np.concatenate(times), np.concatenate(texts)
    texts.clear()  # views of the unpacked blobs, which would stay in memory beside their copy
    size = counts + DEPTH - 1
    starts = np.cumsum(size) - size
    gram = _gram_hashes_at(data, starts + offsets)
    order = np.lexsort((ids, gram))
    # Ranges of equal anchors, as many as make a chunk; one anchor is never split.
    new = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]]))
    for a, b in slices(np.add.reduceat(size[order], new), CHUNK_BYTES) if len(order) else ():
        mine = order[new[a]:new[b] if b < len(new) else len(order)]
        mine = mine[np.argsort(ids[mine], kind="stable")]
        text, at = _gather(data, starts[mine], size[mine])
        which, first, last = removed_suffixes(text, at, counts[mine], ids[mine])
        row = mine[which]
        behind = (times[row].astype(np.int64) - 1) * counts[row]
        out.append((keys[row], places[row] + first, places[row] + behind + last + DEPTH))
    return tuple(np.concatenate(c) for c in zip(*out))


def _merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs (n x 2) of the union of the spans."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([s[first], e[last]], axis=1)


# --- Spark ------------------------------------------------------------------------

def _with_key(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc_key"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _span_rows(docs: DataFrame, n_buckets: int, n_parts: int) -> DataFrame:
    """(part, blob): packed spans for the documents of each part."""
    def cut(batches):
        for pdf in batches:
            pdf = pdf.assign(order=pdf["doc_id"].astype("Int64").fillna(_NULL_ID).astype("int64"))
            pdf = pdf.sort_values("order", kind="stable")
            texts, ids = pdf["text"].tolist(), pdf["order"].to_numpy()
            keys = pdf["doc_key"].to_numpy()
            for a, b in slices([len(t) for t in texts], CHUNK_BYTES):
                rows = list(_chunk_rows(texts[a:b], ids[a:b], keys[a:b], n_buckets))
                yield pd.DataFrame(rows, columns=["bucket", "blob"])

    def factors(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, starts, ends = _bucket_spans(pdf["blob"])
        part = keys % n_parts
        order = np.lexsort((starts, keys, part))
        edges = np.searchsorted(part[order], np.arange(n_parts + 1))
        rows = [(p, _pack(keys[mine], starts[mine].astype("<u4"), ends[mine].astype("<u4")))
                for p in range(n_parts) if len(mine := order[edges[p]:edges[p + 1]])]
        return pd.DataFrame(rows, columns=["part", "blob"])

    return (docs.mapInPandas(cut, "bucket int, blob binary")
            .groupBy("bucket").applyInPandas(factors, "part int, blob binary"))


def _packed_texts(docs: DataFrame, n_parts: int) -> DataFrame:
    """(part, blob): the documents of each part, packed by chunks (half the volume of rows)."""
    def run(batches):
        for pdf in batches:
            texts, keys = pdf["text"].tolist(), pdf["doc_key"].to_numpy()
            null = pdf["doc_id"].isna().to_numpy()
            ids = pdf["doc_id"].astype("Int64").fillna(0).astype("int64").to_numpy()
            for a, b in slices([len(t) for t in texts], 4 * CHUNK_BYTES):
                part = keys[a:b] % n_parts
                order = np.argsort(part, kind="stable") + a
                edges = np.searchsorted(part[order - a], np.arange(n_parts + 1))
                rows = []
                for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
                    mine = order[edges[p]:edges[p + 1]]
                    held = [texts[i] for i in mine]
                    rows.append((p, _pack(ids[mine], keys[mine], null[mine].astype("u1"),
                                          np.array([len(t) for t in held], dtype="<u4"),
                                          np.frombuffer(b"".join(held), dtype=np.uint8))))
                yield pd.DataFrame(rows, columns=["part", "blob"])

    return docs.mapInPandas(run, "part int, blob binary")


KEPT = "doc_id long, n_bytes long, spans array<long>, kept binary"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of each maximal removed run, one after the other)
    and kept, the remaining bytes."""
    n = shuffle_width(docs.sparkSession)
    rows = _with_key(docs)
    # A part's spans come before its texts.
    both = (_packed_texts(rows, n).withColumn("is_text", F.lit(True))
            .union(_span_rows(rows, n, n).withColumn("is_text", F.lit(False)))
            .repartition(n, "part").sortWithinPartitions("part", "is_text"))

    def apply(batches):
        part, found, spans = None, [], None
        for pdf in batches:
            for p, blob, is_text in zip(pdf["part"], pdf["blob"], pdf["is_text"]):
                if p != part:
                    part, found, spans = p, [], None
                if not is_text:
                    found.append(_unpack(blob, _SPANS))
                    continue
                if spans is None:
                    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
                    order = np.argsort(columns[0], kind="stable")
                    spans, found = [c[order].astype(np.int64) for c in columns], []
                yield _kept(blob, *spans)

    return both.mapInPandas(apply, KEPT)


def _kept(blob: bytes, span_keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    ids, keys, null, lengths, data = _unpack(blob, _TEXTS)
    raw, at, out = data.tobytes(), 0, []
    first, last = np.searchsorted(span_keys, keys, "left"), np.searchsorted(span_keys, keys, "right")
    for k, size in enumerate(lengths.tolist()):
        a, b = first[k], last[k]
        runs = _merged(starts[a:b], ends[a:b]).ravel().tolist() if b > a else []
        edges = [0, *runs, size]
        kept = b"".join([raw[at + x:at + y] for x, y in zip(edges[::2], edges[1::2])])
        out.append((size, runs, kept))
        at += size
    frame = pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])
    frame.insert(0, "doc_id", pd.array(ids, dtype="Int64"))
    frame.loc[null.astype(bool), "doc_id"] = pd.NA
    return frame
