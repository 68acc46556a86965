"""Token-id files with a shared zstandard dictionary (operator 6).

Documents are put in doc_id order by range partitions; each task encodes its documents and
writes containers of a bounded size through Spark's committer.  A container has the SHA-256 of
the dictionary, an offset index, and one zstandard frame for each document, so one short
document can be read without its neighbours.

Container: b"TOKIDS1\\n", dictionary SHA-256 (32 bytes), n (u32), then for each document
doc_id (i64), 1 if the doc_id is null (u8), ids (u64), frame offset (u64), and the end of the
last frame (u64); all little-endian; then the frames, each the ids as u32.

Defined cases: a null text counts as empty (its end id alone); null doc_ids come first; rows that
repeat a doc_id are separate documents in text-hash order; an empty table gives no containers and
no rows; with too few documents to train on, frames use no dictionary (hash of no bytes).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopfold.llm.common import memo_tokenizer, shuffle_width, slices

TOKENIZER = "word_bpe_49k.json"
END_ID = np.array([1], dtype="<u4").tobytes()
#: The dictionary is trained on this many documents (smallest hashes of the id) and is this large.
DICTIONARY_DOCS = 600
DICTIONARY_BYTES = 64 << 10
CONTAINER_BYTES = 2 << 20
MAGIC = b"TOKIDS1\n"
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n_ids", "<u8"), ("offset", "<u8")])
SHARDS = ("part int, shard int, n_docs long, n_ids long, start_in_part long, "
          "first_doc_id long, last_doc_id long, container binary")


def _encoded(texts: list[str | None], tokenizer: str) -> list[bytes]:
    return [ids + END_ID for ids in memo_tokenizer(tokenizer, False).encode([t or "" for t in texts])]


def train_dictionary(docs: DataFrame, tokenizer: str = TOKENIZER, n_docs: int = DICTIONARY_DOCS,
                     n_bytes: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary from the serialised ids of a bounded sample of documents."""
    import zstandard
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n_docs).distinct()

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"ids": _encoded(pdf["text"].tolist(), tokenizer)})

    # At most n_docs ids: bounded, so it may be broadcast.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id")
    got = sorted(bytes(r["ids"]) for r in sample.mapInPandas(run, "ids binary").toLocalIterator())
    try:
        return zstandard.train_dictionary(n_bytes, got).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def build_container(doc_ids: list, ids: list[bytes], dictionary: bytes) -> bytes:
    import zstandard
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    compressor = zstandard.ZstdCompressor(level=3, **options)
    frames = [compressor.compress(x) for x in ids]
    index = np.zeros(len(ids), dtype=_INDEX)
    index["null"] = [d is None for d in doc_ids]
    index["doc_id"] = [0 if d is None else d for d in doc_ids]
    index["n_ids"] = [len(x) // 4 for x in ids]
    ends = np.cumsum([len(x) for x in frames], dtype=np.uint64)
    index["offset"][1:] = ends[:-1]
    return b"".join([MAGIC, hashlib.sha256(dictionary).digest(), np.uint32(len(ids)).tobytes(),
                     index.tobytes(), ends[-1:].tobytes(), *frames])


class Container:
    """Reads one document, or all, from a container."""

    def __init__(self, raw: bytes, dictionary: bytes):
        import zstandard
        if raw[:8] != MAGIC:
            raise ValueError("not a token-id container")
        if raw[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the container was written with another dictionary")
        n = int(np.frombuffer(raw, "<u4", 1, 40)[0])
        self.index = np.frombuffer(raw, _INDEX, n, 44)
        self._start = 44 + n * _INDEX.itemsize + 8
        end = np.frombuffer(raw, "<u8", 1, self._start - 8)
        self._edges = np.append(self.index["offset"], end).astype(np.int64)
        self._raw = raw
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self._zstd = zstandard.ZstdDecompressor(**options)

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, k: int) -> int | None:
        return None if self.index["null"][k] else int(self.index["doc_id"][k])

    def ids(self, k: int) -> np.ndarray:
        a, b = self._edges[k], self._edges[k + 1]
        raw = self._zstd.decompress(self._raw[self._start + a:self._start + b])
        return np.frombuffer(raw, dtype="<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document (documents are in ascending order, null ids first)."""
        first = int(self.index["null"].sum())
        k = first + int(np.searchsorted(self.index["doc_id"][first:], doc_id))
        return self.ids(k) if k < len(self) and self.doc_id(k) == doc_id else None


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER,
                      dictionary: bytes | None = None) -> bytes:
    """Write `docs` (doc_id, text) as containers under `path`; returns the dictionary, which is
    also kept beside them."""
    spark = docs.sparkSession
    if dictionary is None:
        dictionary = train_dictionary(docs, tokenizer)

    def run(batches):
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, held = [], [], 0

        def flush():
            nonlocal shard, start, ids, doc_ids, held
            n = sum(len(x) for x in ids) // 4
            row = (part, shard, len(ids), n, start, doc_ids[0], doc_ids[-1],
                   build_container(doc_ids, ids, dictionary))
            shard, start, ids, doc_ids, held = shard + 1, start + n, [], [], 0
            out = pd.DataFrame([row], columns=[c.split()[0] for c in SHARDS.split(", ")])
            return out.astype({"first_doc_id": "Int64", "last_doc_id": "Int64"})

        for pdf in batches:
            texts = pdf["text"].tolist()
            keys = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
            for a, b in slices([len(t or "") for t in texts], 1_000_000):
                for key, x in zip(keys[a:b], _encoded(texts[a:b], tokenizer)):
                    ids.append(x)
                    doc_ids.append(key)
                    held += len(x)
                    if held >= 4 * CONTAINER_BYTES:
                        yield flush()
        if ids:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(shuffle_width(spark), "doc_id")
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    ordered.mapInPandas(run, SHARDS).write.mode("error").parquet(f"{path}/shards")
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
                          "sha256 string, dictionary binary").write.mode("error").parquet(f"{path}/dictionary")
    return dictionary


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document in all files), n_tokens, ids_crc32, dict_sha256."""
    saved = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, name = bytes(saved["dictionary"]), saved["sha256"]
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each writing task.
    bases = (shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")))

    def run(batches):
        for pdf in batches:
            for raw, start in zip(pdf["container"], pdf["start"]):
                box = Container(raw, dictionary)
                rows = []
                for k in range(len(box)):
                    ids = box.ids(k)
                    rows.append((box.doc_id(k), start, len(ids), zlib.crc32(ids.tobytes()), name))
                    start += len(ids)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "dict_sha256"])
                yield out.astype({"doc_id": "Int64"})

    return (shards.join(F.broadcast(bases), "part")
            .select("container", (F.col("start_in_part") + F.col("base")).alias("start"))
            .mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long, dict_sha256 string"))
