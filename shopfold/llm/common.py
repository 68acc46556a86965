"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import uuid
from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfold.session import scratch_path

#: Characters that the contracts call white space: space, tab, LF, VT, FF, CR.
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: Rows of one Arrow batch: whole texts are long, so a Python worker gets fewer of them at a time.
ARROW_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Keep Python workers small: Spark's default of 10,000 texts a batch is tens of MB, held
    several times over (JVM, Arrow, pandas)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder; never reused by another run."""
    return scratch_path(spark, "llm", name, uuid.uuid4().hex)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and lets several later steps read one result without recomputing it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def key_id(column: str = "doc_id"):
    """Null ids sort first and stay one id of their own."""
    return F.col(column).cast("long")


#: Stands for a null id where rows go through Python, which would turn ids beside nulls into floats.
NO_ID = (1 << 63) - 1


def id_in(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias(column)


def id_out(column: str):
    return F.when(F.col(column) < NO_ID, F.col(column)).alias(column)


# --- tokenizers ---------------------------------------------------------------

def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; an existing path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


#: How byte-level vocabularies spell bytes: printable ones as they are, the others from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE_LETTER = _BYTE_LETTERS[0x20]
_LATIN_1 = dict.fromkeys(range(256))
_CLOSING = re.compile(r"(?<=[a-z])([.,])(?=[ \n]|\Z)")


class _Remembered(dict):
    """Ids by unit; a unit that is missing is made, and kept in two generations of `size` at most."""

    def __init__(self, make, size: int):
        super().__init__()
        self._make, self._size, self._older = make, size, {}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        ids = self._older.get(unit)
        if ids is None:
            ids = self._make(unit)
        self[unit] = ids
        return ids


class MemoTokenizer:
    """Encodes texts with the tokenizers library, remembering the ids of frequent words.

    A text is cut only where the tokenizer itself always cuts, so the joined ids equal those
    of one call over the whole text:

    * ``keeps_space=False`` (white space is dropped by the tokenizer, A-Z are lowered): at spaces
      and line feeds;
    * ``keeps_space=True`` (a word takes its leading space): before each single space and around
      each single line feed between two visible characters.  Any other text goes through the
      library in one piece;
    * both: between a letter a-z and a full stop or comma that white space or the end follows.

    The memory is bounded: two generations of `max_words` at most; it saves time only.
    """

    def __init__(self, file: str, keeps_space: bool, max_words: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(tokenizer_path(file))
        self._model = self._tok.model
        self._keeps_space = keeps_space
        self._ids_of = _Remembered(self._unit_ids, max_words).__getitem__

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _unit_ids(self, unit: str) -> bytes:
        """Ids of a unit.  A word of Latin-1 letters is one piece to the tokenizer, which its
        normaliser (after lower case) leaves alone, so it goes to the model directly."""
        space = unit[:1] == " "
        word = unit[1:] if space else unit
        piece = None
        if word.isalpha():
            word = word if self._keeps_space else word.lower()
            if word.isascii():
                piece = _SPACE_LETTER + word if space else word
            elif word.translate(_LATIN_1) == "":
                piece = (" " * space + word).encode().decode("latin-1").translate(_BYTE_LETTERS)
        if piece is None:
            return self._raw([unit])[0]
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _units(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if it has to be encoded as a whole."""
        if not self._keeps_space:
            if "<|" not in text:  # ids of special tokens are spelled in one case only
                text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            return _CLOSING.sub(r" \1", text).replace("\n", " ").split(" ")
        if not text or " ".join(text.split()) != text.replace("\n", " "):
            return None
        # No other white space is left in such a text, so a carriage return can mark the cuts.
        return _CLOSING.sub("\r\\1", text).replace(" ", "\r ").replace("\n", "\r\n\r").split("\r")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, whole = [b""] * len(texts), []
        for i, text in enumerate(texts):
            units = self._units(text)
            if units is None:
                whole.append(i)
            else:
                out[i] = b"".join(map(self._ids_of, units))
        for i, ids in zip(whole, self._raw([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        return out


_TOKENIZERS: dict[tuple, MemoTokenizer] = {}


def memo_tokenizer(file: str, keeps_space: bool) -> MemoTokenizer:
    """One tokenizer per Python worker, kept between tasks."""
    key = (file, keeps_space)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = MemoTokenizer(file, keeps_space)
    return _TOKENIZERS[key]


def slices(lengths, target: int):
    """Consecutive (start, end) ranges whose lengths sum to about `target` each."""
    start = total = 0
    for i, n in enumerate(lengths):
        total += int(n)
        if total >= target:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)
