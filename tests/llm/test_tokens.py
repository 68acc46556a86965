"""Operators 2, 6 and 7, and the memoised tokenizers they share."""

import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from tables import clash, make_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopfold.llm import packing, token_output
from shopfold.llm.common import MemoTokenizer, fresh_path, tokenizer_path
from shopfold.llm.token_counts import TOKENIZERS, TokenRollup

ODD = ["", " a  b\n\nc", "a\n b", "it's 5's\tx", "x y  ", "\n", "e ́x", "a\x1cb c", "<|endoftext|> q<|startoftext|>",
       "<|ENDOFTEXT|> A.B, c.\nd,", "Word. next, one.\nTwo", "Å Kİ ΣΣ", "... a.. b.", "a. b",
       "　", "don't. Won't, ", "\U0001f600. x", "a,\n,b", "x." * 50]


@cache
def library(file):
    return Tokenizer.from_file(tokenizer_path(file))


def reference(file, text):
    return library(file).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file,keeps_space", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_memo_equals_the_library(file, keeps_space, prose):
    r = random.Random(8)
    texts = ODD + ["".join(r.choices("ab'sE.,! \n\t5é́", k=r.randint(0, 40))) for _ in range(300)] + [prose(1, 200)]
    memo = MemoTokenizer(file, keeps_space, max_words=40)
    tok = library(file)
    got = [np.frombuffer(x, "<u4").tolist() for a in range(0, len(texts), 9) for x in memo.encode(texts[a:a + 9])]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


# --- token files (6) -------------------------------------------------------------

def test_token_files_round_trip(spark, edge_docs, monkeypatch):
    rows = edge_docs + [(200 + k, t) for k, t in enumerate(ODD)]
    path = fresh_path(spark, "test_token_files")
    dictionary = token_output.write_token_files(clash(make_docs(spark, rows)), path)
    got = token_output.read_token_files(spark, path).collect()
    want = []
    for i, t in rows:
        ids = reference("word_bpe_49k.json", t or "") + [1]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    shard = next(r for r in spark.read.parquet(f"{path}/shards").collect()
                 if r.first_doc_id is not None and r.first_doc_id <= 16 <= r.last_doc_id)
    box = token_output.Container(bytes(shard.container), dictionary)
    assert box.find(16).tolist() == reference("word_bpe_49k.json", dict(rows)[16]) + [1]
    assert box.find(10 ** 9) is None
    with pytest.raises(ValueError):
        token_output.Container(bytes(shard.container), dictionary + b"x")


def test_containers_are_cut_and_use_the_dictionary(spark, prose, monkeypatch):
    rows = [(k, prose(k, 60)) for k in range(300)]
    path = fresh_path(spark, "test_token_files")
    dictionary = token_output.write_token_files(make_docs(spark, rows), path)
    assert dictionary[:4] == b"\x37\xa4\x30\xec"
    ids = np.array(reference("word_bpe_49k.json", rows[0][1]), "<u4").tobytes()
    assert len(token_output.build_container([1], [ids], dictionary)) < len(token_output.build_container([1], [ids], b""))


def test_no_documents_no_rows(spark):
    path = fresh_path(spark, "test_token_files")
    token_output.write_token_files(make_docs(spark, []), path)
    assert token_output.read_token_files(spark, path).count() == 0
    assert packing.pack(make_docs(spark, [])).count() == 0


# --- packing (7) -------------------------------------------------------------------

def check_packing(rows, got, sequence=packing.SEQUENCE):
    """Every id once, checksums right, sequences gapless; returns the share of padding."""
    want = Counter()
    by_doc = defaultdict(list)
    for i, t in rows:
        by_doc[i].append(reference("byte_bpe_50k.json", t or "") + [1])
    covered = defaultdict(Counter)
    for r in got:
        fits = [k for k, ids in enumerate(by_doc[r.doc_id]) if len(ids) == r.doc_tokens and r.ids_crc32 == zlib.crc32(
            np.array(ids[r.start:r.start + r.length], "<u4").tobytes())]
        assert fits and r.length > 0
        covered[r.doc_id, tuple(by_doc[r.doc_id][fits[0]])].update(range(r.start, r.start + r.length))
    for i, versions in by_doc.items():
        for ids, times in Counter(map(tuple, versions)).items():
            assert covered[i, ids] == Counter({k: times for k in range(len(ids))})
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= sequence
        total += at
        padding += 0 if at & (at - 1) == 0 else sequence - at
    return padding / total


def test_packing_edge_cases(spark, edge_docs):
    rows = edge_docs + [(300 + k, t) for k, t in enumerate(ODD)]
    check_packing(rows, packing.pack(clash(make_docs(spark, rows))).collect())


def test_packing_leaves_little_padding(spark, prose):
    r = random.Random(5)
    rows = [(k, prose(k, int(r.lognormvariate(5, 1)) + 1)) for k in range(1500)] + [(5000 + k, prose(1, 77)) for k in range(700)]
    got = packing.pack(make_docs(spark, rows)).collect()
    assert check_packing(rows, got) < 0.01


def test_cutting_stock_is_near_the_bound():
    r = np.random.default_rng(2)
    sizes = np.arange(1, 129)
    demand = r.integers(0, 400, 128) + 1
    patterns, times = packing.cutting_stock(sizes, demand, 128)
    assert (patterns @ sizes <= 128).all()
    made = patterns.T @ times
    assert (made <= demand).all()
    # No plan needs fewer sequences than the volume, or than the sizes that can't share one.
    bound = max((sizes * demand).sum() / 128, demand[sizes > 64].sum() + demand[sizes == 64].sum() / 2)
    assert times.sum() <= 1.02 * bound and (sizes * made).sum() > 0.95 * (sizes * demand).sum()


def test_knapsack_prices():
    r = np.random.default_rng(3)
    for _ in range(20):
        sizes, values = r.integers(1, 12, 6), r.random(6)
        best = [0.0] * 25
        for w in range(1, 25):
            best[w] = max([best[w - 1]] + [best[w - s] + v for s, v in zip(sizes, values) if s <= w])
        value, taken = packing.price(values, sizes, 24)
        assert value == pytest.approx(best[24]) == pytest.approx(taken @ values) and taken @ sizes <= 24


# --- rollups (2) ---------------------------------------------------------------------

def changes(spark, rows, schema="doc_id long, text string, source string, lang string, op string, seq long"):
    return spark.createDataFrame(rows, schema)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in rollup.totals().collect()}


def brute(live):
    out = defaultdict(lambda: np.zeros(3, dtype=int))
    for text, source, lang in live:
        for name, (file, _) in TOKENIZERS.items():
            out[source, lang, name] += (1, len(reference(file, text or "")), len(text or ""))
    return {k: tuple(v.tolist()) for k, v in out.items()}


def test_signed_batches(spark, prose):
    rollup = TokenRollup(spark)
    a, b, c, d = (prose(k, 20 + k) for k in range(4))
    load = changes(spark, [(1, a, "s", "en", "insert", 0), (2, b, "s", "de", "insert", 0), (3, None, None, None, "insert", 0),
                           (None, c, "s", "en", "insert", 0), (None, c, "s", "en", "insert", 0), (4, d, "t", "en", "insert", 0),
                           (4, d, "t", "en", "insert", 0)])
    assert rollup.apply("one", load)
    live = [(a, "s", "en"), (b, "s", "de"), (None, None, None), (c, "s", "en"), (c, "s", "en"), (d, "t", "en")]
    assert totals(rollup) == brute(live)
    assert not rollup.apply("one", load)
    assert totals(rollup) == brute(live)
    rollup.apply("two", changes(spark, [(1, d, "t", "fr", "revise", 1), (1, b, "t", "fr", "revise", 2), (2, None, None, None, "delete", 0),
                                        (77, None, None, None, "delete", 0), (3, c, "s", "en", "insert", 0), (5, "", "s", "en", "insert", 0)]))
    live = [(b, "t", "fr"), (c, "s", "en"), (c, "s", "en"), (c, "s", "en"), (d, "t", "en"), ("", "s", "en")]
    assert totals(rollup) == brute(live)
    assert rollup.apply("three", changes(spark, []))
    assert totals(rollup) == brute(live)
    # A broken-off batch (ledger without a delta) is not read, and is overwritten.
    rollup._read("ledger").limit(1).write.parquet(rollup._folder("ledger", "four"))
    assert totals(rollup) == brute(live) and rollup.state().count() == 2 * 5
    rollup.apply("four", changes(spark, [(4, None, None, None, "delete", 0)]))
    assert totals(rollup) == brute([x for x in live if x[0] != d])


def test_bulk_load_of_documents(spark, edge_docs):
    rollup = TokenRollup(spark)
    rollup.apply("load", clash(make_docs(spark, edge_docs)).withColumn("op", F.lit("insert")))
    live = {i: t for i, t in edge_docs if i is not None}
    want = brute([(t, "src0", "en") for t in [*live.values(), *(t for i, t in edge_docs if i is None)]])
    assert totals(rollup) == want


def test_registered_rollup_ends_in_the_plain_totals(spark):
    """Loads, revisions, deletes, re-inserts and a repeated batch leave what one load leaves."""
    from shopfold.llm import queries
    from shopfold.llm.common import documents
    sf_dir = "/root/testdata/sf0.001"
    plain = TokenRollup(spark)
    plain.apply("load", documents(spark, sf_dir).withColumn("op", F.lit("insert")))
    got = queries.op2_token_counts(spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.totals().collect()))
