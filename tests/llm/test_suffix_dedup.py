import hashlib
import random

import numpy as np
import pytest
from tables import clash, make_docs

from shopfold.llm import suffix_dedup
from shopfold.llm.suffix_dedup import longest_previous_factors, previous_smaller, remove_repeats


def brute(rows):
    """(doc_id, bytes, removed spans, kept bytes) by a dictionary of all 50-byte strings."""
    first = {}
    rank = [(-1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in rank:
        for s in range(len(t) - 49):
            key = t[s:s + 50]
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, t), (orig, _) in zip(rank, rows):
        mask = np.zeros(len(t) + 2, dtype=np.int8)
        for s in range(len(t) - 49):
            if first[t[s:s + 50]] < i:
                mask[s + 1:s + 51] = 1
        edges = np.flatnonzero(np.diff(mask)).tolist()
        kept = bytes(b for b, m in zip(t, mask[1:-1]) if not m)
        out.append((orig, len(t), edges, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(docs):
    return sorted(((r.doc_id, r.n_bytes, list(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
                   for r in remove_repeats(docs).collect()), key=repr)


def test_edge_cases(spark, edge_docs):
    assert run(clash(make_docs(spark, edge_docs))) == brute(edge_docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(spark, seed, prose, monkeypatch):
    r = random.Random(seed)
    passages = [prose(seed * 50 + k, r.randint(5, 30), 40) for k in range(8)]
    rows = [(k * 3 % 41, r.choice(["", " ", "é"]).join(
        r.choice(passages)[r.randint(0, 20):] if r.random() < 0.6 else prose(r.random(), 20, 60)
        for _ in range(r.randint(0, 6)))) for k in range(41)] + [(60, "ab" * 300), (61, "ab" * 200), (62, "c" * 500)]
    assert run(make_docs(spark, rows)) == brute(rows)


def test_many_copies_and_an_empty_table(spark, prose):
    shared = prose(9, 40)
    rows = [(k, prose(100 + k, 8) + shared + prose(300 + k, 8)) for k in range(120)]
    assert run(make_docs(spark, rows)) == brute(rows)
    assert remove_repeats(make_docs(spark, [])).count() == 0


def test_factors_against_brute_force():
    r = np.random.default_rng(4)
    rows = r.integers(97, 99, (60, 12)).astype(np.uint8)
    rows[40:] = rows[:20]
    ids = r.integers(0, 15, 60)
    want = [max([0] + [int(np.argmin(np.append(rows[a] == rows[b], False))) for b in range(60) if ids[b] < ids[a]])
            for a in range(60)]
    assert longest_previous_factors(rows, ids).tolist() == want
    values = r.integers(0, 9, 200)
    want = [max([b for b in range(a) if values[b] < values[a]], default=-1) for a in range(200)]
    assert previous_smaller(values).tolist() == want


def test_a_text_over_several_chunks(prose):
    text = prose(3, 2000).encode()
    rows = [(text, 1), (b"x" * 10 + text, 2)]
    packed = {}
    for t, i in rows:  # each in a chunk of its own
        for b, blob in suffix_dedup._chunk_rows([t], np.array([i]), np.array([i]), 3):
            packed.setdefault(b, []).append(blob)
    spans = [np.concatenate(c) for c in zip(*(suffix_dedup._bucket_spans(v) for v in packed.values()))]
    merged = suffix_dedup._merged(spans[1][spans[0] == 2], spans[2][spans[0] == 2])
    assert merged.tolist() == [[10, 10 + len(text)]] and not (spans[0] == 1).any()


@pytest.mark.parametrize("period", [1, 2, 7, 40, 41, 49, 60])
def test_runs_that_repeat_themselves(spark, period, prose):
    """Runs of one unit, of other lengths and with other neighbours, within and across documents."""
    unit = ("=-ab cdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")[:period]
    r = random.Random(period)
    rows = [(k, "".join(r.choice([unit * r.randint(1, 400 // period + 2), unit[:-1] * r.randint(1, 9),
                                  prose(r.random(), 6), "="]) for _ in range(r.randint(1, 6)))) for k in range(30)]
    assert run(make_docs(spark, rows)) == brute(rows)


def test_a_long_run_travels_as_one_stretch():
    sent = 0
    for _, blob in suffix_dedup._chunk_rows([b" " * 300_000, b"." * 200_000 + b"x"], np.array([1, 2]),
                                            np.array([1, 2]), 3):
        sent += len(suffix_dedup._unpack(blob, suffix_dedup._STRETCHES)[7])
    assert sent < 5_000
