import random
import re
from collections import Counter

from tables import clash, make_docs

from shopfold.llm.decontamination import drop_leaking, hamming_candidates, leaks


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    k = min(5, len(words))
    return words, k


def brute(rows, items, least=0.8):
    out = {}
    for i, t in rows:
        words, _ = grams(t)
        for j, b in items:
            item, k = grams(b)
            if not item or len(words) < k:
                continue
            want = Counter(tuple(item[a:a + k]) for a in range(len(item) - k + 1))
            size = min(len(item), len(words))
            best = 0
            for s in range(len(words) - size + 1):
                w = words[s:s + size]
                have = Counter(tuple(w[a:a + k]) for a in range(len(w) - k + 1))
                common = sum((want & have).values())
                best = max(best, common / (sum(want.values()) + sum(have.values()) - common))
            if best >= least - 1e-12:
                out[i, j] = max(out.get((i, j), 0), round(best, 9))
    return out


def bench_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def run(spark, docs, items):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in leaks(docs, bench_df(spark, items)).collect()}


def test_leaks_against_brute_force(spark, edge_docs, prose):
    r = random.Random(4)
    items = [(k, prose(500 + k, r.randint(14, 60))) for k in range(12)]
    items += [(50, "one two"), (51, ""), (52, None), (53, "la la la la la la la la la la"), (0, items[1][1]), (None, prose(530, 20))]
    rows = list(edge_docs)
    for k in range(120):
        words = prose(k + 40, r.randint(0, 80)).split()
        passage = (r.choice(items)[1] or "").split()
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            if passage:
                at = r.choice([0, 1, 2, len(passage) - 1, r.randrange(len(passage))])
                passage[at:at + 1] = r.choice([[], ["zz"], [passage[min(at, len(passage) - 1)], "yy"]])
                if not passage:
                    break
        at = r.randint(0, len(words))
        sep = r.choice([" ", "\n", "  "])
        rows.append((100 + k, sep.join(words[:at] + [p.upper() for p in passage] + words[at:])))
    rows += [(900, "one two"), (901, "say one TWO three"), (902, "la " * 40)]
    want = brute(rows, items)
    got = run(spark, clash(make_docs(spark, rows)), items)
    assert got == want and len(want) > 60
    docs = make_docs(spark, rows)
    left = drop_leaking(docs, bench_df(spark, items))
    assert left.columns == docs.columns
    bad = {i for i, _ in want}
    assert sorted((x.doc_id for x in left.collect()), key=repr) == sorted((i for i, _ in rows if i not in bad), key=repr)


def test_replaced_runs_against_brute_force(spark, prose):
    """One run of a repeated word differs: its shingle occurs many times, and is one of many."""
    items, rows = [], []
    for k, (n, run_of) in enumerate([(93, 11), (180, 20), (360, 40), (93, 11), (180, 20), (120, 13)]):
        words = prose(700 + k, n, 4000).split()
        for j, (a, b) in enumerate([("_", "."), ("0", "|"), ("---", "***")]):
            items.append((10 * k + j, " ".join(words + [a] * run_of)))
            rows.append((1000 + 10 * k + j, prose(40 + k, 9) + " " + " ".join(words + [b] * run_of)))
    items += [(90, "la " * 30), (91, prose(95, 60) + " 0" * 60)]
    rows += [(90, "la " * 26), (91, prose(95, 60) + " 0" * 45), (92, prose(95, 55) + " 0" * 60)]
    want = brute(rows, items)
    assert run(spark, make_docs(spark, rows), items) == want
    assert len(want) >= 15


def test_empty_tables(spark, prose):
    assert leaks(make_docs(spark, []), bench_df(spark, [(1, prose(1, 20))])).count() == 0
    assert leaks(make_docs(spark, [(1, prose(1, 20))]), bench_df(spark, [])).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    r = random.Random(9)
    items = [r.getrandbits(64) for _ in range(30)]
    windows = [x ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 24))) for x in items for _ in range(8)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    left = spark.createDataFrame([(k, 1, signed(x)) for k, x in enumerate(windows)], "w int, k int, fp long")
    right = spark.createDataFrame([(k, 1, signed(x)) for k, x in enumerate(items)], "i int, k int, fp long")
    got = {(r.w, r.i): r.bit_distance for r in hamming_candidates(left, right, ["k"]).collect()}
    far = {(a, b): bin(x ^ y).count("1") for a, x in enumerate(windows) for b, y in enumerate(items)}
    assert got == {k: v for k, v in far.items() if v <= 19}


def test_native(spark, prose):
    """No Python, pandas, Arrow or RDD node in any plan of the main path."""
    import inspect

    from shopfold.llm import decontamination
    source = inspect.getsource(decontamination)
    assert not re.search(r"udf|InPandas|InArrow|\.rdd|toPandas", source)
