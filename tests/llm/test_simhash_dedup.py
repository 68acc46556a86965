import random
import re

import xxhash
from tables import clash, make_docs

from shopfold.llm.simhash_dedup import drop_near_copies, fingerprint, near_links, simhash_groups
from shopfold.llm.components import components


def brute_fp(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = ([" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else []))
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(fps))]


def test_fingerprints_and_components(spark, edge_docs, prose):
    base = prose(70, 600)
    words = base.split()
    near = [(100 + k, " ".join(words[:k * 7] + ["zz"] + words[k * 7 + 1:])) for k in range(1, 30)]
    rows = edge_docs + [(99, base.upper())] + near
    got = simhash_groups(clash(make_docs(spark, rows))).collect()
    fps = [brute_fp(t) for _, t in rows]
    roots = brute_groups(fps)
    lowest = {}
    for (i, _), r in zip(rows, roots):
        lowest[r] = min([x for x in (lowest.get(r), i) if x is not None], default=None)
    want = sorted(((i, f"{f:016x}", lowest[r]) for (i, _), f, r in zip(rows, fps, roots)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    assert len(set(roots)) < len(set(fps))  # some links join different fingerprints


def test_long_text_in_parts(prose):
    text = prose(5, 120_000)
    assert fingerprint(text) == brute_fp(text)


def test_links_of_hot_keys_are_complete(spark):
    """A cluster far over the pairwise size, and random fingerprints, against all pairs."""
    r = random.Random(3)
    centre = r.getrandbits(64)
    fps = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 26) for b in range(26)} | {r.getrandbits(64) for _ in range(200)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components(near_links(df)).collect()}
    roots = brute_groups([f & (1 << 64) - 1 for f in signed])
    first = {}
    for f, root in zip(signed, roots):
        first.setdefault(root, f)
    for f, root in zip(signed, roots):
        assert got.get(f, f) == first[root]
    assert len(got) >= 300


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([((k * 37) % 101, ((k + 1) * 37) % 101) for k in range(100)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}


def test_drop_keeps_one_of_each_and_all_columns(spark, prose):
    a, b = prose(1, 50), prose(2, 50)
    docs = make_docs(spark, [(4, a), (2, a), (9, b), (2, b)])
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(2, a), (2, b)])


def test_one_row_of_each_component_stays(spark, prose):
    """Repeated rows, one id with two near texts, and a component of null ids alone."""
    a, b, c = prose(1, 600), prose(2, 50), prose(3, 50)
    near = a.replace(" ", "  ", 3)
    rows = [(2, a), (2, a), (2, near), (7, a), (None, a), (4, b), (4, b), (4, b)] + [(None, c)] * 20 + [(2, prose(4, 50))]
    left = drop_near_copies(clash(make_docs(spark, rows)))
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert len(got) == 4 and sorted(i for i, _ in got if i is not None) == [2, 2, 4]
    assert {(4, b), (None, c), (2, prose(4, 50))} < set(got) and ({(2, a), (2, near)} & set(got))


def test_empty_table(spark):
    assert simhash_groups(make_docs(spark, [])).count() == 0
