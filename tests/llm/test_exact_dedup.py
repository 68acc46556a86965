import hashlib
import re
from collections import defaultdict

from tables import clash, make_docs

from shopfold.llm.exact_dedup import DigestIndex, dedup_batch


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        t = t or ""
        h = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()
        groups[h].append((-len(t), i is not None, i if i is not None else 0, i))
    out = []
    for h, members in groups.items():
        keep = min(members)[3]
        out += [(i, keep, len(members), i == keep, h) for *_, i in members]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([tuple(r)[:5] for r in df.collect()], key=repr)


def test_matches_brute_force(spark, edge_docs):
    got = dedup_batch(clash(make_docs(spark, edge_docs)), DigestIndex(spark))
    assert rows_of(got) == brute(edge_docs)


def test_empty_table(spark):
    index = DigestIndex(spark)
    assert dedup_batch(make_docs(spark, []), index).count() == 0
    assert index.rows().count() == 0


def test_index_keeps_earlier_batches_and_repeats_nothing(spark):
    index = DigestIndex(spark, buckets=4)
    dedup_batch(make_docs(spark, [(10, "a b"), (11, "c")]), index, "one").collect()
    second = [(1, "a  b"), (2, "d"), (3, "d ")]
    got = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in
           dedup_batch(make_docs(spark, second), index, "two").collect()}
    assert got == {1: (10, False, 1), 2: (3, False, 2), 3: (3, True, 2)}
    before = index.rows().count()
    again = {r.doc_id: r.keep_id for r in dedup_batch(make_docs(spark, second), index, "two").collect()}
    assert again == {1: 10, 2: 3, 3: 3}
    assert index.rows().count() == before == 3
    # The index side of the joins is read in its buckets: no exchange above its scan.
    plan = index.rows().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
