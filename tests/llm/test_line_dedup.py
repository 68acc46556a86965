import random

from tables import clash, make_docs

from shopfold.llm import line_dedup
from shopfold.llm.line_dedup import MIN_CHARS, MIN_EDIT_CHARS, dedup_lines


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1:] == b[k + 1:]
    return a[k + 1:] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1:]


def brute(rows):
    """Line by line in (id, text) order, against all lines before; one text for each id."""
    seen, out = [], {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            out[i] = (None, 0, 0)
            continue
        left, removed, near = [], 0, 0
        for line in t.split("\n"):
            x = " ".join(line.split())
            equal = len(x) >= MIN_CHARS and x in seen
            close = not equal and len(x) >= MIN_EDIT_CHARS and any(
                len(y) >= MIN_EDIT_CHARS and within_one_edit(x, y) for y in seen)
            seen.append(x)
            removed += equal or close
            near += close
            if not (equal or close):
                left.append(line)
        out[i] = ("\n".join(left), removed, near)
    return out


def run(docs):
    return {r.doc_id: (r.text, r.done.removed, r.done.near) for r in dedup_lines(docs, "done").collect()}


def typo(r, line):
    k = r.randrange(len(line))
    return r.choice([line[:k] + line[k + 1:], line[:k] + "q" + line[k:], line[:k] + "q" + line[k + 1:]])


def test_edits_against_brute_force(spark, prose):
    r = random.Random(6)
    base = [prose(k, r.randint(1, 40)) for k in range(30)] + ["aaaa" * 20, "ab" * 30, "word " * 30]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(0, 7)):
            line = r.choice(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                line = typo(r, line)
            lines.append(r.choice(["", "  "]) + line.replace(" ", r.choice([" ", "  "]), 2))
        rows.append((i * 7 % 61, "\n".join(lines)))
    want = brute(rows)
    assert run(make_docs(spark, rows)) == want
    assert sum(n for _, _, n in want.values()) > 20


def test_edge_cases(spark, edge_docs):
    rows = [(i, t) for i, t in edge_docs if i is not None]
    docs = clash(make_docs(spark, rows))
    done = dedup_lines(docs, "done")
    assert done.columns == docs.columns + ["done"]
    assert run(docs) == brute(rows)
    assert done.count() == len(rows)
    same = [r for r in done.collect() if r.doc_id == 5]  # a repeated row keeps the same lines
    assert len(same) == 2 and same[0] == same[1]


def test_null_ids_come_first(spark, prose):
    line = prose(1, 12)
    got = run(make_docs(spark, [(0, line), (None, line)]))
    assert got == {None: (line, 0, 0), 0: ("", 1, 0)}


def test_short_equal_lines_go(spark, prose):
    """A passage goes as a whole, with its short lines; blank lines stay."""
    a, b = prose(1, 12), prose(2, 12)
    got = run(make_docs(spark, [(1, f"{a}\nOf it.\n\n}}\n{b}"), (2, f"{a}\n Of  it.\n\n}}\n{b}"), (3, "x\nOf it\nx\n}")]))
    assert got == {1: (f"{a}\nOf it.\n\n}}\n{b}", 0, 0), 2: ("", 4, 0), 3: ("x\nOf it", 2, 0)}


def test_empty_table(spark):
    assert dedup_lines(make_docs(spark, [])).count() == 0


def test_one_template_with_many_numbers(spark, prose):
    """A hot set of lines within one edit of each other meets by grouping, not in pairs."""
    stem = prose(2, 10)
    rows = [(k, f"{stem} page {k:04d} of many, many more pages") for k in range(1500)]
    got = run(make_docs(spark, rows))
    assert got == brute(rows)
