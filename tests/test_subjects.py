"""Subjects of a document unified by shared identities, folded and contracted, against a plain union of rows."""

import random

from evidentia.operators import library

SCHEMA = "row_id long, doc long, machine int, maker string, name string"


def unified(rows):
    """(doc, subject) -> machine, maker, name, n_rows, conflict, row by row."""
    group = {r[0]: r[0] for r in rows}
    for _ in rows:
        for a in rows:
            for b in rows:
                if a[1] is not None and a[1] == b[1] and (a[0] == b[0] or any(x is not None and x == y for x, y in zip(a[2:4], b[2:4]))):
                    group[a[0]] = group[b[0]] = min(group[a[0]], group[b[0]])
    out = {}
    for key in {(r[1], group[r[0]]) for r in rows}:
        own = sorted(r for r in rows if (r[1], group[r[0]]) == key)
        first = [next((r[c] for r in own if r[c] is not None), None) for c in (2, 3, 4)]
        out[key] = (*first, len(own), any(len({r[c] for r in own} - {None}) > 1 for c in (2, 3)))
    return out


def test_subjects_are_the_same_folded_and_contracted(spark):
    rng = random.Random(7)
    some = lambda values: rng.choice([None, *values])
    rows = [(n, some([1, 2, 3]), some(range(9)), some("abcdefgh"), some("xy")) for n in range(70)]
    rows += [(n, rows[n][1], 2, None, None) for n in range(3)]  # ids that repeat are one row
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = unified(rows)
    for fold in (64, 1):
        got = library.unify_subjects(frame, "doc", ["machine", "maker"], ["name"], fold=fold).collect()
        assert {(r.doc, r.subject): (r.machine, r.maker, r.name, r.n_rows, r.conflict) for r in got} == expected
    assert library.unify_subjects(frame.limit(0), "doc", ["machine", "maker"], []).count() == 0
