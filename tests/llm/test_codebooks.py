"""Vector codes against plain Lloyd rounds in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from erascore.llm import codebooks


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label), by vec_id; plain Lloyd with full scans."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts if kept else 0
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def scan(c, p):
        return min((sum((x - y) ** 2 for x, y in zip(c, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(scan(c[p], p)[1], []).append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(m[j] for m in members) // len(members) for j in range(width)]
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [scan(c[p], p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    totals = {}
    for *_, e, label in out:
        totals[label] = totals.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label], digest) for i, c, e, label in out), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def check(spark, rows, parts=4, entries=8, rounds=4):
    got = codebooks.code_report(frame(spark, rows), parts, entries, rounds).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, parts, entries, rounds)


def test_many_vectors_with_hot_values(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        v = [0.25] * 16 if i % 3 == 0 else (rng.integers(-6, 6, 16) / 5).astype(np.float32).tolist()
        rows.append((i * 7, [float(np.float32(x)) for x in v], None if i % 5 == 0 else i % 4))
    check(spark, rows)
    check(spark, rows, entries=256, rounds=2)
    check(spark, rows, rounds=0)


def test_unusable_vectors_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 2.0, 3.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [0.0, inf, 0.0, 0.0], 1), (5, [0.0, -inf, 0.0, 0.0], None),
            (6, [-0.5, 0.1, -0.0, 1.0], None), (7, [-0.5, 0.2, 0.5, 1.0], 2), (8, [-0.5, 0.2, 0.5, 1.0], None)]
    check(spark, rows, entries=2)
    check(spark, rows[:5])


def test_empty_table_and_fewer_vectors_than_entries(spark):
    assert codebooks.code_report(frame(spark, [(1, [1.0], 1)]).limit(0)).count() == 0
    check(spark, [(3, [0.5] * 8, 1), (9, [1.5] * 8, 1)], entries=256)


def test_repeated_and_null_ids(spark):
    rows = [(None, [0.1, 0.2, 0.3, 0.4], 1), (5, [0.3, 0.2, 0.3, 0.4], 1), (5, [0.1, 0.9, 0.3, 0.4], 2), (5, [0.1, 0.9, 0.3, 0.4], 2)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    got = codebooks.code_report(frame(spark, rows), 4, 2, 4).collect()
    want = brute([rows[2], rows[3], rows[1], rows[0]], 4, 2, 4)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_another_length_keeps_its_row(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 4, 1)]
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in codebooks.code_report(frame(spark, rows), 4, 2, 1).collect()}
    assert got[3] == (None, None, 0) and got[1] == ("00000000", 0, 0) and got[2] == ("01010101", 0, 0)


def test_refusals(spark):
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.code_report(frame(spark, [(1, [0.5] * 6, 1)]))
    with pytest.raises(ValueError, match="does not fit"):
        codebooks.code_report(frame(spark, [(1, [3e38] * 4, 1)]))


@given(st.data())
@settings(max_examples=200, deadline=None)
def test_reassigning_equals_a_full_scan(data):
    small = st.integers(-3, 3)
    k = data.draw(st.integers(1, 6))
    points = np.array(data.draw(st.lists(st.tuples(small, small), min_size=1, max_size=12)), np.int64)
    old = np.array(data.draw(st.lists(st.tuples(small, small), min_size=k, max_size=k)), np.int64)
    code, dist = codebooks.nearest(points, old)
    new = old.copy()
    for e in data.draw(st.sets(st.integers(0, k - 1))):
        new[e] = data.draw(st.tuples(small, small))
    moved = np.flatnonzero((new != old).any(axis=1))
    got = codebooks.reassign(points, new, moved, code, dist)
    want = codebooks.nearest(points, new)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_large_components_stay_exact():
    points = np.array([[2**28, -2**28], [2**28 + 1, 3]], np.int64)
    entries = np.array([[2**28 - 1, -2**28], [2**28, 4]], np.int64)
    code, dist = codebooks.nearest(points, entries)
    assert code.tolist() == [0, 1] and dist.tolist() == [1, 2]
