"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from rivermark.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, score int, query int"


def expected(rows, anchor):
    sound = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = sorted({(i, g, tuple(math.floor(256 * x) for x in v)) for i, g, v in rows if None not in (i, g) and sound(v)}, key=repr)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, g, v in kept:
        if not anchor(i):
            continue
        scored = [(-dot(v, w), j, h) for j, h, w in kept]
        for p, j, _ in sorted((s, j, h) for s, j, h in scored if h == g and j != i)[:5]:
            best = sorted((s, k) for s, k, h in scored if h != g and 50 * -p <= 100 * -s <= 95 * -p)[:3]
            out += [(i, j, n, k, -p, -s) for n, (s, k) in enumerate(best, 1)]
    return sorted(out)


def made(seed, count, width=7, spread=4):
    random.seed(seed)
    centres = [[random.uniform(-1, 1) for _ in range(width)] for _ in range(spread)]
    near = lambda c: [x + random.gauss(0, 0.3) for x in c]
    return [(n, random.randrange(3), near(random.choice(centres))) for n in range(count)]


def check(spark, rows, anchor="id % 5 = 0", test=lambda i: i % 5 == 0):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(4)
    got = hard_negatives.hard_negatives(frame, F.expr(anchor))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, test)


@pytest.mark.parametrize("width", [1, 7, 33])
def test_equals_brute_force(spark, width):
    check(spark, made(width, 300, width))


def test_ties_copies_and_odd_rows(spark):
    rows = made(2, 120)
    same = [(1000 + n, n % 3, [0.5] * 7) for n in range(60)]  # one common vector
    odd = [(5, None, [1.0] * 7), (None, 1, [1.0] * 7), (15, 1, None), (25, 1, [None, 1.0]), (35, 1, [math.nan]), (45, 1, [math.inf])]
    short = [(2000, 1, [0.9]), (2005, 1, []), (2010, 2, [0.9, 0.1])]
    several = [(10, rows[10][1], [0.4] * 7), (10, (rows[10][1] + 1) % 3, [0.4] * 7), (3000, 7, [0.1] * 7)]
    check(spark, rows + rows[:30] + same + odd + short + several)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "PAIRS", 50)
    check(spark, made(4, 200))


def test_nothing_to_do(spark):
    check(spark, [])
    check(spark, [(1, 1, [1.0]), (2, 1, [1.0])], "id = 1", lambda i: i == 1)


def test_bounds_hold_on_every_level():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-300, 300, (20, 64)), rng.integers(-300, 300, (30, 64))
    exact = a @ b.T
    widths = []
    for (m, d), (n, e) in zip(*(hard_negatives.levels(*hard_negatives.summaries(x, 16)) for x in (a, b))):
        length = 64 // m.shape[1]
        centre, radius = length * m @ n.T, length * d @ e.T
        assert (abs(exact - centre) <= radius + 1e-6).all()
        widths.append((m.shape[1], radius.mean()))
    assert [w for w, _ in widths] == [1, 4, 16] and widths[0][1] > widths[1][1] > widths[2][1]
    whole = hard_negatives.summaries(a, 4)
    assert np.allclose(hard_negatives.coarser(*hard_negatives.summaries(a, 16)), whole)


def test_entries_are_compared_in_parts_and_scored_exactly(monkeypatch):
    rng = np.random.default_rng(7)
    seen, whole = [], hard_negatives.candidates
    monkeypatch.setattr(hard_negatives, "candidates", lambda *a: seen.append(len(a[3])) or whole(*a))
    for size in (300, 2**28):  # sums that doubles hold, and others
        queries, matrix = rng.integers(-size, size, (9, 32)), rng.integers(-size, size, (5000, 32))
        block = hard_negatives.Block(np.arange(9), queries, [1] * 9, np.full(9, hard_negatives.NOTHING), 6)
        lists = [pa.array(list(x)) for x in (matrix, *hard_negatives.summaries(matrix, hard_negatives.FINEST))]
        ids = pa.array([[n] for n in range(5000)])
        batch = pa.RecordBatch.from_arrays(
            [lists[0], pa.array([1] * 5000), ids, *lists[1:]], names=["vector", "label", "ids", "means", "deviations"]
        )
        shared = type("Shared", (), {"value": block})
        (got,) = hard_negatives.scan(shared)([batch])
        exact = queries @ matrix.T
        want = sorted((q, int(exact[q, n]), int(n)) for q in range(9) for n in np.argsort(-exact[q], kind="stable")[:6])
        assert sorted(zip(*(got.column(c).to_pylist() for c in ("query", "score", "id")))) == want
    assert max(seen) <= hard_negatives.ROWS[1] and seen[0] == hard_negatives.ROWS[0]
