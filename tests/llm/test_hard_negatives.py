"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.llm import hard_negatives as hn
from auditloom.llm.common import ready

SCHEMA = "vec_id long, embedding array<float>, label int, number string"


def expected(rows, positives=5, negatives=3):
    """By all pairs; a row is (id, vector, label)."""
    def whole(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    use = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], lab)
           for i, v, lab in rows if i is not None and lab is not None and whole(v)]
    out = []
    for at, (i, v, lab) in enumerate(use):
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other == lab)
                  for k, (j, w, other) in enumerate(use) if k != at and len(w) == len(v)]
        same = sorted((s, j) for s, j, m in scored if m)[:positives]
        others = sorted((s, j) for s, j, m in scored if not m)
        for p, pid in same:
            fit = [(s, j) for s, j in others if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, pid, r, j, -p, -s) for r, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = hn.hard_negatives(ready(spark) and df, F.col("id") % 50 == 0, **more)
    return sorted(tuple(r) for r in got.collect())


def vectors(seed, count, dim):
    made = np.random.default_rng(seed)
    centres = made.normal(size=(6, dim))
    return [(i, [float(x) for x in centres[i % 6] * 0.4 + made.normal(size=dim) * 0.3], int(made.integers(4)))
            for i in range(count)]


@pytest.mark.parametrize("dim", [1, 7, 64])
def test_equals_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(hn, "ROWS_AT_ONCE", 64)
    monkeypatch.setattr(hn, "ROW_BLOCK", 150)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 4)
    rows = vectors(dim, 400, dim)
    got = found(spark, rows)
    assert got == expected(rows) and (dim == 1 or got)


@pytest.mark.parametrize("dense", [0.0, 2.0])
def test_sparse_and_dense_steps_agree(spark, monkeypatch, dense):
    monkeypatch.setattr(hn, "DENSE", dense)
    rows = vectors(2, 200, 20)
    assert found(spark, rows) == expected(rows)


def test_edges(spark):
    """Nulls, non-finite components, other lengths, shared ids, ties, a zero vector and empty ones."""
    picked = random.Random(4)
    rows = [(i, [picked.choice([-0.5, 0.0, 0.5]) for _ in range(3)], i % 3) for i in range(60)]
    rows += [(0, [0.5, 0.5, 0.0], 0), (0, [0.5, 0.5, 0.0], 0), (0, [0.5, 0.5, 0.0], 1), (50, [0.0] * 3, 0)]
    rows += [(100, None, 1), (100, [1.0, None, 0.0], 1), (100, [1.0, float("nan"), 0.0], 1), (100, [float("inf")], 1)]
    rows += [(None, [0.5, 0.5, 0.5], 0), (150, [0.5, 0.5, 0.5], None)]
    rows += [(150, [0.5, 0.5], 0), (3, [0.5, 0.5], 0), (4, [0.5, 0.2], 1), (200, [], 0), (5, [], 0), (6, [], 1)]
    assert found(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_too_large_components(spark):
    rows = [(50, [1e30, 1.0], 0), (1, [1e30, 1.0], 0)]
    with pytest.raises(Exception, match="too large"):
        found(spark, rows)


def test_bounds_hold():
    made = np.random.default_rng(1)
    a, b = np.floor(made.normal(size=(40, 37)) * 90), np.floor(made.normal(size=(50, 37)) * 90)
    fine = hn.segment_summaries(a), hn.segment_summaries(b)
    coarse = [hn.joined_summaries(*s) for s in fine]
    widths = []
    for (am, ad), (bm, bd) in (coarse, fine):
        middle, width = am @ bm.T, ad @ bd.T
        assert (np.abs(a @ b.T - middle) <= width + 1e-6).all()
        widths.append(width.mean())
    assert widths[1] < widths[0]
