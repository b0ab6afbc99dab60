"""Joint squared-hinge fits: against a dense solver, in one block and in several."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest

from sortlane.operators import svm

ROWS, TERMS, DIMENSIONS, CLASSES = 500, 60, 5, 3


def made(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(ROWS):
        y = int(rng.integers(0, CLASSES)) if i % 10 else -1
        favour = rng.integers(0, TERMS // 3, 5) + (TERMS // 3) * max(y, 0)
        idx = np.unique(np.concatenate([favour, rng.integers(0, TERMS, 6)]))
        tf = 1 + np.log(rng.integers(1, 5, len(idx)))
        emb = rng.normal(size=DIMENSIONS) * 0.4
        rows.append((i, idx.tolist(), tf.tolist(), emb.tolist(), i % 5, i % 7 == 0, [y, min(y, 1)], [i % 3, (i // 3) % 3]))
    kind = "row_id long, idx array<int>, tf array<float>, emb array<float>, fold int, held_out boolean, y array<int>, split array<int>"
    idf = rng.uniform(1, 3, (TERMS, 4))
    idf[rng.random((TERMS, 4)) < 0.1] = 0
    return spark.createDataFrame(rows, kind).repartition(3), rows, idf


FITS = [svm.Fit(0, 0, "fold", 2, 3), svm.Fit(1, 0, "gate", -1, 3), svm.Fit(2, 0, "final", -1, 3), svm.Fit(3, 1, "final", -1, 2)]


def costs(scale=1.0):
    rng = np.random.default_rng(1)
    return {f.number: (rng.uniform(1, 4, (3, f.classes)) * scale, np.full((3, f.classes), 2.0 * scale)) for f in FITS}


def dense(rows, idf, fit):
    """Features, classes, split, training flag of the fit's rows."""
    own = [r for r in rows if r[6][fit.head] >= 0]
    x = np.zeros((len(own), TERMS + DIMENSIONS + 1))
    for k, r in enumerate(own):
        x[k, r[1]] = np.float32(r[2]) * idf[r[1], fit.number]
        x[k, :TERMS] /= max(np.linalg.norm(x[k, :TERMS]), 1e-300)
        x[k, TERMS:-1], x[k, -1] = np.float32(r[3]), 1
    y, split = np.array([r[6][fit.head] for r in own]), np.array([r[7][fit.head] for r in own])
    train = np.array([r[4] != fit.fold if fit.kind == "fold" else not r[5] if fit.kind == "gate" else True for r in own])
    return own, x, y, split, train


def newton(x, sign, cost):
    """The least objective by Newton's method with halved steps, on a dense matrix."""
    w = np.zeros(x.shape[1])
    value = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - sign * (x @ v)) ** 2).sum()
    for _ in range(100):
        slack = np.maximum(0, 1 - sign * (x @ w))
        on = slack > 0
        grad = w - 2 * x.T @ (cost * sign * slack)
        step = np.linalg.solve(np.eye(len(w)) + 2 * (x[on].T * cost[on]) @ x[on], grad)
        size = 1.0
        while value(w - size * step) > value(w) and size > 1e-9:
            size /= 2
        w = w - size * step
        if np.abs(grad).max() < 1e-9:
            break
    return value(w)


@pytest.mark.parametrize(("block_bytes", "tolerance", "scale"), [(1 << 30, 1e-4, 1.0), (20_000, 0.02, 0.02)])
def test_objectives_equal_a_dense_solver(spark, monkeypatch, block_bytes, tolerance, scale):
    monkeypatch.setattr(svm, "BLOCK_BYTES", block_bytes)
    frame, rows, idf = made(spark)
    found = svm.fit_all(frame, FITS, idf, costs(scale), DIMENSIONS, tolerance)
    assert (found.rounds == 1) == (block_bytes == 1 << 30)
    assert all(g.max() <= tolerance and g.min() > -1e-9 for g in found.gap.values())
    margins = {}
    for r in found.margins.collect():
        margins[r.fit, r.row_id] = r
    for fit in FITS:
        own, x, y, split, train = dense(rows, idf, fit)
        signs, weight = svm.problem(y, train, split, *costs(scale)[fit.number])
        w = svm.coefficients(found.state, fit, 3 * fit.classes, x.shape[1])
        for c in range(3 * fit.classes):
            least = newton(x, signs[:, c], weight[:, c])
            assert least * (1 - 1e-9) <= found.objective[fit.number][c] <= least * (1 + tolerance)
        assert np.allclose(svm.objectives(w, x @ w, signs, weight), found.objective[fit.number], rtol=1e-9)
        for k, r in enumerate(own):
            got = margins[fit.number, r[0]]
            assert np.allclose(got.m, x[k] @ w) and (got.y, got.split, got.train) == (y[k], split[k], bool(train[k]))
    assert len(margins) == sum(len(dense(rows, idf, f)[0]) for f in FITS)


def test_a_step_does_not_copy_all_coefficients():
    """Steps over 600 rows with 300,000 features; each copied all of them, 7 MB, before."""
    rows, wide = 600, 500
    idx = [np.arange(i * wide, (i + 1) * wide) for i in range(rows)]
    table = pa.table({"idx": pa.array(idx, pa.list_(pa.int32())), "tf": pa.array([np.ones(wide)] * rows, pa.list_(pa.float32()))})
    block = svm.Block(table, np.ones(rows * wide), 0)
    y = np.arange(rows) % 2
    signs, cost = svm.problem(y, np.ones(rows, bool), np.arange(rows) % 3, np.ones((3, 2)), np.ones((3, 2)))
    began = time.time()
    svm.ascend(block, signs, cost, np.zeros((len(block.features), 6)), np.zeros(signs.shape), 2, 1e-3)
    assert time.time() - began < 6
