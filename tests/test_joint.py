"""Fits that share a task: the same optimum as alone, one pass over the terms, nothing fitted in vain."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sortlane.operators import heads, joint, svm


def test_fits_of_a_block_reach_what_they_reach_alone():
    rng = np.random.default_rng(3)
    idx = [np.unique(rng.integers(0, 40, 8)) for _ in range(200)]
    tf = [1 + np.log(rng.integers(1, 4, len(i))) for i in idx]
    idx[5], tf[5] = idx[5][:0], tf[5][:0]
    table = pa.table({"idx": pa.array(idx, pa.list_(pa.int32())), "tf": pa.array(tf, pa.list_(pa.float32()))})
    idf = rng.uniform(1, 3, (40, 2))
    idf[rng.random((40, 2)) < 0.2] = 0
    y, split = rng.integers(0, 2, 200), np.arange(200) % 3
    signs, costs = svm.problem(y, np.ones(200, bool), split, np.full((3, 2), 2.0), np.full((3, 2), 2.0))

    def reached(idf, signs, costs, owner):
        block = svm.Block(table, idf, 0, owner)
        w, a, _ = svm.ascend(block, signs, costs, np.zeros((len(block.features), signs.shape[1])), np.zeros(signs.shape), 1, 1e-4)
        margins = np.concatenate([m for _, _, m in block.forward(w)])
        return svm.objectives(w, margins, signs, costs), margins

    both, margins = reached(idf, np.tile(signs, 2), np.tile(costs, 2), np.repeat([0, 1], 6))
    for f in range(2):
        alone, own = reached(idf[:, f], signs, costs, None)
        assert np.allclose(both[6 * f : 6 * f + 6], alone, rtol=2e-4)
        assert np.allclose(margins[:, 6 * f : 6 * f + 6], own, atol=0.05)
    # The second of two classes is the first with all signs turned.
    assert np.array_equal(margins[:, 0], -margins[:, 1])


def test_neighbouring_fits_share_a_party():
    fits = [svm.Fit(i, i // 6, "fold", i % 6, 3) for i in range(30)]
    found = svm.parties(fits, 3, 8)
    assert found == sorted(found) and set(found) == set(range(8)) and max(np.bincount(found)) <= 4
    assert svm.parties(fits[:2], 3, 8) == [0, 1]


def test_vocabularies_count_terms_once(spark):
    rows = [(["a", "b", "a"], [0, 1], 0, False), (["b", "c"], [0, -1], 1, True), (["a", "b"], [1, 0], 1, False), (None, [1, -1], 0, True), ([], [-1, 0], 0, False)]
    df = spark.createDataFrame(rows, "terms array<string>, y array<int>, fold int, held_out boolean")
    fits = [svm.Fit(0, 0, "fold", 0, 2), svm.Fit(1, 0, "gate", -1, 2), svm.Fit(2, 0, "final", -1, 2), svm.Fit(3, 1, "final", -1, 2)]
    plan = joint._counted_cells(df.withColumn("mask", F.lit(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    terms, idf = joint.vocabularies(df, fits, [2, 2, 4, 3], 1, 10)
    assert terms == ["a", "b", "c"]
    df_of = [[1, 2, 1], [2, 2, 0], [2, 3, 1], [2, 2, 0]]
    for f, (n, counts) in enumerate(zip([2, 2, 4, 3], df_of)):
        assert [x == 0 for x in idf[:, f]] == [c == 0 for c in counts]
        assert [x for x in idf[:, f] if x] == pytest.approx([np.log((1 + n) / (1 + c)) + 1 for c in counts if c])


def test_no_final_fit_where_only_folds_are_asked_and_one_model_scores_all_splits(spark):
    rows = [(i, f"g{i}", ["red", "rose"] if i % 2 else ["steel", f"w{i % 5}"], "ab"[i % 2]) for i in range(80)]
    df = spark.createDataFrame(rows, "row_id long, group string, terms array<string>, label string").coalesce(2)
    spec = heads.HeadSpec("letter", "label", floor=5, learner="svm", folds=2, separate_gate=False, min_kept=20)
    fits = joint.fit_jointly(df, [spec], final=False)
    assert {f.kind for f in fits.fits} == {"fold"}
    assert sorted(r.row_id for r in fits.predictions.select("row_id").collect()) == list(range(80))
    head = heads.train_heads(df, [spec], stored=True)["letter"]
    assert len(head.members) == 1 and len(head.members[0].sigmoids) == 6
    scored = heads.score(df, head)
    assert scored.filter("top1 = label AND top2 <> top1 AND conf BETWEEN 0.5 AND 1").count() == 80


def test_a_block_alone_goes_on_from_its_duals(monkeypatch):
    """A task that ends at the limit of passes is called again, with what it left."""
    monkeypatch.setattr(svm, "MOST_PASSES", 2)
    rng = np.random.default_rng(4)
    n, idx = 120, [np.unique(rng.integers(0, 30, 6)).tolist() for _ in range(120)]
    facts = {"row_id": pa.array(range(n)), "fold": pa.array([0] * n, pa.int32()), "held_out": pa.array([False] * n)}
    for name, values in (("y", rng.integers(0, 3, n)), ("split", np.arange(n) % 3)):
        facts[name] = pa.array([[int(v)] for v in values], pa.list_(pa.int32()))
    facts |= {"emb": pa.array([[]] * n, pa.list_(pa.float32())), "size": pa.array([len(i) for i in idx], pa.int32())}
    flat = np.concatenate(idx).astype("<u2")
    values = {"block": [0], "rows": [svm._bytes(pa.record_batch(facts))], "idx": [flat.tobytes()], "tf": [svm._levels(np.ones(len(flat), np.float32))], "party": [0]}
    fit = svm.Fit(0, 0, "final", -1, 3)
    task = svm.Problem([fit], [0], {0: (np.full((3, 3), 50.0), np.full((3, 3), 50.0))}, 0, 30, True, 1, 1e-4)
    weights = svm._state_rows([(0, 0, "idf", 0, None, np.ones(30).tobytes())])
    state, duals = weights, []
    for _ in range(3):
        out = task.solve(pa.table(values), state)
        found = {k: np.frombuffer(p, "<f8") for k, p in zip(out["kind"].to_pylist(), out["payload"].to_pylist()) if k in ("sum", "norm")}
        duals.append(found["sum"] - 0.5 * found["norm"])
        kept = [k in ("w", "dual") for k in out["kind"].to_pylist()]
        state = pa.concat_tables([weights, out.filter(pa.array(kept))])
    assert (duals[1] > duals[0]).all() and (duals[2] > duals[1]).all()
