"""Even folds and exact parts: against one-by-one dealing, and their sizes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sortlane.operators.splits import balanced_folds, exact_quota, greedy_segments
from sortlane.plans.ordinals import with_ordinals


def dealt_one_by_one(histogram, folds):
    loads, out = [0] * folds, []
    for size, groups in histogram:
        for _ in range(groups):
            f = min(range(folds), key=lambda f: (loads[f], f))
            loads[f] += size
            out.append(f)
    return out, loads


def test_segments_equal_dealing_one_by_one():
    rng = np.random.default_rng(6)
    for trial in range(200):
        sizes = sorted(set(rng.integers(1, [4, 40, 3000][trial % 3], 6).tolist()), reverse=True)
        histogram = [(s, int(rng.integers(1, 30))) for s in sizes]
        folds = int(rng.integers(1, 7))
        want, loads = dealt_one_by_one(histogram, folds)
        got, place = [], 0
        for size, start, length, order in greedy_segments(histogram, folds):
            got += [order[i % len(order)] for i in range(length)]
            place += length
        assert got == want and max(loads) - min(loads) <= sizes[0]


def test_segments_stay_few():
    assert len(greedy_segments([(10**9, 1), (1, 10**10)], 5)) < 10


def test_folds_are_even_and_disjoint(spark):
    groups = [f"g{i}" for i in range(150) for _ in range(1 + (i % 7) ** 2)] + ["hot"] * 300
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "row_id long, group string").repartition(4)
    rows = balanced_folds(df).collect()
    assert sorted(r.row_id for r in rows) == list(range(len(groups)))
    of = {}
    for r in rows:
        of.setdefault(r.group, set()).add(r.fold)
    assert all(len(f) == 1 for f in of.values())
    sizes = np.bincount([r.fold for r in rows], minlength=5)
    assert sizes.max() - sizes.min() <= 300 and balanced_folds(df.limit(0)).count() == 0


def test_quota_is_exact(spark):
    df = spark.createDataFrame([(i, f"g{i % 137}") for i in range(900)], "row_id long, group string").repartition(5)
    rows = exact_quota(df).collect()
    assert len(rows) == 900 and len({r.group for r in rows if r.held_out}) == 27
    assert not {r.group for r in rows if r.held_out} & {r.group for r in rows if not r.held_out}
    assert exact_quota(df.limit(0)).count() == 0


def test_ordinals_follow_the_order(spark):
    df = spark.range(5000).withColumn("key", F.xxhash64("id")).repartition(7)
    rows = sorted(with_ordinals(df, [F.desc("key")]).collect(), key=lambda r: -r.key)
    assert [r.ordinal for r in rows] == list(range(5000))
