"""Metrics, gates and splits against direct computation."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sortlane.operators import evaluation as ev
from sortlane.operators import splits

CUTS = [round(0.2 + 0.005 * i, 3) for i in range(160)]


@pytest.fixture(scope="module")
def predictions():
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        # Many confidences lie exactly on a cut or next to one.
        conf = rng.choice([rng.random(), rng.choice(CUTS), math.nextafter(rng.choice(CUTS), 0), 1.0, 0.2, 0.1999])
        y = rng.choice("abcd")
        rows.append((i, y, y if rng.random() < conf else rng.choice("abce"), conf))
    return rows


@pytest.fixture(scope="module")
def frame(spark, predictions):
    return spark.createDataFrame(predictions, "row_id long, y string, p string, conf double")


def test_gate_curve(frame, predictions):
    got = {r.cut: r for r in ev.gate_curve(frame).collect()}
    assert sorted(got) == CUTS
    for cut in CUTS:
        kept = [y == p for _, y, p, c in predictions if c >= cut]
        assert got[cut].kept == len(kept)
        assert got[cut].precision == (sum(kept) / len(kept) if kept else None)
        assert got[cut].coverage == len(kept) / len(predictions)


@pytest.mark.parametrize(("target", "min_rows"), [(0.6, 100), (0.8, 100), (0.8, 900), (1.1, 1)])
def test_threshold_stops_when_too_few_are_kept(frame, predictions, target, min_rows):
    want = None
    for cut in CUTS:
        kept = [y == p for _, y, p, c in predictions if c >= cut]
        if len(kept) < min_rows:
            break
        if sum(kept) / len(kept) >= target:
            want = cut
            break
    got = ev.find_threshold(ev.gate_curve(frame), min_rows, target).first()
    assert (got.threshold, got.gatable) == (want, want is not None)


def test_threshold_by_head(frame):
    both = frame.withColumn("head", F.explode(F.array(F.lit("x"), F.lit("y"))))
    rows = ev.find_threshold(ev.gate_curve(both, by=["head"]), 100, 0.6, by=["head"]).collect()
    alone = ev.find_threshold(ev.gate_curve(frame), 100, 0.6).first()
    assert {(r.head, r.threshold) for r in rows} == {("x", alone.threshold), ("y", alone.threshold)}


def test_metrics(frame, predictions):
    n = len(predictions)
    labels = sorted({y for _, y, _, _ in predictions} | {p for _, _, p, _ in predictions})
    f1, chance = [], 0.0
    for c in labels:
        t = sum(y == c for _, y, _, _ in predictions)
        q = sum(p == c for _, _, p, _ in predictions)
        h = sum(y == p == c for _, y, p, _ in predictions)
        f1.append(2 * h / (t + q) if t + q else 0.0)
        chance += t * q / n / n
    right = sum(y == p for _, y, p, _ in predictions) / n
    got = ev.head_metrics(frame).first()
    assert got.accuracy == pytest.approx(100 * right, abs=1e-6)
    assert got.macro_f1 == pytest.approx(100 * sum(f1) / len(f1), abs=1e-6)
    assert got.kappa == pytest.approx((right - chance) / (1 - chance), abs=1e-6)
    assert got.classes == 4
    matrix = {(r.y, r.p): r.n for r in ev.confusion_matrix(frame).collect()}
    assert len(matrix) == len(labels) ** 2 and sum(matrix.values()) == n
    report = {r.label: r for r in ev.classification_report(frame).collect()}
    assert report["e"].support == 0 and report["e"].recall == 0
    assert report["accuracy"].support == n


def test_one_class_has_no_kappa(spark):
    df = spark.createDataFrame([("a", "a")] * 3, "y string, p string")
    got = ev.head_metrics(df).first()
    assert (got.accuracy, got.kappa, got.lift) == (100.0, None, 0.0)


def test_groups_never_span_folds_or_parts(spark):
    df = spark.range(4000).select("id", F.concat(F.lit("group "), F.col("id") % 700).alias("g"))
    marked = df.withColumns({"fold": splits.fold_of(F.col("g")), "held": splits.held_out(F.col("g"))})
    per_group = marked.groupBy("g").agg(F.count_distinct("fold").alias("f"), F.count_distinct("held").alias("h"))
    assert per_group.filter("f > 1 or h > 1").count() == 0
    folds = {r.fold: r.n for r in marked.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and sum(folds.values()) == 4000
    share = marked.filter("held").count() / 4000
    assert 0.12 < share < 0.28


def test_balanced_weights_sum_to_the_rows(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(100)], "row_id long, y string")
    weighted = splits.balanced_weights(df, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert all(r.w == pytest.approx(50) for r in weighted)
