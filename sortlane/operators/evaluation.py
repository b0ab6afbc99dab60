"""Evaluation of predictions: everything follows from two small counts.

A frame of predictions holds the truth ``y``, the prediction ``p`` and its confidence
``conf``, optionally a grouping column such as the head. It is read once per report: into
counts by (truth, prediction) or into counts by confidence step. Reports work on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.rules import labels as fixed


def confusion_counts(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """Non-zero cells: (*by, y, p, n)."""
    keys = [*(by or []), F.col(y).alias("y"), F.col(p).alias("p")]
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """All cells in long form, zeros included."""
    cells = confusion_counts(df, y, p)
    classes = cells.select(F.explode(F.array("y", "p")).alias("c")).distinct()
    # One row with the list of classes, crossed in memory: classes are few, rows are not.
    grid = classes.agg(F.array_sort(F.collect_set("c")).alias("cs"))
    pairs = grid.select(F.explode("cs").alias("y"), "cs").select("y", F.explode("cs").alias("p"))
    return pairs.join(cells, ["y", "p"], "left").select(
        "y", "p", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def class_totals(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per class: support (truth), predicted and hits, from confusion counts."""
    by = by or []
    sides = F.array(
        F.struct(
            F.col("y").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("p").alias("label"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    return (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, zero where b is zero."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_scores(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    totals = class_totals(cells, by)
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.withColumns(
        {
            "precision": _ratio(hits, predicted),
            "recall": _ratio(hits, support),
            "f1": _ratio(2 * hits, support + predicted),
        }
    )


def head_metrics(
    df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None
) -> DataFrame:
    """Rows, classes, accuracy, macro F1, kappa, majority baseline and lift, one row per group.

    Accuracy, baseline and F1 are percentages, lift is in percentage points.
    """
    by = by or []
    scores = class_scores(confusion_counts(df, y, p, by), by)
    n, hits = F.sum("support"), F.sum("hits")
    chance = F.sum(F.col("support") * F.col("predicted"))
    summary = scores.groupBy(*by).agg(
        n.alias("n"),
        F.count_if(F.col("support") > 0).alias("classes"),
        (hits / n).alias("_po"),
        (chance / (n * n)).alias("_pe"),
        (100 * F.avg("f1")).alias("macro_f1"),
        (100.0 * F.max("support") / n).alias("baseline"),
    )
    accuracy = 100 * F.col("_po")
    return summary.select(
        *by,
        F.col("n").alias("n_rows"),
        "classes",
        F.round(accuracy, 6).alias("accuracy"),
        F.round("macro_f1", 6).alias("macro_f1"),
        F.round(
            F.when(F.col("_pe") < 1, (F.col("_po") - F.col("_pe")) / (1 - F.col("_pe"))), 6
        ).alias("kappa"),
        F.round("baseline", 6).alias("baseline"),
        F.round(accuracy - F.col("baseline"), 6).alias("lift"),
    )


def classification_report(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Scores per class, then the accuracy, macro and weighted average rows."""
    scores = class_scores(confusion_counts(df, y, p))
    label = F.col("label").cast("string")
    per_class = scores.select(label.alias("label"), "precision", "recall", "f1", "support")
    support = F.col("support")
    totals = per_class.agg(
        F.sum(F.col("recall") * support).alias("hits"),
        F.sum("support").alias("n"),
        *[F.avg(c).alias("m_" + c) for c in ("precision", "recall", "f1")],
        *[
            (F.sum(F.col(c) * support) / F.sum("support")).alias("w_" + c)
            for c in ("precision", "recall", "f1")
        ],
    )
    accuracy = F.col("hits") / F.col("n")
    nothing = F.lit(None).cast("double")

    def row(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("n").alias("support"),
        )

    averages = totals.select(
        F.inline(
            F.array(
                row("accuracy", nothing, nothing, accuracy),
                row("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1")),
                row("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1")),
            )
        )
    )
    report = per_class.unionByName(averages)
    return report.select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def majority_baseline(df: DataFrame, label: str = "y") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("n_rows"),
        F.max("n").alias("largest_class"),
        F.round(100.0 * F.max("n") / F.sum("n"), 6).alias("baseline"),
    )


def _cut(step: Column) -> Column:
    """Confidence of a step of the gate grid, the double nearest to its three decimals."""
    return (fixed.GATE_FIRST_MILLI + fixed.GATE_STEP_MILLI * step) / F.lit(1000.0)


def _last_cut_reached(conf: Column) -> Column:
    """Highest step whose cut the confidence reaches; -1 below the first.

    The arithmetic guess can be one off next to a cut, so its neighbours are compared.
    """
    per_unit = 1000 // fixed.GATE_STEP_MILLI
    guess = F.floor(conf * per_unit).cast("int") - fixed.GATE_FIRST_MILLI // fixed.GATE_STEP_MILLI
    exact = (
        F.when(conf >= _cut(guess + 1), guess + 1).when(conf < _cut(guess), guess - 1).otherwise(guess)
    )
    return F.greatest(F.least(exact, F.lit(fixed.GATE_CUTS - 1)), F.lit(-1))


def gate_curve(
    df: DataFrame, y: str = "y", p: str = "p", conf: str = "conf", by: list[str] | None = None
) -> DataFrame:
    """Rows kept, precision and coverage at each of the 160 cuts.

    Rows are counted by the last cut they reach, at most 161 counts per group, and the counts
    are summed from the top down.
    """
    by = by or []
    counts = (
        df.select(
            *by,
            _last_cut_reached(F.col(conf)).alias("step"),
            (F.col(y) == F.col(p)).cast("long").alias("ok"),
        )
        .groupBy(*by, "step")
        .agg(F.count("*").alias("n"), F.sum("ok").alias("ok"))
    )
    # Every cut is reported, also those where no row falls: an empty count for each.
    steps = F.explode(F.sequence(F.lit(0), F.lit(fixed.GATE_CUTS - 1))).alias("step")
    zero = F.lit(0).cast("long")
    groups = counts.groupBy(*by).agg(F.count("*").alias("_"))
    grid = groups.select(*by, steps, zero.alias("n"), zero.alias("ok"))
    merged = (
        counts.unionByName(grid).groupBy(*by, "step").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))
    )
    group = Window.partitionBy(*by)
    down = group.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    running = merged.withColumns(
        {
            "kept": F.sum("n").over(down),
            "right": F.sum("ok").over(down),
            "total": F.sum("n").over(group),
        }
    )
    return running.filter(F.col("step") >= 0).select(
        *by,
        _cut(F.col("step")).alias("cut"),
        "kept",
        (F.col("right") / F.nullif(F.col("kept"), F.lit(0))).alias("precision"),
        (F.col("kept") / F.col("total")).alias("coverage"),
    )


def find_threshold(
    curve: DataFrame,
    min_rows: int = fixed.MIN_KEPT_OUT_OF_FOLD,
    target: float = fixed.TARGET_PRECISION,
    by: list[str] | None = None,
) -> DataFrame:
    """Lowest cut that reaches the target precision while enough rows are kept.

    The rows kept shrink along the cuts, so "stop at the first cut that keeps too few" is a
    plain condition on the cut itself. No cut: the threshold is null and the head ungatable.
    """
    by = by or []
    reached = (F.col("kept") >= min_rows) & (F.col("precision") >= target)
    first = F.min(F.when(reached, F.struct("cut", "precision", "coverage"))).alias("first")
    found = curve.groupBy(*by).agg(first)
    return found.select(
        *by,
        F.col("first.cut").alias("threshold"),
        F.round(100 * F.col("first.precision"), 6).alias("precision_pct"),
        F.round(100 * F.col("first.coverage"), 6).alias("coverage_pct"),
        F.col("first").isNotNull().alias("gatable"),
    )


def compare_vocabularies(metrics: DataFrame, native: str, merged: str, by: str = "vocabulary") -> DataFrame:
    """Change of accuracy and lift from one label vocabulary to a coarser one.

    Accuracy always rises when classes merge; the lift over the majority class is the fair
    comparison.
    """
    def value(name: str, vocabulary: str) -> Column:
        return F.max(F.when(F.col(by) == vocabulary, F.col(name)))

    paired = metrics.agg(
        value("accuracy", native).alias("native_accuracy"),
        value("accuracy", merged).alias("merged_accuracy"),
        value("lift", native).alias("native_lift"),
        value("lift", merged).alias("merged_lift"),
    )
    return paired.withColumns(
        {
            "accuracy_change": F.round(F.col("merged_accuracy") - F.col("native_accuracy"), 6),
            "lift_change": F.round(F.col("merged_lift") - F.col("native_lift"), 6),
        }
    )
