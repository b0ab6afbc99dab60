"""Group-disjoint splits and class weights.

A group is assigned by its own hash: no state, no ordering, no shuffle, and the same group
always lands on the same side, in a rerun after a lost executor too. Where sizes must be exact,
groups are ranked instead: ``balanced_folds`` deals them out by size, ``exact_quota`` takes an
exact number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.plans.bounded import lookup_join
from sortlane.plans.ordinals import with_ordinals
from sortlane.plans.skew import left_join_unique
from sortlane.plans.workspace import materialise
from sortlane.rules import labels as fixed


def _hash_part(text: Column, start: int) -> Column:
    """Eight hex digits of the group's md5 as a number."""
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("long")


def fold_of(group: Column, folds: int = fixed.FOLDS) -> Column:
    """Fold 0..folds-1 of a group key (text or bytes)."""
    return F.pmod(_hash_part(group, 1), F.lit(folds)).cast("int")


def held_out(
    group: Column,
    fraction: float = fixed.CALIBRATION_FRACTION,
    seed: int = fixed.SPLIT_SEED,
) -> Column:
    """Whether a group belongs to the part on which thresholds are set."""
    seeded = F.concat(F.lit(f"{seed}:").cast("binary"), group.cast("binary"))
    return _hash_part(seeded, 9) < int(fraction * 16**8)


def calibration_usable(df: DataFrame, label: str, held: str, classes: int, min_rows: int = fixed.MIN_CALIBRATION_ROWS) -> DataFrame:
    """Whether the held-out part is large enough and the rest still has every class."""
    counts = df.groupBy(held, label).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col(held), F.col("n"))), F.lit(0)).alias("held_out_rows"),
        F.count_if(~F.col(held)).alias("classes_left"),
    ).withColumn(
        "usable", (F.col("held_out_rows") >= min_rows) & (F.col("classes_left") == classes)
    )


def balanced_weights(
    df: DataFrame, label: str, out: str = "weight", row_id: str = "row_id"
) -> DataFrame:
    """Weight n / (k * n_c): every class weighs the same in total."""
    return lookup_join(df, class_weights(df, label, out), label, row_id)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    per_class = counts.agg(F.sum("_n") / F.count("*"))
    return counts.select(label, (per_class.scalar() / F.col("_n")).alias(out))


def greedy_segments(histogram: list[tuple[int, int]], folds: int) -> list[tuple[int, int, int, list[int]]]:
    """(size, start, length, order): which folds the groups of a size go to, by their rank.

    ``histogram`` is (size, groups) from the largest size down. Groups go to the lightest fold,
    the lower number on a tie, one after the other. Folds that are less than one group apart take
    turns until they reach the next heavier fold, so a size needs a few segments however many
    groups it has: ranks start, ..., start + length - 1 go round the folds of ``order``.
    """
    loads, out = [0] * folds, []
    for size, groups in histogram:
        rank = 0
        while rank < groups:
            ranked = sorted(range(folds), key=lambda f: (loads[f], f))
            lightest = loads[ranked[0]]
            order = [f for f in ranked if loads[f] < lightest + size]
            left = groups - rank
            turns = -(-left // len(order))
            if len(order) < folds:
                turns = min(turns, max(1, (loads[ranked[len(order)]] - lightest) // size))
            length = min(left, turns * len(order))
            out.append((size, rank, length, order))
            for i, f in enumerate(order):
                loads[f] += size * (length // len(order) + (i < length % len(order)))
            rank += length
    return out


def balanced_folds(df: DataFrame, group: str = "group", out: str = "fold", folds: int = fixed.FOLDS, row_id: str = "row_id") -> DataFrame:
    """Add folds that are disjoint by group and as even as greedy dealing makes them.

    Groups are taken from the largest down, equal sizes in the order of their hash; each goes to
    the fold with the fewest rows. Fold sizes differ by no more than the largest group. The
    driver sees the histogram of group sizes: for n rows fewer than sqrt(2 n) sizes.
    """
    spark = df.sparkSession
    sized = materialise(df.groupBy(group).agg(F.count("*").alias("_size")), "group-sizes")
    histogram = [(r["_size"], r["n"]) for r in sized.groupBy("_size").agg(F.count("*").alias("n")).collect()]
    histogram.sort(reverse=True)
    first, before = {}, 0
    for size, n in histogram:
        first[size], before = before, before + n
    segments = [(size, first[size] + start, length, order) for size, start, length, order in greedy_segments(histogram, folds)]
    ranked = with_ordinals(sized.withColumn("_hash", F.md5(F.col(group).cast("binary"))), [F.desc("_size"), F.asc("_hash"), F.asc(group)], "_rank")
    known = F.broadcast(spark.createDataFrame(segments, "_size long, _start long, _length long, _order array<int>"))
    turn = F.col("_rank") - F.col("_start")
    dealt = ranked.join(known, "_size").filter((turn >= 0) & (turn < F.col("_length")))
    lookup = dealt.select(group, F.get("_order", F.pmod(turn, F.size("_order")).cast("int")).alias(out))
    return left_join_unique(df, materialise(lookup, "group-folds"), group, row_id)


def exact_quota(
    df: DataFrame, group: str = "group", out: str = "held_out", fraction: float = fixed.CALIBRATION_FRACTION,
    seed: int = fixed.SPLIT_SEED, row_id: str = "row_id",
) -> DataFrame:
    """Add whether the row's group is one of exactly floor(fraction * groups), those with the least seeded hash."""
    groups = df.select(group).distinct()
    seeded = F.md5(F.concat(F.lit(f"{seed}:").cast("binary"), F.col(group).cast("binary")))
    ranked = with_ordinals(groups.withColumn("_hash", seeded), [F.asc("_hash"), F.asc(group)], "_rank")
    quota = int(fraction * ranked.count() + 1e-9)
    lookup = ranked.select(group, (F.col("_rank") < quota).alias(out))
    return left_join_unique(df, materialise(lookup, "group-quota"), group, row_id)
