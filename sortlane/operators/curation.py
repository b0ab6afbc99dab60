"""Corpus curation: language filter, cap per description group, class floors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortlane.functions.text import group_hash, non_english
from sortlane.plans.bounded import keep_members
from sortlane.rules import labels as fixed

SALTS = 256


def drop_non_english(df: DataFrame) -> DataFrame:
    return df.filter(~non_english(F.col("title"), F.col("description")))


def cap_per_group(
    df: DataFrame,
    group: str,
    order: str,
    k: int = fixed.ROWS_PER_GROUP,
    salts: int = SALTS,
) -> DataFrame:
    """Keep the first ``k`` rows of every group in the given order, a unique row id.

    Only (group, id) pairs are ranked, in two rounds: within salted parts of a group, then
    over the at most ``k`` survivors of each part, so no task ever sees a whole large group.
    The wide rows then meet the surviving ids in a semi join on the id, which has no hot
    value: they are moved at most once, and never by group.
    """
    pairs = df.select(F.col(group).alias("_group"), F.col(order).alias(order))
    salted = pairs.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    part = Window.partitionBy("_group", "_salt").orderBy(order)
    whole = Window.partitionBy("_group").orderBy(order)
    survivors = salted.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= k)
    first = survivors.withColumn("_rank", F.row_number().over(whole)).filter(F.col("_rank") <= k)
    return df.join(first.select(order), order, "left_semi")


def curate(df: DataFrame, order: str = "row_id", k: int = fixed.ROWS_PER_GROUP) -> DataFrame:
    """Language filter first, then the cap per description group (``group_hash`` is kept)."""
    english = drop_non_english(df).withColumn("group_hash", group_hash(F.col("description")))
    return cap_per_group(english, "group_hash", order, k)


def class_sizes(df: DataFrame, label: str, floor: int) -> DataFrame:
    """Rows per class and whether the class is too thin to learn."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("n"))
        .withColumn("dropped", F.col("n") < floor)
    )


def class_floor(
    df: DataFrame, label: str, floor: int | None = None, row_id: str = "row_id"
) -> DataFrame:
    """Rows whose class has at least ``floor`` rows; unlabelled rows go too.

    Class counts are combined before the shuffle and the wide rows are filtered in place: with
    a handful of classes, partitioning the rows by class would use a handful of tasks.
    """
    if floor is None:
        floor = fixed.CLASS_FLOOR.get(label, fixed.DEFAULT_CLASS_FLOOR)
    learnable = class_sizes(df, label, floor).filter(~F.col("dropped")).select(label)
    return keep_members(df, label, learnable, row_id)
