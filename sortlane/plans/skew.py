"""Left joins to a lookup with unique keys that stay balanced when a key is hot.

A key that holds a large share of the wide side would put all its rows into one task. Such
keys are few by definition - at most 1 / share of them - so they are found on a sample, their
lookup rows are copied once per salt, and their wide rows are spread over the salts. The
sample decides only how rows are spread, never which rows or values come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.001
SAMPLE = 0.01
MIN_SAMPLED = 100
SALTS = 256


def hot_keys(
    df: DataFrame,
    key: Column,
    share: float = SHARE,
    sample: float = SAMPLE,
    min_sampled: int = MIN_SAMPLED,
) -> list:
    """Keys with more than ``share`` of the (sampled) rows; at most 1 / share of them.

    The rows are sampled before the key is computed, which may be costly.
    """
    rows = df.sample(sample, seed=7) if sample < 1 else df
    keys = rows.select(key.alias("key")).filter(F.col("key").isNotNull())
    counts = keys.groupBy("key").agg(F.count("*").alias("n"))
    frequent = counts.filter(F.col("n") >= min_sampled)
    total = counts.agg(F.sum("n") * F.lit(share))
    return [r[0] for r in frequent.filter(F.col("n") > total.scalar()).select("key").collect()]


def left_join_unique(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    spread: str,
    hot: list | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join to ``lookup``, whose keys are unique.

    ``spread`` is a column that differs between the rows of one key, such as a row id.
    """
    if hot is None:
        hot = hot_keys(df, F.col(on))
    if not hot:
        return df.join(lookup, on, "left")
    is_hot = F.col(on).isin(hot)
    one = F.lit(0)
    salted = df.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(one)
    )
    copies = F.when(is_hot, F.sequence(one, F.lit(salts - 1))).otherwise(F.array(one))
    copied = lookup.withColumn("_salt", F.explode(copies))
    return salted.join(copied, [on, "_salt"], "left").drop("_salt")
