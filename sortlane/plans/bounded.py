"""Size checks that decide between a map-side lookup and a shuffled join.

The optimiser sizes an aggregate by its input, so on a large input it would shuffle the wide
side to meet a lookup of a few rows. Where a lookup is expected to be small it is counted
first, and only a table that really is small is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sortlane.plans.skew import left_join_unique

SMALL_TABLE_ROWS = 10_000


def small_rows(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> list[Row] | None:
    """All rows of ``df`` if there are at most ``limit``, else None. Reads limit + 1 rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def keep_members(df: DataFrame, column: str, members: DataFrame, spread: str) -> DataFrame:
    """Rows whose value is listed in ``members`` (one column of distinct values)."""
    rows = small_rows(members)
    if rows is not None:
        return df.filter(F.col(column).isin([r[0] for r in rows]))
    marked = members.withColumn("_member", F.lit(True))
    return left_join_unique(df, marked, column, spread).filter("_member").drop("_member")


def lookup_join(df: DataFrame, lookup: DataFrame, on: str, spread: str) -> DataFrame:
    """Left join to a lookup with unique keys, map-side when the lookup is small."""
    rows = small_rows(lookup)
    if rows is None:
        return left_join_unique(df, lookup, on, spread)
    small = df.sparkSession.createDataFrame(rows, lookup.schema)
    return df.join(F.broadcast(small), on, "left")


def value_counts(df: DataFrame, columns: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Count of every value of several columns in one pass: (column_name, value, n).

    The rows are unpivoted before a partial aggregate, so what is shuffled is one row per
    task and distinct value, however often a value occurs.
    """
    extra = extra or []
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    long = df.select(*extra, F.inline(pairs))
    return long.groupBy(*long.columns).agg(F.count("*").alias("n"))
