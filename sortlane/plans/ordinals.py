"""Positions in a global order, without a window over all rows.

Rows are dealt into ranges of the order and sorted there; a position is the place in the range
plus the rows of the ranges before it. The ranges are stored, so a repeated task gives the same
positions. What the driver sees is one count for each range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.plans.workspace import new_folder

# The place in a partition stands in the low bits of the generated ids.
PLACE_BITS = 33


def with_ordinals(df: DataFrame, order: list, out: str = "ordinal") -> DataFrame:
    """Add 0, 1, ... in the order given; the order must not leave two rows equal."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    path = new_folder(df.sparkSession, "ordinals")
    ranged.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    part = F.shiftright("_id", PLACE_BITS)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        before.append((r["part"], total))
        total += r["n"]
    starts = F.broadcast(df.sparkSession.createDataFrame(before, "_part long, _start long"))
    placed = stored.withColumn("_part", part).join(starts, "_part")
    ordinal = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn(out, ordinal).drop("_part", "_start", "_id")
