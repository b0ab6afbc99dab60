"""Remote mode: the fill step over the whole table and the training label.

The tiers define remote mode differently on purpose; the keyword, override and audit versions
live with their tiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.regex import contains_any, matches_lowered, with_long_text
from sortlane.functions.text import blank_if_null, lowered_text, strip, title_and_text
from sortlane.rules import remote as fixed


def fill_value(remote_flag: Column, text: Column) -> Column:
    """The employer's flag, then the text (lower case), then the default."""
    return (
        F.when(remote_flag, F.lit("Remote"))
        .when(
            contains_any(text, fixed.FILL_REMOTE_NEEDS) & matches_lowered(text, fixed.FILL_REMOTE),
            F.lit("Remote"),
        )
        .when(
            text.contains("hybrid") & matches_lowered(text, fixed.FILL_HYBRID), F.lit("Hybrid")
        )
        .otherwise(F.lit("On-site"))
    )


def fill_remote_mode(jobs: DataFrame) -> DataFrame:
    """Every null remote mode gets a value; the text is looked at for those rows only."""
    missing = F.col("remote_mode").isNull()
    needs_text = missing & ~F.coalesce("remote", F.lit(False))
    with_text = jobs.withColumn(
        "_text", F.when(needs_text, lowered_text(F.col("title"), F.col("description")))
    )
    filled = F.when(missing, fill_value(F.col("remote"), F.col("_text"))).otherwise(
        F.col("remote_mode")
    )
    return with_text.withColumn("remote_mode", filled).drop("_text")


def fill_page(jobs: DataFrame, limit: int = fixed.FILL_CHUNK_ROWS) -> DataFrame:
    """The first rows in id order that still lack a remote mode, filled."""
    page = jobs.filter(F.col("remote_mode").isNull()).orderBy("id").limit(limit)
    return fill_remote_mode(page)


def with_training_label(
    df: DataFrame, remote_type: str = "remote_type", out: str = "remote_label"
) -> DataFrame:
    """The one signal the text gives; with none, the employer's flag; else unknown (null)."""
    scoped, full, scratch = with_long_text(
        df, "_text", title_and_text(F.col("title"), F.col("description"))
    )
    signals = [
        F.when(full.matches(pattern, needs), F.lit(value))
        for (value, pattern), needs in zip(fixed.LABEL_SIGNALS, fixed.LABEL_NEEDS, strict=True)
    ]
    scored = scoped.withColumn("_signals", F.array_compact(F.array(*signals)))
    n = F.size("_signals")
    flagged = strip(blank_if_null(F.col(remote_type))) == "Remote"
    label = F.when(n == 1, F.get("_signals", F.lit(0))).when(
        (n == 0) & flagged, F.lit("Remote")
    )
    return scored.withColumn(out, label).drop("_signals", *scratch)
