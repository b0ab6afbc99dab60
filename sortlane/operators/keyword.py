"""Keyword tier: six ordered cascades over the title and the merge of their results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.regex import first_match, matches_lowered
from sortlane.functions.text import lowered_title
from sortlane.rules import keyword as fixed


def _cascade(title: Column, rules: list[tuple[str, str]]) -> Column:
    return first_match([(matches_lowered(title, pattern), value) for value, pattern in rules])


def keyword_role(title: Column) -> Column:
    """``title`` is already lower case and not null, here and below."""
    return _cascade(title, fixed.ROLE)


def keyword_industry(title: Column) -> Column:
    return _cascade(title, fixed.INDUSTRY)


def keyword_collar(title: Column) -> Column:
    return _cascade(title, fixed.COLLAR)


def keyword_remote(title: Column) -> Column:
    return _cascade(title, fixed.REMOTE_MODE)


def keyword_job_type(title: Column) -> Column:
    def hit(pattern: str) -> Column:
        return matches_lowered(title, pattern)

    return first_match(
        [
            (hit(fixed.PER_DIEM), "Per Diem"),
            (hit(fixed.TRAVEL) | hit(fixed.WEEKS), "Contract"),
            (hit(fixed.GIG_PLATFORM) & hit(fixed.GIG_ACTIVITY), "Contract"),
            *[(hit(pattern), value) for value, pattern in fixed.JOB_TYPE_WORDS],
        ]
    )


def keyword_experience(title: Column) -> Column:
    return _cascade(title, fixed.EXPERIENCE)


CASCADES = {
    "role": keyword_role,
    "industry": keyword_industry,
    "collar": keyword_collar,
    "remote_mode": keyword_remote,
    "job_type": keyword_job_type,
    "experience_level": keyword_experience,
}


def keyword_labels(df: DataFrame, title: str = "title", prefix: str = "kw_") -> DataFrame:
    """Add the six keyword labels; null where no pattern matches.

    The lower-cased title has a projection of its own so that it is computed once per row.
    """
    lowered = df.withColumn("_lowered_title", lowered_title(F.col(title)))
    labelled = lowered.withColumns(
        {prefix + name: cascade(F.col("_lowered_title")) for name, cascade in CASCADES.items()}
    )
    return labelled.drop("_lowered_title")


def keyword_merge(jobs: DataFrame, stamped_at: datetime | Column) -> DataFrame:
    """Write the keyword labels into a jobs frame, row by row and without a shuffle.

    Role and industry are replaced on a match, the others only fill: the feed job type when
    null or empty, the rest when null.
    """
    stamp = stamped_at if isinstance(stamped_at, Column) else F.lit(stamped_at).cast("timestamp")
    new = keyword_labels(jobs)
    matched = F.col("kw_role").isNotNull()
    no_feed_type = F.col("job_type_feed").isNull() | (F.col("job_type_feed") == "")
    merged = new.withColumns(
        {
            "role": F.coalesce("kw_role", "role"),
            "industry": F.coalesce("kw_industry", "industry"),
            "role_method": F.when(matched, F.lit(fixed.METHOD)).otherwise(F.col("role_method")),
            "role_confidence": F.when(matched, F.lit(fixed.CONFIDENCE)).otherwise(
                F.col("role_confidence")
            ),
            "role_updated_at": F.when(matched, stamp).otherwise(F.col("role_updated_at")),
            "collar": F.coalesce("collar", "kw_collar"),
            "remote_mode": F.coalesce("remote_mode", "kw_remote_mode"),
            "job_type_feed": F.when(no_feed_type, F.col("kw_job_type")).otherwise(
                F.col("job_type_feed")
            ),
            "experience_level": F.coalesce("experience_level", "kw_experience_level"),
        }
    )
    return merged.drop(*["kw_" + name for name in CASCADES])


def keyword_page(jobs: DataFrame, after: str, limit: int = fixed.CHUNK_ROWS) -> DataFrame:
    """The next rows in id order after a cursor."""
    return jobs.filter(F.col("id") > after).orderBy("id").limit(limit)


def keyword_chunk(
    jobs: DataFrame, after: str, stamped_at: datetime | Column, limit: int = fixed.CHUNK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """One page merged, and the cursor for the next one (null when nothing is left)."""
    page = keyword_page(jobs, after, limit)
    return keyword_merge(page, stamped_at), page.agg(F.max("id").alias("after_id"))
