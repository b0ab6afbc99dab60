"""Merging results into the jobs table: fill blanks, queue marker, keyset scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.schema import UPDATE_SCHEMA

UPDATE_COLUMNS = [f.name for f in UPDATE_SCHEMA if f.name != "id"]


def unclassified(jobs: DataFrame) -> DataFrame:
    """The queue: rows no model run has stamped yet."""
    return jobs.filter(F.col("classified_at").isNull())


def scan_unclassified(jobs: DataFrame, after: str, limit: int) -> DataFrame:
    return (
        unclassified(jobs)
        .select("id", "title", "description", "job_type_feed")
        .filter(F.col("id") > after)
        .orderBy("id")
        .limit(limit)
    )


def scan_active_sample(jobs: DataFrame, limit: int) -> DataFrame:
    return (
        jobs.filter("is_active").select("id", "title", "description").orderBy("id").limit(limit)
    )


def update_frame(predictions: DataFrame) -> DataFrame:
    """What a model run may write: never the remote mode, and null rather than ''."""
    return predictions.select(
        "id", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in UPDATE_COLUMNS]
    )


def _filled(old: str, new: Column) -> Column:
    """The trimmed old value, or the new one where nothing is left of it."""
    return F.coalesce(F.nullif(F.trim(F.col(old)), F.lit("")), new)


def fill_blanks(joined: DataFrame, new: dict[str, Column], hit: Column, stamp: Column) -> DataFrame:
    """Fill rules over a frame that holds both the job and its new values.

    Industry, role and experience fill when blank, collar when null, and the feed job type
    when null or exactly empty. Every hit row is stamped and so leaves the queue.
    """
    feed = F.col("job_type_feed")
    merged = {
        "industry": _filled("industry", new["industry"]),
        "role": _filled("role", new["role"]),
        "experience_level": _filled("experience_level", new["experience_level"]),
        "collar": F.coalesce(F.col("collar"), new["collar"]),
        "job_type_feed": F.when(feed.isNull() | (feed == ""), new["job_type"]).otherwise(feed),
        "classified_at": stamp,
    }
    return joined.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in merged.items()}
    )


def apply_updates(
    jobs: DataFrame, updates: DataFrame, stamped_at: datetime | Column, unique_ids: bool = False
) -> DataFrame:
    """A new snapshot of ``jobs`` with a batch of updates merged in by id.

    Rows are never added or removed: unknown ids are ignored, and of several updates to one id
    a single one counts. ``unique_ids`` skips that check where the ids are known to be unique.
    """
    stamp = stamped_at if isinstance(stamped_at, Column) else F.lit(stamped_at).cast("timestamp")
    payload = F.struct(*UPDATE_COLUMNS).alias("_new")
    if unique_ids:
        batch = updates.select("id", payload)
    else:
        batch = updates.select("id", payload).groupBy("id").agg(F.max("_new").alias("_new"))
    joined = jobs.join(batch, "id", "left")
    new = {c: F.col("_new")[c] for c in UPDATE_COLUMNS}
    return fill_blanks(joined, new, F.col("_new").isNotNull(), stamp).drop("_new")


def count_updated(jobs: DataFrame, updates: DataFrame) -> DataFrame:
    """Number of jobs a batch of updates reaches."""
    return jobs.join(updates.select("id"), "id", "left_semi").agg(F.count("*").alias("n_updated"))


def read_update_json(spark, payload: str | Column, df: DataFrame | None = None) -> DataFrame:
    """Updates that arrive as a JSON array, one row per element."""
    from pyspark.sql import types as T

    if df is None:
        df, payload = spark.createDataFrame([(payload,)], "payload string"), F.col("payload")
    parsed = F.from_json(payload, T.ArrayType(UPDATE_SCHEMA))
    return df.select(F.inline(parsed))
