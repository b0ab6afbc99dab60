"""Reading and writing the input and output tables.

A CSV is read once, by many tasks whatever line breaks its fields hold, gets its ``row_id`` and
is kept as Parquet; everything else reads the Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.schema import (
    AUGMENTED_COLUMNS,
    JOBS_COLUMN_NAMES,
    JOBS_SCHEMA,
    POSTINGS_SCHEMA,
    TRAINING_SCHEMA,
)
from sortlane.sources.quoted_csv import read_quoted_csv


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Columns picked by header name, every value a string, a missing one ''."""
    return read_quoted_csv(spark, path, POSTINGS_SCHEMA.fieldNames()).drop("row_id")


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """The curated training rows, numbered 0, 1, ... in the order of the files and their rows."""
    columns = TRAINING_SCHEMA.fieldNames()
    return read_quoted_csv(spark, path, columns).select(*columns, "row_id")


def read_ad_hoc(spark: SparkSession, path: str) -> DataFrame:
    """Titles and descriptions to predict."""
    return read_quoted_csv(spark, path, ["title", "description"]).drop("row_id")


def ingest(df: DataFrame, path: str) -> DataFrame:
    """Write the rows as Parquet and read them back, numbered if they have no ``row_id`` yet.

    Numbers given here are not stable from one read to the next, which is why they are stored.
    """
    numbered = df if "row_id" in df.columns else df.withColumn("row_id", F.monotonically_increasing_id())
    numbered.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_embeddings(spark: SparkSession, path: str, key: str = "row_id") -> DataFrame:
    """Vectors by key: (row_id, embedding)."""
    return spark.read.parquet(path).select(F.col(key).alias("row_id"), "embedding")


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The jobs table under the names used here; columns it lacks are null."""
    raw = spark.read.parquet(path)
    renamed = raw.withColumnsRenamed({k: v for k, v in JOBS_COLUMN_NAMES.items() if k in raw.columns})
    return conform_jobs(renamed)


def conform_jobs(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in JOBS_SCHEMA
        ]
    )


def physical_jobs(df: DataFrame) -> DataFrame:
    """The jobs table under its stored column names."""
    return df.withColumnsRenamed({v: k for k, v in JOBS_COLUMN_NAMES.items()})


def write_snapshot(jobs: DataFrame, path: str) -> None:
    """A new snapshot in a folder of its own, with the queue as a partition to prune to.

    An existing folder is never overwritten: the plan may still be reading from it.
    """
    marked = jobs.withColumn("is_classified", F.col("classified_at").isNotNull())
    marked.write.mode("error").partitionBy("is_classified").parquet(path)


def read_snapshot(spark: SparkSession, path: str, only_queue: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    if only_queue:
        df = df.filter(~F.col("is_classified"))
    return df.drop("is_classified")


def write_training(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The augmented training rows, unknown labels as ''; ``row_id`` holds their order."""
    blanked = df.select(
        "row_id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in AUGMENTED_COLUMNS]
    )
    _write(blanked, path, fmt)


def write_predictions(flat: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(flat, path, fmt)


def write_sample_results(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(results, path, fmt)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("error")
    if fmt == "csv":
        writer.csv(
            path,
            header=True,
            quote='"',
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    else:
        writer.parquet(path)
