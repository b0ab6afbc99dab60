"""Label recovery: unanimous labels per key, joins back to the training rows, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.functions.text import blank_if_null, key_hash, strip
from sortlane.plans.bounded import value_counts
from sortlane.plans.skew import left_join_unique
from sortlane.plans.workspace import materialise
from sortlane.rules import labels as fixed

SOURCE_FIELDS = {
    "work_type": "formatted_work_type",
    "experience": "formatted_experience_level",
    "remote": "remote_allowed",
}


def _keyed_source(postings: DataFrame, *keep: str) -> DataFrame:
    """Key hash and the three source values, blanks as null; texts are dropped here."""
    values = [
        F.nullif(strip(blank_if_null(F.col(column))), F.lit("")).alias(name)
        for name, column in SOURCE_FIELDS.items()
    ]
    return postings.select(key_hash(F.col("title"), F.col("description")).alias("key"), *values, *keep)


def _spread(postings: DataFrame) -> DataFrame:
    """Per key: row count and the smallest and largest value of every field.

    Two bounds tell one distinct value from several, need no distinct set per key, and are
    combined before the shuffle, so a key with very many rows is one row per task.
    """
    aggregates = [F.count("*").alias("n_rows")]
    for name in SOURCE_FIELDS:
        aggregates += [F.min(name).alias(name + "_lo"), F.max(name).alias(name + "_hi")]
    return _keyed_source(postings).groupBy("key").agg(*aggregates)


def unanimous_labels(postings: DataFrame) -> DataFrame:
    """One row per key; a field is null where the rows of a key have none or disagree."""
    return _spread(postings).select(
        "key",
        *[
            F.when(F.col(name + "_lo") == F.col(name + "_hi"), F.col(name + "_lo")).alias(name)
            for name in SOURCE_FIELDS
        ],
    )


def join_conflicts(postings: DataFrame) -> DataFrame:
    """Agreement per source field: keys with a value, unanimous and conflicting ones."""
    spread = _spread(postings)
    aggregates = [
        F.count("*").alias("unique_keys"),
        F.count_if(F.col("n_rows") > 1).alias("multi_row_keys"),
    ]
    for name in SOURCE_FIELDS:
        lo, hi = F.col(name + "_lo"), F.col(name + "_hi")
        aggregates += [
            F.count(lo).alias(name + "_with"),
            F.count_if(lo == hi).alias(name + "_same"),
        ]
    totals = spread.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("field"),
                F.col(name + "_with").alias("with_value"),
                F.col(name + "_same").alias("unanimous"),
            )
            for name, column in SOURCE_FIELDS.items()
        ]
    )
    return totals.select("unique_keys", "multi_row_keys", F.inline(rows)).select(
        "field",
        "unique_keys",
        "multi_row_keys",
        F.round(100.0 * F.col("multi_row_keys") / F.col("unique_keys"), 6).alias("multi_row_pct"),
        "with_value",
        "unanimous",
        (F.col("with_value") - F.col("unanimous")).alias("conflicting"),
        F.round(
            F.when(F.col("with_value") > 0, 100.0 * F.col("unanimous") / F.col("with_value")), 6
        ).alias("unanimous_pct"),
    )


def remote_from_flag(flag: Column) -> Column:
    """Only a ticked flag says anything; an absent one is unknown, not on-site."""
    return F.when(flag.isin(fixed.REMOTE_FLAGS), F.lit("Remote"))


def collar_from_role(role: Column) -> Column:
    return F.when(role.isin(fixed.BLUE_ROLES), F.lit("Blue")).when(
        role.isin(fixed.WHITE_ROLES), F.lit("White")
    )


def _map_value(column: Column, table: dict[str, str | None]) -> Column:
    pairs = [F.lit(x) for item in table.items() if item[1] is not None for x in item]
    return F.try_element_at(F.create_map(*pairs), strip(column))


def map_job_type(work_type: Column) -> Column:
    return _map_value(work_type, fixed.JOB_TYPE)


def map_experience4(level: Column) -> Column:
    return _map_value(level, fixed.EXPERIENCE_4)


def map_experience3(level: Column) -> Column:
    """Three bands; a level outside the table stays as it is."""
    return F.coalesce(_map_value(level, fixed.EXPERIENCE_3), level)


def _join_by_key(training: DataFrame, lookup: DataFrame, row_id: str) -> DataFrame:
    """Training rows with the lookup row of their key; many rows may share a key.

    Only ids and keys meet the lookup. They are stored first, so the texts are read once for
    them and the hot keys are found on 16 bytes a row; the lookup rows of hot keys alone are
    copied. The texts are dealt out by the unique row id.
    """
    key = key_hash(F.col("title"), F.col("description"))
    keys = materialise(training.select(row_id, key.alias("key")), "keys")
    marked = lookup.withColumn("_found", F.lit(True))
    found = left_join_unique(keys, marked, "key", row_id).filter("_found").drop("key", "_found")
    return training.join(found, row_id, "left")


def recover_labels(
    training: DataFrame, postings: DataFrame, row_id: str = "row_id"
) -> DataFrame:
    """Training rows with job type, experience, remote and collar labels; unknown is null."""
    joined = _join_by_key(training, unanimous_labels(postings), row_id)
    return joined.withColumns(
        {
            "job_type": F.col("work_type"),
            "experience_band": F.col("experience"),
            "remote_type": remote_from_flag(F.col("remote")),
            "collar": collar_from_role(F.col("role")),
        }
    ).drop("work_type", "experience", "remote")


def last_labels(postings: DataFrame, order: str = "row_id") -> DataFrame:
    """The values of the last row of every key, whatever the others say."""
    last = F.max(F.struct(order, *SOURCE_FIELDS)).alias("last")
    grouped = _keyed_source(postings, order).groupBy("key").agg(last)
    return grouped.select("key", *[F.col("last")[name].alias(name) for name in SOURCE_FIELDS])


def last_wins_join(training: DataFrame, postings: DataFrame, order: str = "row_id") -> DataFrame:
    """Training rows with the last source row of their key; ``joined`` marks a hit."""
    lookup = last_labels(postings, order).withColumn("joined", F.lit(True))
    joined = _join_by_key(training, lookup, order)
    return joined.withColumn("joined", F.coalesce("joined", F.lit(False)))


def join_rate(training: DataFrame, postings: DataFrame) -> DataFrame:
    """How many training rows find a source row.

    Both sides shrink to counts per key before they meet.
    """
    key = key_hash(F.col("title"), F.col("description")).alias("key")
    wanted = training.select(key).groupBy("key").agg(F.count("*").alias("n"))
    known = postings.select(key).distinct().withColumn("hit", F.lit(1))
    return (
        wanted.join(known, "key", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("training_rows"),
            F.coalesce(F.sum(F.col("n") * F.col("hit")), F.lit(0)).alias("joined_rows"),
        )
        .withColumn(
            "joined_pct",
            F.round(
                F.when(F.col("training_rows") > 0, 100.0 * F.col("joined_rows") / F.col("training_rows")),
                6,
            ),
        )
    )


def fill_rates(df: DataFrame, columns: list[str], top: int = 12) -> DataFrame:
    """Per column: rows, filled rows and the most frequent values, '(empty)' among them."""
    cleaned = df.select(
        *[
            F.coalesce(F.nullif(strip(blank_if_null(F.col(c))), F.lit("")), F.lit("(empty)")).alias(c)
            for c in columns
        ]
    )
    counts = value_counts(cleaned, columns)
    totals = _totals(counts, F.col("value") != "(empty)")
    return (
        _most_frequent(counts, top)
        .join(totals, "column_name")
        .select(
            "column_name",
            "rows",
            "filled",
            F.round(100.0 * F.col("filled") / F.col("rows"), 6).alias("filled_pct"),
            "rank",
            "value",
            "n",
            F.round(100.0 * F.col("n") / F.col("rows"), 6).alias("pct"),
        )
    )


def _totals(counts: DataFrame, filled: Column) -> DataFrame:
    """Rows and filled rows per column, from (column_name, value, n)."""
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("filled"),
    )


def _most_frequent(counts: DataFrame, top: int) -> DataFrame:
    """The first values per column by count, ties in value order."""
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top)


def label_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Labelled rows per column and the mix of its classes; blank and null are unlabelled."""
    counts = value_counts(df, columns)
    filled = _is_filled(F.col("value"))
    return (
        _totals(counts, filled)
        .join(counts.filter(filled), "column_name", "left")
        .select(
            "column_name",
            "rows",
            F.col("filled").alias("labelled"),
            F.round(100.0 * F.col("filled") / F.col("rows"), 6).alias("labelled_pct"),
            "value",
            "n",
            F.round(100.0 * F.col("n") / F.col("filled"), 6).alias("class_pct"),
        )
    )


def column_coverage(df: DataFrame, columns: list[str], top: int = 6) -> DataFrame:
    """Filled rows and the most frequent values of every predicted column."""
    counts = value_counts(df, columns)
    filled = _is_filled(F.col("value"))
    return (
        _totals(counts, filled)
        .join(_most_frequent(counts.filter(filled), top), "column_name", "left")
        .select(
            "column_name",
            "rows",
            "filled",
            F.round(100.0 * F.col("filled") / F.col("rows"), 6).alias("filled_pct"),
            "rank",
            "value",
            "n",
        )
    )


def _is_filled(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def inferred_remote_negative(df: DataFrame) -> DataFrame:
    """Among rows that joined the source (a job type is known), unticked means not remote."""
    joined = strip(blank_if_null(F.col("job_type"))) != ""
    ticked = strip(blank_if_null(F.col("remote_type"))) != ""
    return df.filter(joined).withColumn(
        "remote_binary", F.when(ticked, F.lit("Remote")).otherwise(F.lit("Not-remote"))
    )
