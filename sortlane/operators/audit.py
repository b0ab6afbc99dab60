"""Audit rules with three outcomes - a value, a conflict or unknown - and their coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.regex import (
    TEXT_FLAGS,
    LongText,
    first_match,
    matches,
    with_long_text,
)
from sortlane.functions.text import blank_if_null, title_and_text
from sortlane.operators.columns import as_number
from sortlane.plans.bounded import value_counts
from sortlane.rules import audit as fixed

FIELDS = ["remote_type", "job_type", "experience_band", "collar"]


def unique_signal(hits: Column) -> Column:
    """The only distinct value of a list (nulls skipped), else conflict or unknown."""
    joined = F.concat_ws("\n", F.array_distinct(hits))
    return F.when(joined == "", F.lit(fixed.UNKNOWN)).otherwise(
        F.regexp_replace(joined, r"(?s)^.*\n.*$", fixed.CONFLICT)
    )


def _signals(scope: Column, rules: list[tuple[str, str]]) -> Column:
    return F.array(*[F.when(matches(scope, p), F.lit(value)) for value, p in rules])


def _text_signals(full: LongText, rules: list[tuple[str, str]], needs: list[list[str]]) -> Column:
    return F.array(
        *[F.when(full.matches(p, n), F.lit(v)) for (v, p), n in zip(rules, needs, strict=True)]
    )


def remote_signal(full: LongText) -> Column:
    return unique_signal(_text_signals(full, fixed.REMOTE, fixed.REMOTE_NEEDS))


def job_type_signal(full: LongText) -> Column:
    return unique_signal(_text_signals(full, fixed.JOB_TYPE, fixed.JOB_TYPE_NEEDS))


def _years_pattern() -> str:
    """Years statements; group 2 takes part only where no company-age phrase stands before.

    A statement after such a phrase is matched by the first branch, which uses it up without
    filling the group, so a later part of the same statement cannot match on its own.
    """
    window = fixed.COMPANY_AGE_WINDOW
    before = "|".join(
        rf"{phrase}[\s\S]{{0,{window - len(phrase)}}}" for phrase in fixed.COMPANY_AGE_PHRASES
    )
    # The digit is looked for first: looking behind at every character would be slow.
    return rf"{TEXT_FLAGS}(?=\d)(?:(?<={before}){fixed.YEARS}|{fixed.YEARS})"


def _stated_numbers(full_text: Column) -> Column:
    numbers = F.regexp_extract_all(full_text, F.lit(_years_pattern()), F.lit(2))
    return F.array_remove(numbers, F.lit(""))


def min_years_in_role(full_text: Column) -> Column:
    return F.array_min(F.transform(_stated_numbers(full_text), as_number))


def experience_signal(title: Column, full_text: Column) -> Column:
    """Stated years decide; without any, the words of the title do."""
    numbers = _stated_numbers(full_text)
    top = fixed.MID_UP_TO_YEARS + 1
    ladder = [
        "Entry"
        if y <= fixed.ENTRY_UP_TO_YEARS
        else "Mid-Senior"
        if y <= fixed.MID_UP_TO_YEARS
        else "Senior"
        for y in range(top + 1)
    ]
    years = F.array_min(F.transform(numbers, lambda d: F.least(as_number(d), F.lit(top))))
    return F.coalesce(
        F.get(F.array(*[F.lit(v) for v in ladder]), years),
        unique_signal(_signals(title, fixed.TITLE_EXPERIENCE)),
    )


def collar_signal(title: Column) -> Column:
    return first_match(
        [(matches(title, fixed.CLINICAL) | matches(title, fixed.TRADES), "Blue")],
        F.lit(fixed.UNKNOWN),
    )


def looks_like_ad(full: LongText) -> Column:
    """``full`` is the description here."""
    return (F.length(full.text) > fixed.AD_MIN_CHARS) | full.matches(
        fixed.AD_WORDS, fixed.AD_WORDS_NEEDS
    )


def audit_signals(df: DataFrame) -> DataFrame:
    """Add the four audit fields and ``is_ad``."""
    t, d = F.col("title"), F.col("description")
    titled = df.withColumn("_title", blank_if_null(t))
    scoped, full, scratch = with_long_text(titled, "_text", title_and_text(t, d))
    # The ad rule looks at the description alone.
    about, body, more = with_long_text(scoped, "_body", blank_if_null(d))
    title = F.col("_title")
    return about.withColumns(
        {
            "is_ad": looks_like_ad(body),
            "remote_type": remote_signal(full),
            "job_type": job_type_signal(full),
            "experience_band": experience_signal(title, full.text),
            "collar": collar_signal(title),
        }
    ).drop("_title", *scratch, *more)


def coverage_report(signals: DataFrame) -> DataFrame:
    """Usable, unknown and conflicting rows and the class mix, per segment and field.

    The rows are read once: everything is derived from the counts by (is_ad, field, value).
    """
    counts = value_counts(signals, FIELDS, [F.col("is_ad")])
    segments = F.array(F.lit("all"), F.when(F.col("is_ad"), F.lit("ad")).otherwise(F.lit("non-ad")))
    by_segment = (
        counts.withColumn("segment", F.explode(segments))
        .groupBy("segment", F.col("column_name").alias("field"), "value")
        .agg(F.sum("n").alias("n"))
    )
    is_class = ~F.col("value").isin(fixed.UNKNOWN, fixed.CONFLICT)
    per_field = by_segment.groupBy("segment", "field").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(is_class, F.col("n")).otherwise(0)).alias("usable"),
    )
    joined = by_segment.join(per_field, ["segment", "field"])
    return joined.select(
        "segment",
        "field",
        "value",
        "n",
        F.round(100.0 * F.col("n") / F.col("total"), 6).alias("pct_of_rows"),
        F.round(F.when(is_class, 100.0 * F.col("n") / F.col("usable")), 6).alias("pct_of_usable"),
    )
