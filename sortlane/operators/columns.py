"""Overrides for job type, experience level, collar and remote mode.

Every step yields a short code of the rule that fired, e.g. ``title_Senior`` or ``per_diem``.
The value and the note both follow from the code, so each pattern runs at most once per row.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.regex import LongText, first_match, matches, text, with_long_text
from sortlane.functions.text import blank_if_null
from sortlane.rules import columns as fixed


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    points = [
        (chr(p), str(unicodedata.decimal(chr(p))))
        for p in range(0x80, sys.maxunicode + 1)
        if unicodedata.decimal(chr(p), None) is not None
    ]
    return "".join(p for p, _ in points), "".join(d for _, d in points)


def as_number(digits: Column) -> Column:
    """A run of decimal digits of any script as an integer."""
    return F.translate(digits, *_decimal_digits()).cast("int")


def job_type_code(title: Column, full: LongText) -> Column:
    return first_match(
        [
            (full.matches(fixed.PER_DIEM, fixed.PER_DIEM_NEEDS), "per_diem"),
            (
                full.matches(fixed.TRAVEL_CONTRACT, fixed.TRAVEL_CONTRACT_NEEDS),
                "travel_contract",
            ),
            (
                matches(title, fixed.GIG_PLATFORM) & matches(full.text, fixed.GIG_ACTIVITY),
                "gig_platform",
            ),
            *[(matches(title, p), "title_" + value) for value, p in fixed.TITLE_JOB_TYPE],
        ]
    )


def job_type_value(code: Column, current: Column) -> Column:
    return (
        F.when(code == "per_diem", F.lit("Per Diem"))
        .when(code.isin("travel_contract", "gig_platform"), F.lit("Contract"))
        .when(code.isNotNull(), F.substring(code, len("title_") + 1, 100))
        .otherwise(current)
    )


def title_experience(title: Column) -> Column:
    return first_match([(matches(title, p), value) for value, p in fixed.TITLE_EXPERIENCE])


def min_stated_years(description: Column) -> Column:
    """Smallest number of years of experience stated, null if none is."""
    numbers = F.regexp_extract_all(description, F.lit(text(fixed.YEARS)), F.lit(1))
    return F.array_min(F.transform(numbers, as_number))


def years_level(description: Column) -> Column:
    """Level for the smallest stated number of years: a lookup by year, capped at the top."""
    top = fixed.MID_UP_TO_YEARS + 1
    ladder = [
        "Entry" if y <= fixed.ENTRY_UP_TO_YEARS else "Mid" if y <= fixed.MID_UP_TO_YEARS else "Senior"
        for y in range(top + 1)
    ]
    # least() skips nulls, so the cap is applied inside the list.
    numbers = F.regexp_extract_all(description, F.lit(text(fixed.YEARS)), F.lit(1))
    capped = F.transform(numbers, lambda d: F.least(as_number(d), F.lit(top)))
    return F.get(F.array(*[F.lit(v) for v in ladder]), F.array_min(capped))


def states_no_experience(full: LongText) -> Column:
    return full.matches(fixed.NO_EXPERIENCE, fixed.NO_EXPERIENCE_NEEDS)


def experience_code(title: Column, description: Column, full: LongText) -> Column:
    return F.coalesce(
        F.concat(F.lit("title_"), title_experience(title)),
        F.concat(F.lit("years_"), years_level(description)),
        F.when(states_no_experience(full), F.lit("no_experience")),
    )


def experience_value(code: Column, current: Column) -> Column:
    return (
        F.when(code == "no_experience", F.lit("Entry"))
        .when(code.isNotNull(), F.substring(code, len("title_") + 1, 100))
        .otherwise(current)
    )


def collar_code(title: Column) -> Column:
    return first_match(
        [
            (matches(title, fixed.CLINICAL_TITLE), "clinical_veto"),
            (matches(title, fixed.WHITE_TITLE), "white_title"),
            (matches(title, fixed.BLUE_TITLE), "trade_veto"),
        ]
    )


def collar_value(code: Column, current: Column) -> Column:
    return (
        F.when(code == "white_title", F.lit("White"))
        .when(code.isNotNull(), F.lit("Blue"))
        .otherwise(current)
    )


def remote_value(title: Column, full: LongText) -> Column:
    """Rules alone decide; what the model said is not consulted."""
    return first_match(
        [
            (full.matches(fixed.HYBRID_TEXT, fixed.HYBRID_TEXT_NEEDS), "Hybrid"),
            (
                full.matches(fixed.REMOTE_TEXT, fixed.REMOTE_TEXT_NEEDS)
                & ~matches(title, fixed.PHYSICAL_TITLE),
                "Remote",
            ),
        ],
        F.lit("On-site"),
    )


def apply_column_rules(
    df: DataFrame,
    title: str = "title",
    description: str = "description",
    job_type: str = "job_type",
    experience_level: str = "experience_level",
    collar: str = "collar",
    remote_mode: str = "remote_mode",
    notes: str = "notes",
) -> DataFrame:
    """Override the four columns in place and add the list of rules that changed them."""
    t, d = blank_if_null(F.col(title)), blank_if_null(F.col(description))
    split = df.withColumns({"_t": t, "_d": d})
    t, d = F.col("_t"), F.col("_d")
    scoped, full, scratch = with_long_text(split, "_text", F.concat(t, F.lit("\n"), d))
    coded = scoped.withColumns(
        {
            "_job_type": job_type_code(t, full),
            "_experience": experience_code(t, d, full),
            "_collar": collar_code(t),
            "_remote": remote_value(t, full),
        }
    )
    jt, ex, co, rm = (F.col(c) for c in ("_job_type", "_experience", "_collar", "_remote"))

    def changed(new: Column, old: str) -> Column:
        return ~new.eqNullSafe(F.col(old))

    new_jt = job_type_value(jt, F.col(job_type))
    new_ex = experience_value(ex, F.col(experience_level))
    new_co = collar_value(co, F.col(collar))
    # Notes of the text rules on job type are unconditional; all others mark a change.
    noted = F.array_compact(
        F.array(
            F.when(
                jt.isNotNull() & (~jt.startswith("title_") | changed(new_jt, job_type)),
                F.concat(F.lit("job_type:"), jt),
            ),
            F.when(
                ex.isNotNull() & changed(new_ex, experience_level),
                F.concat(F.lit("experience:"), ex),
            ),
            F.when(co.isNotNull() & changed(new_co, collar), F.concat(F.lit("collar:"), co)),
            F.when(changed(rm, remote_mode), F.concat(F.lit("remote:rule_"), rm)),
        )
    )
    ruled = coded.withColumns(
        {
            notes: noted,
            job_type: new_jt,
            experience_level: new_ex,
            collar: new_co,
            remote_mode: rm,
        }
    )
    return ruled.drop("_t", "_d", *scratch, "_job_type", "_experience", "_collar", "_remote")


def notes_text(notes: Column) -> Column:
    return F.concat_ws(";", notes)
