"""Rule cases: fixed expected values of the override tier and known quirks of each tier."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sortlane.operators import audit, columns, keyword, titles
from sortlane.rules import audit as audit_rules

# Fixed values, those of FIXTURES.md section 2: title, description, (job type, experience,
# collar, remote) before and after.
CASES = [
    ("Manufacturing Engineer", "advanced manufacturing engineering role", ("Full-time", "Mid", "Blue", "Remote"), ("Full-time", "Mid", "White", "On-site")),
    ("Travel Radiologic Technologist", "13-week travel assignment at a facility", ("Full-time", "Entry", "Blue", "Remote"), ("Contract", "Entry", "Blue", "On-site")),
    ("Registered Nurse PRN", "as-needed shifts at our medical center", ("Full-time", "Mid", "White", "Remote"), ("Per Diem", "Mid", "Blue", "On-site")),
    ("Senior Software Engineer (Remote)", "8+ years python, fully remote", ("Full-time", "Mid", "White", "On-site"), ("Full-time", "Senior", "White", "Remote")),
    ("Software Developer", "we require 3 years of experience building web apps", ("Full-time", "Entry", "White", "Remote"), ("Full-time", "Mid", "White", "On-site")),
    ("Demand Planner", "supply chain planning role, hybrid schedule", ("Full-time", "Mid", "Blue", "Remote"), ("Full-time", "Mid", "White", "Hybrid")),
    ("Vice President, Marketing", "lead the marketing org", ("Full-time", "Mid", "White", "Remote"), ("Full-time", "Senior", "White", "On-site")),
    ("Delivery Partner", "drive and deliver with our platform, flexible", ("Full-time", "Mid", "White", "Remote"), ("Full-time", "Mid", "Blue", "On-site")),
    ("Staff Accountant", "prepare journal entries, no experience needed", ("Full-time", "Senior", "White", "Remote"), ("Full-time", "Entry", "White", "On-site")),
    ("Contract Manager", "oversee vendor contracts, permanent salaried role", ("Full-time", "Mid", "White", "Remote"), ("Full-time", "Mid", "White", "On-site")),
    ("Cashier", "must be at least 18 years of age, cash handling", ("Full-time", "Mid", "White", "Remote"), ("Full-time", "Mid", "Blue", "On-site")),
]


def test_column_rule_cases(spark):
    rows = [(i, t, d, *before) for i, (t, d, before, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows,
        "n int, title string, description string, job_type string, experience_level string,"
        " collar string, remote_mode string",
    )
    ruled = columns.apply_column_rules(df).orderBy("n").collect()
    got = [(r.job_type, r.experience_level, r.collar, r.remote_mode) for r in ruled]
    assert got == [after for *_, after in CASES]


def test_notes_only_mark_changes(spark):
    df = spark.createDataFrame(
        [
            ("Nurse PRN", "", "Per Diem", "Mid", "Blue", "On-site"),
            ("Senior Nurse", "", "Full-time", "Senior", "White", "Remote"),
            ("Intern", "no experience", "Internship", "Senior", "White", "On-site"),
        ],
        "title string, description string, job_type string, experience_level string,"
        " collar string, remote_mode string",
    )
    notes = [r.notes for r in columns.apply_column_rules(df).select(columns.notes_text(F.col("notes")).alias("notes")).collect()]
    assert notes == [
        "job_type:per_diem",
        "collar:clinical_veto;remote:rule_On-site",
        "experience:title_Entry",
    ]


@pytest.mark.parametrize(
    ("text", "years", "level"),
    [
        ("3-5 years of experience", 5, "Mid"),
        ("2 - 3 years experience", 3, "Mid"),
        ("100 years of experience", 0, "Entry"),
        ("8+ years python", None, None),
        ("2 to 4 years of relevant experience, 9 years experience", 2, "Entry"),
        ("٣ years of experience", 3, "Mid"),
        ("6 years' experience", 6, "Senior"),
    ],
)
def test_stated_years(spark, text, years, level):
    df = spark.createDataFrame([(text,)], "d string")
    row = df.select(
        columns.min_stated_years(F.col("d")).alias("y"), columns.years_level(F.col("d")).alias("l")
    ).first()
    assert (row.y, row.l) == (years, level)


def keyword_of(spark, name, title):
    df = spark.createDataFrame([(title,)], "t string")
    return df.select(keyword.CASCADES[name](F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("column", "title", "value"),
    [
        ("experience_level", "vice president, marketing", "Executive"),
        ("experience_level", "staff nurse", "Senior"),
        ("job_type", "marketing intern", None),
        ("job_type", "marketing internship", "Internship"),
        ("job_type", "contract manager", "Contract"),
        ("collar", "housekeeper", None),
        ("collar", "warehouse manager", "White"),
        ("role", "full\nstack", "Software Developer"),
        ("remote_mode", "analyst ( remote )", "Remote"),
    ],
)
def test_keyword_quirks(spark, column, title, value):
    assert keyword_of(spark, column, title) == value


@pytest.mark.parametrize(
    ("title", "expected"),
    [
        ("Medical Surveys", ("Business Services & Consulting", "Others", "junk-gig")),
        ("Earn $30/hour as a Caregiver", ("I", "R", "")),
        ("Director, Engineering", ("Technology & IT", "R", "leader-function")),
        ("VP - Finance", ("Finance & Banking", "Accountant & Finance", "leader-function")),
        ("Data Entry Director of Finance", ("Business Services & Consulting", "Others", "trap")),
        (None, ("I", "R", "")),
    ],
)
def test_title_rules(spark, title, expected):
    df = spark.createDataFrame([(title, "I", "R")], "title string, industry string, role string")
    row = titles.apply_title_rules(df).first()
    assert (row.industry, row.role, row.title_reason) == expected


def test_second_label(spark):
    df = spark.createDataFrame([("Others", 0.1), ("A", 0.1), ("A", 0.9)], "l string, c double")
    wants = titles.wants_second_label(F.col("l"), F.col("c"), F.lit(0.5)).alias("w")
    assert [r.w for r in df.select(wants).collect()] == [False, True, False]


def years_by_hand(text):
    """Statements found left to right; those shortly after a company-age phrase do not count."""
    found = []
    for m in re.finditer("(?i)" + audit_rules.YEARS, text):
        before = text[max(0, m.start() - 35) : m.start()].casefold()
        if not any(p in before for p in audit_rules.COMPANY_AGE_PHRASES):
            found.append(int(m.group(1)))
    return min(found, default=None)


def test_years_in_role_against_brute_force(spark):
    pieces = ["founded", "In Business", "serving clients", "company history", "3 years", "12+ years", "4 to 6 years", "1 year", "7 yearsold", "x" * 9, "x" * 17, "x" * 25, "and", "2 to", "5"]
    texts = []
    seed = 1
    for _ in range(400):
        parts = []
        for _ in range(6):
            seed = (seed * 1103515245 + 12345) % 2**31
            parts.append(pieces[(seed >> 8) % len(pieces)])
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = dict(df.select("n", audit.min_years_in_role(F.col("t")).alias("y")).collect())
    assert got == {i: years_by_hand(t) for i, t in enumerate(texts)}


def test_unique_signal(spark):
    df = spark.createDataFrame([(["a", "a", None],), (["a", "b"],), ([None],)], "h array<string>")
    assert [r[0] for r in df.select(audit.unique_signal(F.col("h"))).collect()] == [
        "a",
        "__CONFLICT__",
        "__UNKNOWN__",
    ]


def test_rules_stay_in_one_stage(spark, folder):
    """No Python and no exchange in the rule tiers."""
    from sortlane.operators.remote import fill_remote_mode
    from sortlane.sources.tables import conform_jobs

    jobs = conform_jobs(
        spark.read.parquet(f"{folder}/documents.parquet").select(
            F.col("doc_id").cast("string").alias("id"), F.col("text").alias("description"), F.col("lang").alias("title")
        )
    )
    merged = fill_remote_mode(keyword.keyword_merge(jobs, F.current_timestamp()))
    ruled = columns.apply_column_rules(
        titles.apply_title_rules(merged.withColumn("job_type", F.col("job_type_feed")))
    )
    plan = ruled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["k7_keyword_merge", "g13_column_rules", "u2_fill_remote_mode", "u5_daily_run"])
def test_registered_rule_queries_read_as_stored(spark, folder, name):
    """The plans that are checked and timed deal nothing out anew."""
    from sortlane.catalog import QUERIES

    plan = QUERIES[name].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "REPARTITION" not in plan
