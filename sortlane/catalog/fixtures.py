"""Views over the given tables that have the shape of the engine's inputs.

No given table holds titles, so a fixed list of titles is spread over all documents; the
descriptions are the whole document texts. The SQL is valid in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortlane.sources.tables import read_table

# Titles and snippets. Fixed values among them, those of FIXTURES.md section 2: the rows
# "Senior Software Engineer (Remote)", "Registered Nurse PRN", "Staff Accountant",
# "Vice President, Marketing" and "Contract Manager".
_TITLES = [
    ("Travel ICU RN", "13-week contract, night shift critical care, 2 years of experience"),
    ("Senior Software Engineer (Remote)", "8+ years python, fully remote"),
    ("Warehouse Associate - Part Time", "evenings, forklift cert a plus, on-site"),
    ("Marketing Intern", "summer internship supporting the brand team, hybrid schedule"),
    ("Data Scientist", "deep models, 3 years of experience"),
    ("Data Engineer - ETL", "big data pipelines, 6+ years of professional experience"),
    ("Machine Learning Engineer", "distributed team"),
    ("Information Security Analyst", "soc work, in-office"),
    ("DevOps / SRE", "site reliability, work from home"),
    ("QA Tester - Contract", "c2c accepted"),
    ("Help Desk Technician", "entry-level, will train"),
    ("Registered Nurse PRN", "as-needed shifts at our medical center"),
    ("Paralegal", "litigation support, full-time"),
    ("Preschool Teacher - Seasonal", "classroom, in person"),
    ("Uber Delivery Driver", "earn per trip with your own car"),
    ("Construction Project Manager", "site based, 10 years of experience"),
    ("Staff Accountant", "prepare journal entries, no experience needed"),
    ("HR Recruiter", "talent acquisition, remote position"),
    ("Project Manager #12345", "scrum and planning"),
    ("Product Owner (1,234)", "roadmaps, hybrid"),
    ("Management Consultant", "advisory work, 4 to 6 years of experience"),
    ("Customer Service Representative", "call center"),
    ("Vice President, Marketing", "lead the marketing org"),
    ("UX Designer - Temporary", "portfolio needed"),
    ("Retail Sales Cashier", "must be at least 18 years of age, cash handling"),
    ("Business Analyst", "reporting, 3-5 years of experience"),
    ("Chief Executive Officer", "CEO of the group"),
    ("Housekeeper", "hotel rooms"),
    ("Contract Manager", "oversee vendor contracts, permanent salaried role"),
    ("Medical Surveys", "paid surveys from the comfort of your home"),
    ("Data Entry Clerk", "typing"),
    ("Director, Engineering", "head a software group"),
    ("Director of Finance", "tax and accounting"),
    ("Solar Farm Worker", "greenhouse and crop"),
    ("CNC Machinist", "manufacturing plant"),
    ("Forklift Operator - 1099", "shift work"),
    ("", "no title given"),
    ("Office Manager", "founded 12 years ago, apply with 3 years of experience"),
    ("Plant Inspector", "in business for 40 years, we are hiring, 1 year"),
    ("Senior Contract Analyst - Contract", "hybrid role, 2 days in the office, on-site"),
    ("Junior Web Developer", "remote role, benefits and salary, 5 years or 4 to 6 years"),
    ("Travel Nurse", "locum tenens, temporary, work remotely"),
    ("Amazon Flex Courier", "deliver parcels, temp role, no remote"),
    ("NDT Technician", "nondestructive testing, 100 years of experience"),
    ("Paid Survey Taker", "participate in a study from home"),
    ("Head of Nursing", "company history: serving clients for 30 years, 2 - 3 years experience"),
    ("Cyber Security Lead", "office-based, must be located in the region, full time"),
    ("Founder Associate", "beginners welcome, partially remote"),
]


def _values() -> str:
    return ",\n ".join(f"({k},'{t}','{s}')" for k, (t, s) in enumerate(_TITLES))


JOBS_SQL = f"""
WITH t(k, title, snippet) AS (SELECT * FROM (VALUES
 {_values()}
) AS v(k, title, snippet))
SELECT lpad(CAST(d.doc_id AS VARCHAR(20)), 12, '0') AS id,
       CASE WHEN d.doc_id % 101 = 7 THEN NULL ELSE t.title END AS title,
       CASE WHEN d.doc_id % 97 = 5 THEN NULL ELSE concat(t.snippet, '. ', d.text) END AS description,
       CASE WHEN d.doc_id % 11 = 0 THEN TRUE WHEN d.doc_id % 3 = 0 THEN FALSE END AS remote,
       CASE d.doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'fulltime' WHEN 2 THEN ' ' END AS job_type_feed,
       CASE d.doc_id % 5 WHEN 0 THEN 'Mid' WHEN 1 THEN '' END AS experience_level,
       CASE d.doc_id % 6 WHEN 0 THEN ' Legacy Industry ' WHEN 1 THEN '  ' END AS industry,
       CASE d.doc_id % 7 WHEN 0 THEN 'Others' WHEN 1 THEN '' END AS role,
       CASE WHEN d.doc_id % 7 = 0 THEN 'import' END AS role_method,
       CASE WHEN d.doc_id % 7 = 0 THEN CAST(0.5 AS DOUBLE) END AS role_confidence,
       CASE WHEN d.doc_id % 7 = 0 THEN TIMESTAMP '2023-05-01 00:00:00' END AS role_updated_at,
       CASE d.doc_id % 9 WHEN 0 THEN 'White' END AS collar,
       CASE d.doc_id % 8 WHEN 0 THEN 'Hybrid' END AS remote_mode,
       d.doc_id % 10 <> 0 AS is_active,
       CASE WHEN d.doc_id % 13 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS classified_at
FROM documents d JOIN t ON d.doc_id % {len(_TITLES)} = t.k
"""

# Copies of one text share a title, and so a key; some of their values differ.
POSTINGS_SQL = """
SELECT d.doc_id AS row_id,
       concat('Role ', CAST(length(d.text) % 23 AS VARCHAR(20)), ' - 00123') AS title,
       concat('<p>', d.text, '</p> &amp; more') AS description,
       CASE WHEN d.doc_id % 5 = 0 THEN ''
            WHEN d.doc_id % 10 = 3 THEN 'Contract'
            WHEN d.doc_id % 50 = 7 THEN 'Volunteer'
            WHEN length(d.text) % 3 = 0 THEN 'Part-time' ELSE ' Full-time ' END AS formatted_work_type,
       CASE length(d.text) % 7 WHEN 0 THEN 'Internship' WHEN 1 THEN 'Entry level' WHEN 2 THEN 'Associate'
            WHEN 3 THEN 'Mid-Senior level' WHEN 4 THEN 'Director' WHEN 5 THEN 'Executive' ELSE '' END AS formatted_experience_level,
       CASE WHEN length(d.text) % 8 = 0 THEN '1.0' WHEN length(d.text) % 8 = 1 THEN '1' ELSE '' END AS remote_allowed
FROM documents d
"""

_INDUSTRY_NAMES = ["Technology & IT", "Finance & Banking", "Healthcare & Caregiving", "Retail & E-commerce"]
_ROLE_NAMES = [
    "Software Developer",
    "Accountant & Finance",
    "Healthcare Professional",
    "Sales Representative",
    "Driver & Logistics",
    "Others",
]


def _choose(expression: str, names: list[str]) -> str:
    branches = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE {expression} % {len(names)} {branches} END"


TRAINING_SQL = f"""
SELECT d.doc_id AS row_id,
       concat('Role ', CAST(length(d.text) % 23 AS VARCHAR(20))) AS title,
       d.text AS description,
       {_choose("length(d.text)", _INDUSTRY_NAMES)} AS industry,
       {_choose("length(d.text)", _ROLE_NAMES)} AS role
FROM documents d
"""

PREDICTIONS_SQL = """
SELECT vec_id AS row_id, label AS y,
       CASE WHEN ((vec_id * 7919) % 1000) >= 550 OR (vec_id * 104729) % 10 < 4
            THEN label ELSE (label + 1) % 10 END AS p,
       (label + 2) % 10 AS second,
       round(0.2e0 + 0.8e0 * CAST((vec_id * 7919) % 1000 AS DOUBLE) / 1000e0, 6) AS conf
FROM embeddings
"""

_LEVELS = ["Internship", "Entry level", "Associate", "Mid-Senior level", "Director", "Executive"]

# The same predictions read as source experience levels.
LEVEL_PREDICTIONS_SQL = f"""
SELECT row_id, {_choose("y", _LEVELS)} AS y, {_choose("p", _LEVELS)} AS p, conf
FROM ({PREDICTIONS_SQL}) q
"""

VIEWS = {
    "jobs": JOBS_SQL,
    "postings": POSTINGS_SQL,
    "training": TRAINING_SQL,
    "predictions": PREDICTIONS_SQL,
    "level_predictions": LEVEL_PREDICTIONS_SQL,
}

TABLES = ["documents", "embeddings", "labels", "pages", "benchmark", "conversations", "events"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the views above over the tables of a folder."""
    return spark.sql(
        _named(VIEWS[name]),
        documents=table(spark, folder, "documents"),
        embeddings=table(spark, folder, "embeddings"),
    )


def _named(sql: str) -> str:
    """Table names as parameters, so that no temporary view is left behind."""
    return sql.replace("FROM documents d", "FROM {documents} d").replace(
        "FROM embeddings", "FROM {embeddings}"
    )


# Jobs with labels as a model might have given them, for the rule layers.
MODEL_SQL = f"""
SELECT id, title, description,
       CASE length(description) % 4 WHEN 0 THEN 'Finance & Banking' WHEN 1 THEN 'Technology & IT' ELSE 'Retail & E-commerce' END AS industry,
       CASE length(description) % 3 WHEN 0 THEN 'Others' WHEN 1 THEN 'Executive' ELSE 'Data Analyst' END AS role,
       CASE length(description) % 5 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Contract' WHEN 2 THEN 'Part-time' WHEN 3 THEN 'Internship' ELSE '' END AS job_type,
       CASE length(description) % 3 WHEN 0 THEN 'Mid' WHEN 1 THEN 'Entry' ELSE 'Senior' END AS experience_level,
       CASE length(description) % 2 WHEN 0 THEN 'Blue' ELSE 'White' END AS collar,
       CASE length(description) % 3 WHEN 0 THEN 'Remote' WHEN 1 THEN 'On-site' ELSE 'Hybrid' END AS remote_mode
FROM ({JOBS_SQL}) j
"""

# Updates for two thirds of the jobs and for some ids no job has.
UPDATES_SQL = """
SELECT CASE WHEN d.doc_id % 10 = 9 THEN concat('none-', CAST(d.doc_id AS VARCHAR(20)))
            ELSE lpad(CAST(d.doc_id AS VARCHAR(20)), 12, '0') END AS id,
       CASE WHEN d.doc_id % 2 = 0 THEN 'Technology & IT' END AS industry,
       CASE WHEN d.doc_id % 3 = 0 THEN 'Data Analyst' ELSE 'Others' END AS role,
       CASE WHEN d.doc_id % 4 = 0 THEN 'Blue' END AS collar,
       CASE WHEN length(d.text) % 2 = 0 THEN 'Senior' END AS experience_level,
       CASE WHEN length(d.text) % 3 = 0 THEN 'Contract' END AS job_type
FROM documents d
WHERE length(d.text) % 3 <> 1
"""

# Predictions with the facts of a gated, an ungated and a missing head.
REVIEW_SQL = f"""
SELECT row_id, CASE WHEN p = 3 THEN 'Others' ELSE concat('class ', CAST(p AS VARCHAR(4))) END AS label,
       concat('class ', CAST(second AS VARCHAR(4))) AS second, conf,
       CASE WHEN row_id % 3 <> 0 THEN CAST(0.7 AS DOUBLE) END AS threshold,
       row_id % 3 <> 0 AS gatable, row_id % 4 = 0 AS rule_fired, row_id % 5 <> 0 AS present
FROM ({PREDICTIONS_SQL}) q
"""

VIEWS["model"] = MODEL_SQL
VIEWS["updates"] = UPDATES_SQL
VIEWS["review"] = REVIEW_SQL
