"""Text functions and the keyword tier."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sortlane.catalog.fixtures import table, view
from sortlane.catalog.registry import (
    cases,
    description_sql,
    fold_sql,
    group_sql,
    hit,
    low_hit,
    model_text_sql,
    no_tags,
    over,
    query,
    stripped,
    title_sql,
)
from sortlane.functions import text as fn
from sortlane.operators import keyword as kw
from sortlane.rules import keyword as rules

STAMP = datetime(2024, 6, 1)
STAMP_SQL = "TIMESTAMP '2024-06-01 00:00:00'"


@query(
    "t1_clean_title",
    over("jobs", f"SELECT id, {title_sql('title')} AS clean_title FROM jobs"),
)
def clean_title(spark, folder):
    jobs = view(spark, folder, "jobs")
    return jobs.select("id", fn.clean_title(F.col("title")).alias("clean_title"))


@query(
    "t2_clean_description",
    f"""SELECT 'page' AS kind, page_id AS item, {description_sql('html')} AS clean FROM pages
    UNION ALL SELECT 'document', doc_id, {description_sql('text')} FROM documents""",
)
def clean_description(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("item"), F.col("html").alias("raw")
    )
    documents = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("item"), F.col("text").alias("raw")
    )
    both = pages.unionByName(documents)
    return both.select("kind", "item", fn.clean_description(F.col("raw")).alias("clean"))


@query(
    "t3_join_key",
    over(
        "postings",
        f"""SELECT row_id, {fold_sql(title_sql('title'))} AS key_title,
        {fold_sql('substring(' + description_sql('description') + ', 1, 180)')} AS key_description
        FROM postings""",
    ),
)
def join_key(spark, folder):
    postings = view(spark, folder, "postings")
    return postings.select(
        "row_id",
        fn.key_title(F.col("title")).alias("key_title"),
        fn.key_description(F.col("description")).alias("key_description"),
    )


@query("t4_strip_html", f"SELECT page_id, {no_tags('html')} AS plain FROM pages")
def strip_html(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", fn.strip_html(F.col("html")).alias("plain"))


@query(
    "t5_model_text",
    over("jobs", f"SELECT id, {model_text_sql('title', 'description')} AS model_text FROM jobs"),
)
def model_text(spark, folder):
    jobs = view(spark, folder, "jobs")
    return jobs.select(
        "id", fn.model_text(F.col("title"), F.col("description")).alias("model_text")
    )


@query(
    "t6_training_text",
    over(
        "jobs",
        "SELECT id, "
        + stripped("concat(coalesce(title, ''), ' . ', coalesce(description, ''))")
        + " AS training_text FROM jobs",
    ),
)
def training_text(spark, folder):
    jobs = view(spark, folder, "jobs")
    return jobs.select(
        "id", fn.training_text(F.col("title"), F.col("description")).alias("training_text")
    )


@query(
    "t7_group_key",
    f"""SELECT 'document' AS kind, doc_id AS item, {group_sql('text')} AS group_key FROM documents
    UNION ALL SELECT 'turn', conv_id * 1000 + turn, {group_sql('text')} FROM conversations
    UNION ALL SELECT 'benchmark', item_id, {group_sql('text')} FROM benchmark""",
)
def group_key(spark, folder):
    parts = [
        ("document", table(spark, folder, "documents").withColumn("item", F.col("doc_id"))),
        (
            "turn",
            table(spark, folder, "conversations").withColumn(
                "item", F.col("conv_id") * 1000 + F.col("turn")
            ),
        ),
        ("benchmark", table(spark, folder, "benchmark").withColumn("item", F.col("item_id"))),
    ]
    frames = [
        df.select(F.lit(kind).alias("kind"), "item", fn.group_key(F.col("text")).alias("group_key"))
        for kind, df in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


NON_ENGLISH_SQL = hit(
    "concat(coalesce(title, ''), ' ', substring(coalesce(description, ''), 1, 200))",
    fn.NON_ENGLISH,
)


@query(
    "t8_non_english", over("training", f"SELECT row_id, {NON_ENGLISH_SQL} AS non_english FROM training")
)
def non_english(spark, folder):
    rows = view(spark, folder, "training")
    return rows.select(
        "row_id", fn.non_english(F.col("title"), F.col("description")).alias("non_english")
    )


@query(
    "t9_encoder_text",
    over(
        "jobs",
        f"SELECT id, concat('query: ', {model_text_sql('title', 'description')}) AS encoder_text FROM jobs",
    ),
)
def encoder_text(spark, folder):
    jobs = view(spark, folder, "jobs")
    return jobs.select(
        "id", fn.encoder_text(F.col("title"), F.col("description")).alias("encoder_text")
    )


@query(
    "t10_lowered_text",
    over(
        "jobs",
        """SELECT id, lower(coalesce(title, '')) AS lowered_title,
        lower(concat(coalesce(title, ''), ' ', coalesce(description, ''))) AS lowered_text FROM jobs""",
    ),
)
def lowered_text(spark, folder):
    jobs = view(spark, folder, "jobs")
    return jobs.select(
        "id",
        fn.lowered_title(F.col("title")).alias("lowered_title"),
        fn.lowered_text(F.col("title"), F.col("description")).alias("lowered_text"),
    )


# --- keyword tier ---------------------------------------------------------------------

JOB_TYPE_SQL = f"""CASE
WHEN {low_hit('t', rules.PER_DIEM)} THEN 'Per Diem'
WHEN {low_hit('t', rules.TRAVEL)} OR {low_hit('t', rules.WEEKS)} THEN 'Contract'
WHEN {low_hit('t', rules.GIG_PLATFORM)} AND {low_hit('t', rules.GIG_ACTIVITY)} THEN 'Contract'
{cases('t', rules.JOB_TYPE_WORDS)} END"""

KEYWORD_SQL = {
    "role": f"CASE {cases('t', rules.ROLE)} END",
    "industry": f"CASE {cases('t', rules.INDUSTRY)} END",
    "collar": f"CASE {cases('t', rules.COLLAR)} END",
    "remote_mode": f"CASE {cases('t', rules.REMOTE_MODE)} END",
    "job_type": JOB_TYPE_SQL,
    "experience_level": f"CASE {cases('t', rules.EXPERIENCE)} END",
}

LOWERED = "lowered AS (SELECT *, lower(coalesce(title, '')) AS t FROM jobs)"


def _keyword_query(number: int, column: str):
    name = f"k{number}_keyword_{column}"
    sql = over("jobs", f"SELECT id, {KEYWORD_SQL[column]} AS {column} FROM lowered", LOWERED)

    @query(name, sql)
    def run(spark, folder, column=column):
        jobs = view(spark, folder, "jobs")
        lowered = jobs.select("id", fn.lowered_title(F.col("title")).alias("t"))
        return lowered.select("id", kw.CASCADES[column](F.col("t")).alias(column))

    return run


for _number, _column in enumerate(
    ["role", "industry", "collar", "remote_mode", "job_type", "experience_level"], start=1
):
    _keyword_query(_number, _column)


def keyword_merge_ctes(source: str = "jobs") -> str:
    new = ", ".join(f"{sql} AS n_{c}" for c, sql in KEYWORD_SQL.items())
    return f"""lowered AS (SELECT *, lower(coalesce(title, '')) AS t FROM {source}),
    calc AS (SELECT *, {new} FROM lowered),
    keyword_merged AS (
      SELECT id, title, description, remote,
        CASE WHEN coalesce(job_type_feed, '') = '' THEN n_job_type ELSE job_type_feed END AS job_type_feed,
        coalesce(experience_level, n_experience_level) AS experience_level,
        coalesce(n_industry, industry) AS industry,
        coalesce(n_role, role) AS role,
        CASE WHEN n_role IS NOT NULL THEN 'keyword_25v1' ELSE role_method END AS role_method,
        CASE WHEN n_role IS NOT NULL THEN CAST(0.95 AS DOUBLE) ELSE role_confidence END AS role_confidence,
        CASE WHEN n_role IS NOT NULL THEN {STAMP_SQL} ELSE role_updated_at END AS role_updated_at,
        coalesce(collar, n_collar) AS collar,
        coalesce(remote_mode, n_remote_mode) AS remote_mode,
        is_active, classified_at
      FROM calc)"""


@query("k7_keyword_merge", over("jobs", "SELECT * FROM keyword_merged", keyword_merge_ctes()))
def keyword_merge(spark, folder):
    return kw.keyword_merge(view(spark, folder, "jobs"), STAMP)


PAGE_AFTER, PAGE_ROWS = "000000000100", 250
PAGE_CTE = (
    f"page AS (SELECT * FROM jobs WHERE id > '{PAGE_AFTER}' ORDER BY id LIMIT {PAGE_ROWS})"
)


@query(
    "k8_keyword_chunk",
    over("jobs", "SELECT * FROM keyword_merged", PAGE_CTE + ", " + keyword_merge_ctes("page")),
)
def keyword_chunk(spark, folder):
    return kw.keyword_chunk(view(spark, folder, "jobs"), PAGE_AFTER, STAMP, PAGE_ROWS)[0]


@query("k8_keyword_cursor", over("jobs", "SELECT max(id) AS after_id FROM page", PAGE_CTE))
def keyword_cursor(spark, folder):
    return kw.keyword_chunk(view(spark, folder, "jobs"), PAGE_AFTER, STAMP, PAGE_ROWS)[1]


@query(
    "k_role_by_industry",
    over(
        "jobs",
        "SELECT role, industry, count(*) AS n FROM keyword_merged GROUP BY ALL",
        keyword_merge_ctes(),
    ),
)
def role_by_industry(spark, folder):
    merged = kw.keyword_merge(view(spark, folder, "jobs"), STAMP)
    return merged.groupBy("role", "industry").agg(F.count("*").alias("n"))
