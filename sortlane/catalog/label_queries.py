"""Label recovery, curation, joins, merges and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from sortlane.catalog.fixtures import table, view
from sortlane.catalog.registry import (
    cases,
    group_sql,
    hit,
    key_sql,
    low_hit,
    over,
    over_many,
    query,
    stripped,
)
from sortlane.catalog.rule_queries import COLUMN_RULE_CTES, TITLE_RULE_CTE, TITLED
from sortlane.catalog.text_queries import NON_ENGLISH_SQL, STAMP, STAMP_SQL, keyword_merge_ctes
from sortlane.functions.text import group_hash
from sortlane.operators import curation, features, labels, merge, remote
from sortlane.plans.daily import daily_run, dry_run, rules_only
from sortlane.rules import remote as remote_rules

# --- label recovery -------------------------------------------------------------------

SOURCE_CTE = f"""source AS (SELECT row_id, {key_sql('title', 'description')} AS k,
  nullif({stripped('formatted_work_type')}, '') AS work_type,
  nullif({stripped('formatted_experience_level')}, '') AS experience,
  nullif({stripped('remote_allowed')}, '') AS remote FROM postings)"""
UNANIMOUS_CTE = """unanimous AS (SELECT k,
  CASE WHEN count(DISTINCT work_type) = 1 THEN any_value(work_type) END AS work_type,
  CASE WHEN count(DISTINCT experience) = 1 THEN any_value(experience) END AS experience,
  CASE WHEN count(DISTINCT remote) = 1 THEN any_value(remote) END AS remote FROM source GROUP BY k)"""
WANTED_CTE = f"wanted AS (SELECT *, {key_sql('title', 'description')} AS k FROM training)"
COLLAR_SQL = """CASE WHEN role IN ('Healthcare Professional', 'Driver & Logistics', 'Construction & Real Estate') THEN 'Blue'
  WHEN role IN ('Software Developer', 'Accountant & Finance', 'Sales Representative') THEN 'White' END"""
RECOVERED_CTE = f"""recovered AS (SELECT row_id, title, description, industry, w.role,
  u.work_type AS job_type, u.experience AS experience_band,
  CASE WHEN u.remote IN ('1.0', '1') THEN 'Remote' END AS remote_type, {COLLAR_SQL} AS collar
  FROM wanted w LEFT JOIN unanimous u ON w.k = u.k)"""
RECOVERY = ", ".join([SOURCE_CTE, UNANIMOUS_CTE, WANTED_CTE, RECOVERED_CTE])


def _recovered(spark, folder):
    return labels.recover_labels(view(spark, folder, "training"), view(spark, folder, "postings"))


@query(
    "l1_unanimous_labels",
    over("postings", "SELECT md5(k) AS k, work_type, experience, remote FROM unanimous", f"{SOURCE_CTE}, {UNANIMOUS_CTE}"),
)
def unanimous_labels(spark, folder):
    found = labels.unanimous_labels(view(spark, folder, "postings"))
    return found.select(F.lower(F.hex("key")).alias("k"), "work_type", "experience", "remote")


@query(
    "l2_join_conflicts",
    over(
        "postings",
        """SELECT field, (SELECT count(*) FROM per_key) AS unique_keys,
        (SELECT count(*) FROM per_key WHERE n > 1) AS multi_row_keys,
        round(100.0e0 * (SELECT count(*) FROM per_key WHERE n > 1) / (SELECT count(*) FROM per_key), 6) AS multi_row_pct,
        count(*) FILTER (d > 0) AS with_value, count(*) FILTER (d = 1) AS unanimous,
        count(*) FILTER (d > 1) AS conflicting,
        round(100.0e0 * count(*) FILTER (d = 1) / nullif(count(*) FILTER (d > 0), 0), 6) AS unanimous_pct
        FROM (SELECT 'formatted_work_type' AS field, d1 AS d FROM per_key
          UNION ALL SELECT 'formatted_experience_level', d2 FROM per_key
          UNION ALL SELECT 'remote_allowed', d3 FROM per_key) GROUP BY field""",
        SOURCE_CTE
        + """, per_key AS (SELECT k, count(*) AS n, count(DISTINCT work_type) AS d1,
        count(DISTINCT experience) AS d2, count(DISTINCT remote) AS d3 FROM source GROUP BY k)""",
    ),
)
def join_conflicts(spark, folder):
    return labels.join_conflicts(view(spark, folder, "postings"))


@query("j1_recover_labels", over_many(["postings", "training"], "SELECT * FROM recovered", RECOVERY))
def recover_labels(spark, folder):
    return _recovered(spark, folder)


@query(
    "j2_last_wins_join",
    over_many(
        ["postings", "training"],
        """SELECT w.row_id, w.title, w.description, w.industry, w.role, l.work_type, l.experience, l.remote,
        l.k IS NOT NULL AS joined FROM wanted w LEFT JOIN (SELECT * FROM source
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_id DESC) = 1) l ON w.k = l.k""",
        f"{SOURCE_CTE}, {WANTED_CTE}",
    ),
)
def last_wins_join(spark, folder):
    return labels.last_wins_join(view(spark, folder, "training"), view(spark, folder, "postings"))


@query(
    "j3_join_rate",
    over_many(
        ["postings", "training"],
        """SELECT count(*) AS training_rows, count(*) FILTER (k IN (SELECT k FROM source)) AS joined_rows,
        round(100.0e0 * count(*) FILTER (k IN (SELECT k FROM source)) / count(*), 6) AS joined_pct FROM wanted""",
        f"{SOURCE_CTE}, {WANTED_CTE}",
    ),
)
def join_rate(spark, folder):
    return labels.join_rate(view(spark, folder, "training"), view(spark, folder, "postings"))


@query(
    "j6_embedding_join",
    """SELECT d.doc_id AS row_id, d.lang, e.embedding FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id""",
)
def embedding_join(spark, folder):
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    return features.embedding_join(rows, vectors)


@query("j7_role_to_collar", over("training", f"SELECT row_id, role, {COLLAR_SQL} AS collar FROM training"))
def role_to_collar(spark, folder):
    rows = view(spark, folder, "training")
    return rows.select("row_id", "role", labels.collar_from_role(F.col("role")).alias("collar"))


FIELDS = ["formatted_work_type", "formatted_experience_level", "remote_allowed"]
FILLED_CTES = (
    "long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce(nullif({stripped(c)}, ''), '(empty)') AS value FROM postings"
        for c in FIELDS
    )
    + """), counted AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY column_name) AS total,
     sum(CASE WHEN value = '(empty)' THEN 0 ELSE n END) OVER (PARTITION BY column_name) AS got,
     row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM counted)"""
)


@query(
    "l3_fill_rates",
    over(
        "postings",
        """SELECT column_name, CAST(total AS BIGINT) AS rows, CAST(got AS BIGINT) AS filled,
        round(100.0e0 * got / total, 6) AS filled_pct, CAST(rank AS INTEGER) AS rank, value, n,
        round(100.0e0 * n / total, 6) AS pct FROM ranked WHERE rank <= 12""",
        FILLED_CTES,
    ),
)
def fill_rates(spark, folder):
    return labels.fill_rates(view(spark, folder, "postings"), FIELDS)


@query(
    "l4_remote_from_flag",
    over(
        "postings",
        "SELECT row_id, CASE WHEN remote_allowed IN ('1.0', '1') THEN 'Remote' END AS remote_type FROM postings",
    ),
)
def remote_from_flag(spark, folder):
    rows = view(spark, folder, "postings")
    return rows.select("row_id", labels.remote_from_flag(F.col("remote_allowed")).alias("remote_type"))


@query(
    "l5_collar_from_role",
    f"SELECT role, collar, count(*) AS n FROM (SELECT *, {COLLAR_SQL} AS collar FROM ("
    + over("training", "SELECT * FROM training")
    + ") q) GROUP BY ALL",
)
def collar_from_role(spark, folder):
    rows = view(spark, folder, "training").withColumn(
        "collar", labels.collar_from_role(F.col("role"))
    )
    return rows.groupBy("role", "collar").agg(F.count("*").alias("n"))


@query(
    "l6_vocabulary_maps",
    over(
        "postings",
        """SELECT row_id,
        CASE trim(formatted_work_type) WHEN 'Full-time' THEN 'Full-time' WHEN 'Contract' THEN 'Contract'
          WHEN 'Part-time' THEN 'Part-time' WHEN 'Internship' THEN 'Internship' WHEN 'Temporary' THEN 'Temporary' END AS job_type,
        CASE WHEN formatted_experience_level IN ('Internship', 'Entry level') THEN 'Entry'
          WHEN formatted_experience_level IN ('Associate', 'Mid-Senior level') THEN 'Mid'
          WHEN formatted_experience_level = 'Director' THEN 'Senior'
          WHEN formatted_experience_level = 'Executive' THEN 'Executive' END AS experience_4,
        CASE WHEN formatted_experience_level IN ('Internship', 'Entry level') THEN 'Entry'
          WHEN formatted_experience_level IN ('Associate', 'Mid-Senior level') THEN 'Mid-Senior'
          WHEN formatted_experience_level IN ('Director', 'Executive') THEN 'Senior'
          ELSE formatted_experience_level END AS experience_3 FROM postings""",
    ),
)
def vocabulary_maps(spark, folder):
    rows = view(spark, folder, "postings")
    level = F.col("formatted_experience_level")
    return rows.select(
        "row_id",
        labels.map_job_type(F.col("formatted_work_type")).alias("job_type"),
        labels.map_experience4(level).alias("experience_4"),
        labels.map_experience3(level).alias("experience_3"),
    )


TEXT_LABEL_CTES = "signals AS (SELECT *, " + ", ".join(
    f"CAST({hit('concat(coalesce(title, ' + chr(39) * 2 + '), chr(10), coalesce(description, ' + chr(39) * 2 + '))', p)} AS INTEGER) AS s{i}"
    for i, (_, p) in enumerate(remote_rules.LABEL_SIGNALS)
) + " FROM jobs)"


@query(
    "l7_text_remote_label",
    over(
        "jobs",
        """SELECT id, CASE WHEN s0 + s1 + s2 > 1 THEN NULL WHEN s0 = 1 THEN 'Remote' WHEN s1 = 1 THEN 'Hybrid'
        WHEN s2 = 1 THEN 'On-site' WHEN remote THEN 'Remote' END AS remote_label FROM signals""",
        TEXT_LABEL_CTES,
    ),
)
def text_remote_label(spark, folder):
    jobs = view(spark, folder, "jobs").withColumn(
        "remote_type", F.when(F.col("remote"), F.lit("Remote"))
    )
    return remote.with_training_label(jobs).select("id", "remote_label")


@query(
    "l8_inferred_negative",
    over_many(
        ["postings", "training"],
        """SELECT row_id, CASE WHEN remote_type IS NOT NULL THEN 'Remote' ELSE 'Not-remote' END AS remote_binary
        FROM recovered WHERE job_type IS NOT NULL""",
        RECOVERY,
    ),
)
def inferred_negative(spark, folder):
    return labels.inferred_remote_negative(_recovered(spark, folder)).select("row_id", "remote_binary")


LABEL_COLUMNS = ["industry", "role", "job_type", "experience_band", "remote_type", "collar"]


@query(
    "l9_label_coverage",
    over_many(
        ["postings", "training"],
        """SELECT t.column_name, t.rows, t.labelled, round(100.0e0 * t.labelled / t.rows, 6) AS labelled_pct,
        c.value, c.n, round(100.0e0 * c.n / t.labelled, 6) AS class_pct
        FROM totals t LEFT JOIN counted c ON t.column_name = c.column_name""",
        RECOVERY
        + ", long AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM recovered" for c in LABEL_COLUMNS)
        + """), totals AS (SELECT column_name, count(*) AS rows, count(value) AS labelled FROM long GROUP BY ALL),
        counted AS (SELECT column_name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)""",
    ),
)
def label_coverage(spark, folder):
    return labels.label_coverage(_recovered(spark, folder), LABEL_COLUMNS)


FLOOR = 12
SIZES_SQL = f"""SELECT lang || '/' || source AS class, count(*) AS n, count(*) < {FLOOR} AS dropped
 FROM documents GROUP BY ALL"""


def _classes(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", F.concat("lang", F.lit("/"), "source").alias("class"))


@query("l10_class_sizes", SIZES_SQL)
def class_sizes(spark, folder):
    return curation.class_sizes(_classes(spark, folder), "class", FLOOR)


@query(
    "l10_class_floor",
    f"""SELECT doc_id, lang || '/' || source AS class FROM documents
    WHERE lang || '/' || source IN (SELECT class FROM ({SIZES_SQL}) s WHERE NOT dropped)""",
)
def class_floor(spark, folder):
    return curation.class_floor(_classes(spark, folder), "class", FLOOR, "doc_id")


CURATED_CTES = f"""english AS (SELECT *, {group_sql('description')} AS g FROM training WHERE NOT {NON_ENGLISH_SQL}),
 curated AS (SELECT * FROM english QUALIFY row_number() OVER (PARTITION BY g ORDER BY row_id) <= 2)"""


@query(
    "l11_cap_per_group",
    over("training", "SELECT row_id, title, description, industry, role, md5(g) AS group_hash FROM curated", CURATED_CTES),
)
def cap_per_group(spark, folder):
    kept = curation.curate(view(spark, folder, "training"))
    return kept.withColumn("group_hash", F.lower(F.hex("group_hash")))


@query(
    "w1_first_per_group",
    f"""SELECT doc_id FROM documents
    QUALIFY row_number() OVER (PARTITION BY {group_sql('text')} ORDER BY doc_id) <= 3""",
)
def first_per_group(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", group_hash(F.col("text")).alias("g"))
    return curation.cap_per_group(rows, "g", "doc_id", 3).select("doc_id")


MODEL_COLUMNS = ["industry", "role", "job_type", "experience_level", "collar", "remote_mode"]


@query(
    "l12_column_coverage",
    over(
        "model",
        """SELECT t.column_name, t.rows, t.filled, round(100.0e0 * t.filled / t.rows, 6) AS filled_pct,
        CAST(r.rank AS INTEGER) AS rank, r.value, r.n FROM totals t LEFT JOIN ranked r ON t.column_name = r.column_name AND r.rank <= 6""",
        "long AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM model" for c in MODEL_COLUMNS)
        + """), totals AS (SELECT column_name, count(*) AS rows, count(nullif(value, '')) AS filled FROM long GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM
          (SELECT column_name, value, count(*) AS n FROM long WHERE coalesce(value, '') <> '' GROUP BY ALL))""",
    ),
)
def column_coverage(spark, folder):
    return labels.column_coverage(view(spark, folder, "model"), MODEL_COLUMNS)


@query(
    "w2_class_size_per_row",
    "SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS class_size FROM documents",
)
def class_size_per_row(spark, folder):
    from sortlane.plans.bounded import lookup_join

    documents = table(spark, folder, "documents").select("doc_id", "lang")
    sizes = documents.groupBy("lang").agg(F.count("*").alias("class_size"))
    return lookup_join(documents, sizes, "lang", "doc_id")


@query(
    "w6_top_values",
    """SELECT source AS value, count(*) AS n FROM documents GROUP BY ALL ORDER BY n DESC, value LIMIT 6""",
)
def top_values(spark, folder):
    from sortlane.plans.bounded import value_counts

    counts = value_counts(table(spark, folder, "documents"), ["source"])
    return counts.select("value", "n").orderBy(F.desc("n"), "value").limit(6)


# --- scans and merges -----------------------------------------------------------------


@query(
    "s4_scan_unclassified",
    over(
        "jobs",
        """SELECT id, title, description, job_type_feed FROM jobs
        WHERE classified_at IS NULL AND id > '000000000050' ORDER BY id LIMIT 300""",
    ),
)
def scan_unclassified(spark, folder):
    return merge.scan_unclassified(view(spark, folder, "jobs"), "000000000050", 300)


@query(
    "s5_scan_active_sample",
    over("jobs", "SELECT id, title, description FROM jobs WHERE is_active ORDER BY id LIMIT 500"),
)
def scan_active_sample(spark, folder):
    return merge.scan_active_sample(view(spark, folder, "jobs"), 500)


@query(
    "u3_queue",
    over("jobs", "SELECT id, title, role FROM jobs WHERE classified_at IS NULL"),
)
def queue(spark, folder):
    return merge.unclassified(view(spark, folder, "jobs")).select("id", "title", "role")


def fill_blanks_cte(jobs: str, updates: str, name: str = "merged") -> str:
    """U1 over two relations, in the column order of the jobs table."""
    return f"""{name} AS (SELECT j.id, title, description, remote,
      CASE WHEN u.id IS NULL THEN job_type_feed WHEN coalesce(job_type_feed, '') = '' THEN u.job_type ELSE job_type_feed END AS job_type_feed,
      CASE WHEN u.id IS NULL THEN j.experience_level ELSE coalesce(nullif(trim(j.experience_level), ''), u.experience_level) END AS experience_level,
      CASE WHEN u.id IS NULL THEN j.industry ELSE coalesce(nullif(trim(j.industry), ''), u.industry) END AS industry,
      CASE WHEN u.id IS NULL THEN j.role ELSE coalesce(nullif(trim(j.role), ''), u.role) END AS role,
      role_method, role_confidence, role_updated_at,
      coalesce(j.collar, u.collar) AS collar, remote_mode, is_active,
      CASE WHEN u.id IS NULL THEN classified_at ELSE {STAMP_SQL} END AS classified_at
      FROM {jobs} j LEFT JOIN {updates} u ON j.id = u.id)"""


MERGED_SQL = over_many(["jobs", "updates"], "SELECT * FROM merged", fill_blanks_cte("jobs", "updates"))


@query("j4_apply_updates", MERGED_SQL)
def apply_updates(spark, folder):
    return merge.apply_updates(view(spark, folder, "jobs"), view(spark, folder, "updates"), STAMP)


@query(
    "j4_count_updated",
    over_many(["jobs", "updates"], "SELECT count(*) AS n_updated FROM jobs WHERE id IN (SELECT id FROM updates)"),
)
def count_updated(spark, folder):
    return merge.count_updated(view(spark, folder, "jobs"), view(spark, folder, "updates"))


@query(
    "u1_fill_blanks_json",
    MERGED_SQL,
)
def fill_blanks_json(spark, folder):
    """The updates arrive as JSON arrays, one for the ids that share all but the last two digits."""
    updates = view(spark, folder, "updates")
    payloads = updates.groupBy(F.expr("substring(id, 1, length(id) - 2)").alias("part")).agg(
        F.to_json(F.collect_list(F.struct("id", *merge.UPDATE_COLUMNS))).alias("payload")
    )
    rows = merge.read_update_json(spark, F.col("payload"), payloads)
    return merge.apply_updates(view(spark, folder, "jobs"), rows, STAMP, unique_ids=True)


LOW_TEXT = "lower(concat(coalesce(title, ''), ' ', coalesce(description, '')))"


def fill_remote_sql(text: str = "lt") -> str:
    return f"""CASE WHEN remote_mode IS NOT NULL THEN remote_mode WHEN remote THEN 'Remote'
      WHEN {low_hit(text, remote_rules.FILL_REMOTE)} THEN 'Remote'
      WHEN {low_hit(text, remote_rules.FILL_HYBRID)} THEN 'Hybrid' ELSE 'On-site' END"""


FILL_SQL = f"""SELECT id, {fill_remote_sql()} AS remote_mode FROM (SELECT *, {LOW_TEXT} AS lt FROM """


@query("u2_fill_remote_mode", over("jobs", FILL_SQL + "jobs) j"))
def fill_remote_mode(spark, folder):
    return remote.fill_remote_mode(view(spark, folder, "jobs")).select("id", "remote_mode")


@query(
    "u2_fill_page",
    over("jobs", FILL_SQL + "page) j", "page AS (SELECT * FROM jobs WHERE remote_mode IS NULL ORDER BY id LIMIT 400)"),
)
def fill_page(spark, folder):
    return remote.fill_page(view(spark, folder, "jobs"), 400).select("id", "remote_mode")


# The rule layers over unknown labels, as updates.
BLANK_CTE = """blank AS (SELECT id, title, description, '' AS industry, '' AS role, '' AS job_type,
  '' AS experience_level, '' AS collar, '' AS remote_mode FROM {source} WHERE classified_at IS NULL)"""


def rule_updates(source: str) -> str:
    return ", ".join(
        [
            BLANK_CTE.replace("{source}", source),
            TITLED.replace("{source}", "blank"),
            TITLE_RULE_CTE,
            COLUMN_RULE_CTES.replace("{source}", "title_ruled"),
            """rule_updates AS (SELECT id, nullif(new_industry, '') AS industry, nullif(new_role, '') AS role,
            nullif(new_collar, '') AS collar, nullif(new_experience, '') AS experience_level,
            nullif(new_job_type, '') AS job_type FROM column_ruled)""",
        ]
    )


@query(
    "u6_update_frame",
    over("jobs", "SELECT * FROM rule_updates", rule_updates("jobs")),
)
def update_frame(spark, folder):
    return merge.update_frame(rules_only(merge.unclassified(view(spark, folder, "jobs"))))


@query("s11_dry_run", over("jobs", "SELECT * FROM rule_updates", rule_updates("jobs")))
def dry_run_query(spark, folder):
    """Like ``u6``, through the dry run of the model tier."""
    rows = dry_run(view(spark, folder, "jobs"), rules_only)
    return rows.select("id", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in merge.UPDATE_COLUMNS])


DAILY_SQL = over(
    "jobs",
    f"""SELECT m.* REPLACE ({fill_remote_sql()} AS remote_mode) FROM
    (SELECT *, {LOW_TEXT} AS lt FROM merged) m""".replace("m.*", "m.* EXCLUDE (lt)"),
    keyword_merge_ctes() + ", " + rule_updates("keyword_merged") + ", " + fill_blanks_cte("keyword_merged", "rule_updates"),
)


@query("u5_daily_run", DAILY_SQL)
def daily(spark, folder):
    return daily_run(view(spark, folder, "jobs"), rules_only, STAMP)
