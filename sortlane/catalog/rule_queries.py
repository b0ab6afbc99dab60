"""Title rules, column rules and audit rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sortlane.catalog.fixtures import table, view
from sortlane.catalog.registry import cases, hit, over, query, quoted
from sortlane.functions.regex import with_long_text
from sortlane.functions.text import blank_if_null, title_and_text
from sortlane.operators import audit, columns, titles
from sortlane.rules import audit as audit_rules
from sortlane.rules import columns as column_rules
from sortlane.rules import titles as title_rules

# --- title rules ----------------------------------------------------------------------

TITLED = "titled AS (SELECT *, coalesce(title, '') AS t FROM {source})"

JUNK_SQL = f"({hit('t', title_rules.JUNK)} AND NOT {hit('t', title_rules.JUNK_EXEMPT)})"
LEADER_SQL = hit("t", title_rules.LEADER)


def _traps(pick) -> str:
    return "\n".join(
        f"WHEN {hit('t', p)} THEN {pick(i, r)}" for p, i, r in title_rules.TRAPS
    )


def _leaders(pick) -> str:
    return "\n".join(
        f"WHEN {LEADER_SQL} AND {hit('t', p)} THEN {pick(i, r)}"
        for p, i, r in title_rules.LEADER_FUNCTIONS
    )


TITLE_RULE_CTE = f"""title_ruled AS (SELECT *,
 CASE WHEN {JUNK_SQL} THEN 'Business Services & Consulting'
 {_traps(lambda i, r: quoted(i))} {_leaders(lambda i, r: quoted(i))} ELSE industry END AS new_industry,
 CASE WHEN {JUNK_SQL} THEN 'Others'
 {_traps(lambda i, r: quoted(r))} {_leaders(lambda i, r: quoted(r) if r else 'role')} ELSE role END AS new_role,
 CASE WHEN {JUNK_SQL} THEN 'junk-gig'
 {_traps(lambda i, r: "'trap'")} {_leaders(lambda i, r: "'leader-function'")} ELSE '' END AS title_reason
 FROM titled)"""


@query(
    "g1_participation_offer",
    over("model", f"SELECT id, {JUNK_SQL} AS offer FROM titled", TITLED.replace("{source}", "model")),
)
def participation_offer(spark, folder):
    rows = view(spark, folder, "model").withColumn("t", blank_if_null(F.col("title")))
    return rows.select("id", titles.is_participation_offer(F.col("t")).alias("offer"))


def _title_rule_query(name: str, reason: str):
    sql = over(
        "model",
        f"SELECT id, new_industry AS industry, new_role AS role FROM title_ruled WHERE title_reason = '{reason}'",
        TITLED.replace("{source}", "model") + ", " + TITLE_RULE_CTE,
    )

    @query(name, sql)
    def run(spark, folder):
        ruled = titles.apply_title_rules(view(spark, folder, "model"))
        return ruled.filter(F.col("title_reason") == reason).select("id", "industry", "role")


_title_rule_query("g2_title_trap", "trap")
_title_rule_query("g3_leader_function", "leader-function")


@query(
    "g4_title_rules",
    over(
        "model",
        "SELECT id, new_industry AS industry, new_role AS role, title_reason FROM title_ruled",
        TITLED.replace("{source}", "model") + ", " + TITLE_RULE_CTE,
    ),
)
def title_rule_query(spark, folder):
    ruled = titles.apply_title_rules(view(spark, folder, "model"))
    return ruled.select("id", "industry", "role", "title_reason")


@query(
    "g5_second_label",
    over(
        "review",
        "SELECT row_id, conf < 0.7e0 AND label <> 'Others' AS wants_second FROM review",
    ),
)
def second_label(spark, folder):
    rows = view(spark, folder, "review")
    wants = titles.wants_second_label(F.col("label"), F.col("conf"), F.lit(0.7))
    return rows.select("row_id", wants.alias("wants_second"))


# --- column rules ---------------------------------------------------------------------

SCOPED = """scoped AS (SELECT *, coalesce(title, '') AS t, coalesce(description, '') AS d,
 concat(coalesce(title, ''), chr(10), coalesce(description, '')) AS x FROM {source})"""


def _count_of(pattern: str) -> str:
    return f"len(regexp_extract_all(t, {quoted('(?i)' + pattern)}))"


# RE2 has no lookahead: some "contract" is not followed by a subject word.
BARE_CONTRACT = (
    f"{_count_of(chr(92) + 'bcontract' + chr(92) + 'b')} > "
    + _count_of(rf"\bcontract\b\s*({column_rules.CONTRACT_SUBJECTS})")
)
TITLE_TYPES = cases("t", [("title_" + v, p) for v, p in column_rules.TITLE_JOB_TYPE[:-1]], hit)
JOB_TYPE_CODE = f"""CASE
 WHEN {hit('x', column_rules.PER_DIEM)} THEN 'per_diem'
 WHEN {hit('x', column_rules.TRAVEL_CONTRACT)} THEN 'travel_contract'
 WHEN {hit('t', column_rules.GIG_PLATFORM)} AND {hit('x', column_rules.GIG_ACTIVITY)} THEN 'gig_platform'
 {TITLE_TYPES}
 WHEN {BARE_CONTRACT} THEN 'title_Contract' END"""

TITLE_LEVEL = f"CASE {cases('t', column_rules.TITLE_EXPERIENCE, hit)} END"
YEARS_MIN = (
    f"list_min(list_transform(regexp_extract_all(d, {quoted('(?i)' + column_rules.YEARS)}, 1),"
    " lambda y: CAST(y AS INTEGER)))"
)
COLLAR_CODE = f"""CASE WHEN {hit('t', column_rules.CLINICAL_TITLE)} THEN 'clinical_veto'
 WHEN {hit('t', column_rules.WHITE_TITLE)} THEN 'white_title'
 WHEN {hit('t', column_rules.BLUE_TITLE)} THEN 'trade_veto' END"""
REMOTE_RULE = f"""CASE WHEN {hit('x', column_rules.HYBRID_TEXT)} THEN 'Hybrid'
 WHEN {hit('x', column_rules.REMOTE_TEXT)} AND NOT {hit('t', column_rules.PHYSICAL_TITLE)} THEN 'Remote'
 ELSE 'On-site' END"""
NO_EXPERIENCE = hit("x", column_rules.NO_EXPERIENCE)

COLUMN_RULE_CTES = (
    SCOPED
    + f""", coded AS (SELECT *, {JOB_TYPE_CODE} AS jt_code, {TITLE_LEVEL} AS title_level,
 {YEARS_MIN} AS years, {NO_EXPERIENCE} AS no_experience, {COLLAR_CODE} AS collar_code,
 {REMOTE_RULE} AS remote_rule FROM scoped),
decided AS (SELECT *,
 CASE jt_code WHEN 'per_diem' THEN 'Per Diem' WHEN 'travel_contract' THEN 'Contract'
  WHEN 'gig_platform' THEN 'Contract' ELSE coalesce(replace(jt_code, 'title_', ''), job_type) END AS new_job_type,
 CASE WHEN title_level IS NOT NULL THEN title_level
  WHEN years <= 2 THEN 'Entry' WHEN years <= 5 THEN 'Mid' WHEN years IS NOT NULL THEN 'Senior'
  WHEN no_experience THEN 'Entry' ELSE experience_level END AS new_experience,
 CASE collar_code WHEN 'white_title' THEN 'White' WHEN 'clinical_veto' THEN 'Blue'
  WHEN 'trade_veto' THEN 'Blue' ELSE collar END AS new_collar
 FROM coded),
column_ruled AS (SELECT *, concat_ws(';',
 CASE WHEN jt_code IN ('per_diem', 'travel_contract', 'gig_platform') THEN 'job_type:' || jt_code
      WHEN jt_code IS NOT NULL AND new_job_type IS DISTINCT FROM job_type THEN 'job_type:' || jt_code END,
 CASE WHEN new_experience IS NOT DISTINCT FROM experience_level THEN NULL
      WHEN title_level IS NOT NULL THEN 'experience:title_' || new_experience
      WHEN years IS NOT NULL THEN 'experience:years_' || new_experience
      WHEN no_experience THEN 'experience:no_experience' END,
 CASE WHEN new_collar IS DISTINCT FROM collar THEN 'collar:' || collar_code END,
 CASE WHEN remote_rule IS DISTINCT FROM remote_mode THEN 'remote:rule_' || remote_rule END) AS new_notes
 FROM decided)"""
)


def _ruled(select: str, cte: str = COLUMN_RULE_CTES) -> str:
    return over("model", select, cte.replace("{source}", "model"))


def _scoped(spark, folder):
    """Rows with title ``t`` and description ``d``, and their joint text."""
    rows = view(spark, folder, "model")
    t, d = F.col("title"), F.col("description")
    named = rows.withColumns({"t": blank_if_null(t), "d": blank_if_null(d)})
    scoped, full, _ = with_long_text(named, "x", title_and_text(t, d))
    return scoped, full


@query(
    "g6_job_type_rule",
    _ruled("SELECT id, jt_code AS code, new_job_type AS job_type FROM decided"),
)
def job_type_rule(spark, folder):
    scoped, full = _scoped(spark, folder)
    coded = scoped.withColumn("code", columns.job_type_code(F.col("t"), full))
    value = columns.job_type_value(F.col("code"), F.col("job_type"))
    return coded.select("id", "code", value.alias("job_type"))


@query("g7_title_experience", _ruled("SELECT id, title_level AS level FROM coded"))
def title_experience(spark, folder):
    return _scoped(spark, folder)[0].select(
        "id", columns.title_experience(F.col("t")).alias("level")
    )


@query(
    "g8_stated_years",
    _ruled(
        """SELECT id, years, CASE WHEN years <= 2 THEN 'Entry' WHEN years <= 5 THEN 'Mid'
        WHEN years > 5 THEN 'Senior' END AS level FROM coded"""
    ),
)
def stated_years(spark, folder):
    return _scoped(spark, folder)[0].select(
        "id",
        columns.min_stated_years(F.col("d")).alias("years"),
        columns.years_level(F.col("d")).alias("level"),
    )


@query("g9_no_experience", _ruled("SELECT id, no_experience FROM coded"))
def no_experience(spark, folder):
    scoped, full = _scoped(spark, folder)
    return scoped.select("id", columns.states_no_experience(full).alias("no_experience"))


@query(
    "g10_collar_rule",
    _ruled("SELECT id, collar_code AS code, new_collar AS collar FROM decided"),
)
def collar_rule(spark, folder):
    coded = _scoped(spark, folder)[0].withColumn("code", columns.collar_code(F.col("t")))
    return coded.select("id", "code", columns.collar_value(F.col("code"), F.col("collar")).alias("collar"))


@query("g11_remote_rule", _ruled("SELECT id, remote_rule AS remote_mode FROM coded"))
def remote_rule(spark, folder):
    scoped, full = _scoped(spark, folder)
    return scoped.select("id", columns.remote_value(F.col("t"), full).alias("remote_mode"))


@query("g12_rule_notes", _ruled("SELECT id, new_notes AS notes FROM column_ruled"))
def rule_notes(spark, folder):
    ruled = columns.apply_column_rules(view(spark, folder, "model"))
    return ruled.select("id", columns.notes_text(F.col("notes")).alias("notes"))


@query(
    "g13_column_rules",
    _ruled(
        """SELECT id, new_job_type AS job_type, new_experience AS experience_level,
        new_collar AS collar, remote_rule AS remote_mode, new_notes AS notes FROM column_ruled"""
    ),
)
def column_rule_query(spark, folder):
    ruled = columns.apply_column_rules(view(spark, folder, "model"))
    return ruled.select(
        "id",
        "job_type",
        "experience_level",
        "collar",
        "remote_mode",
        columns.notes_text(F.col("notes")).alias("notes"),
    )


# --- audit rules ----------------------------------------------------------------------


def _unique(flags: list[str]) -> str:
    listed = "list_distinct(list_filter([" + ", ".join(flags) + "], lambda v: v IS NOT NULL))"
    return (
        f"CASE len({listed}) WHEN 0 THEN '__UNKNOWN__' WHEN 1 THEN {listed}[1] ELSE '__CONFLICT__' END"
    )


def _flags(column: str, rules: list[tuple[str, str]]) -> list[str]:
    return [f"CASE WHEN {hit(column, p)} THEN {quoted(v)} END" for v, p in rules]


REMOTE_SIGNAL = _unique(_flags("x", audit_rules.REMOTE))
JOB_TYPE_SIGNAL = _unique(_flags("x", audit_rules.JOB_TYPE))
COLLAR_SIGNAL = (
    f"CASE WHEN {hit('t', audit_rules.CLINICAL)} OR {hit('t', audit_rules.TRADES)}"
    " THEN 'Blue' ELSE '__UNKNOWN__' END"
)
AD_SQL = f"(length(d) > 900 OR {hit('d', audit_rules.AD_WORDS)})"

# The text before a match is put together again from what was matched and what lies between.
_YEARS = quoted("(?i)" + audit_rules.YEARS)
_PHRASES = " OR ".join(f"contains(before, '{p}')" for p in audit_rules.COMPANY_AGE_PHRASES)
YEARS_CTES = f"""found AS (SELECT id, regexp_extract_all(x, {_YEARS}, 0) AS whole,
   regexp_extract_all(x, {_YEARS}, 1) AS num, string_split_regex(x, {_YEARS}) AS rest FROM scoped),
 positions AS (SELECT id, whole, num, rest, unnest(range(1, len(whole) + 1)) AS i FROM found),
 statements AS (SELECT id, CAST(num[i] AS INTEGER) AS y, lower(right(array_to_string(
   list_transform(range(1, i + 1), lambda j: rest[j] || CASE WHEN j < i THEN whole[j] ELSE '' END), ''), 35)) AS before
   FROM positions),
 lowest AS (SELECT id, min(y) AS years FROM statements WHERE NOT ({_PHRASES}) GROUP BY id)"""

AUDIT_CTES = (
    SCOPED.replace("{source}", "model")
    + f""", {YEARS_CTES},
 audited AS (SELECT s.id, {AD_SQL} AS is_ad, {REMOTE_SIGNAL} AS remote_type, {JOB_TYPE_SIGNAL} AS job_type,
  CASE WHEN years <= 1 THEN 'Entry' WHEN years <= 4 THEN 'Mid-Senior' WHEN years IS NOT NULL THEN 'Senior'
   ELSE {_unique(_flags('t', audit_rules.TITLE_EXPERIENCE))} END AS experience_band,
  {COLLAR_SIGNAL} AS collar FROM scoped s LEFT JOIN lowest l ON s.id = l.id)"""
)


@query(
    "a1_unique_signal",
    over(
        "level_predictions",
        """SELECT row_id, CASE WHEN conf < 0.3e0 THEN '__UNKNOWN__' WHEN y = p THEN y
        ELSE '__CONFLICT__' END AS signal FROM level_predictions""",
    ),
)
def unique_signal(spark, folder):
    rows = view(spark, folder, "level_predictions")
    sure = F.col("conf") >= 0.3
    hits = F.array(F.when(sure, F.col("y")), F.when(sure, F.col("p")))
    return rows.select("row_id", audit.unique_signal(hits).alias("signal"))


def _audit_query(name: str, column: str):
    @query(name, over("model", f"SELECT id, {column} FROM audited", AUDIT_CTES))
    def run(spark, folder):
        return audit.audit_signals(view(spark, folder, "model")).select("id", column)


_audit_query("a2_remote_signal", "remote_type")
_audit_query("a3_job_type_signal", "job_type")
_audit_query("a4_experience_signal", "experience_band")
_audit_query("a5_collar_signal", "collar")
_audit_query("a6_looks_like_ad", "is_ad")


@query(
    "a4_years_in_role",
    over(
        "model",
        "SELECT s.id, years FROM scoped s LEFT JOIN lowest l ON s.id = l.id",
        SCOPED.replace("{source}", "model") + ", " + YEARS_CTES,
    ),
)
def years_in_role(spark, folder):
    return _scoped(spark, folder)[0].select(
        "id", audit.min_years_in_role(F.col("x")).alias("years")
    )


COVERAGE_CTES = """, long AS (
  SELECT CASE WHEN is_ad THEN 'ad' ELSE 'non-ad' END AS segment, field, value FROM
   (UNPIVOT audited ON remote_type, job_type, experience_band, collar INTO NAME field VALUE value)),
 segments AS (SELECT * FROM long UNION ALL SELECT 'all', field, value FROM long),
 counted AS (SELECT segment, field, value, count(*) AS n FROM segments GROUP BY ALL),
 totals AS (SELECT segment, field, sum(n) AS total,
   sum(n) FILTER (value NOT IN ('__UNKNOWN__', '__CONFLICT__')) AS usable FROM counted GROUP BY ALL)"""


@query(
    "a7_coverage_report",
    over(
        "model",
        """SELECT c.segment, c.field, c.value, c.n, round(100.0e0 * c.n / t.total, 6) AS pct_of_rows,
        CASE WHEN c.value NOT IN ('__UNKNOWN__', '__CONFLICT__') THEN round(100.0e0 * c.n / t.usable, 6) END AS pct_of_usable
        FROM counted c JOIN totals t ON c.segment = t.segment AND c.field = t.field""",
        AUDIT_CTES + COVERAGE_CTES,
    ),
)
def coverage_report(spark, folder):
    return audit.coverage_report(audit.audit_signals(view(spark, folder, "model")))
