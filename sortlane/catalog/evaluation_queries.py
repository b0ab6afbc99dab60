"""Evaluation, splits, features and the review logic over given predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sortlane.catalog.fixtures import table, view
from sortlane.catalog.registry import group_sql, over, query
from sortlane.functions.terms import strip_accents, with_terms
from sortlane.functions.text import group_key
from sortlane.operators import evaluation as ev
from sortlane.operators import features, predict, splits, tfidf
from sortlane.operators.heads import ranked_classes
from sortlane.operators.labels import map_experience3

# --- metrics --------------------------------------------------------------------------

SCORED = """scored AS (SELECT c.label, sum(t) AS support, sum(q) AS predicted, sum(h) AS hits FROM (
   SELECT y AS label, 1 AS t, 0 AS q, CASE WHEN y = p THEN 1 ELSE 0 END AS h FROM {source}
   UNION ALL SELECT p, 0, 1, 0 FROM {source}) c GROUP BY c.label),
 per_class AS (SELECT label, support,
   CASE WHEN predicted = 0 THEN 0 ELSE hits * 1.0e0 / predicted END AS precision,
   CASE WHEN support = 0 THEN 0 ELSE hits * 1.0e0 / support END AS recall,
   CASE WHEN support + predicted = 0 THEN 0 ELSE 2.0e0 * hits / (support + predicted) END AS f1 FROM scored),
 chance AS (SELECT sum(hits) * 1.0e0 / sum(support) AS po,
   sum(support * predicted) * 1.0e0 / (sum(support) * sum(support)) AS pe,
   100.0e0 * max(support) / sum(support) AS baseline, sum(support) AS n,
   count(*) FILTER (support > 0) AS classes FROM scored)"""


def scored(source: str) -> str:
    return SCORED.replace("{source}", source)


METRICS_SELECT = """CAST(n AS BIGINT) AS n_rows, classes, round(100 * po, 6) AS accuracy,
 round(100 * (SELECT avg(f1) FROM per_class), 6) AS macro_f1, round((po - pe) / (1 - pe), 6) AS kappa,
 round(baseline, 6) AS baseline, round(100 * po - baseline, 6) AS lift"""


def _metrics_query(name: str, columns: str, pick: list[str]):
    @query(name, over("predictions", f"SELECT {columns} FROM chance", scored("predictions")))
    def run(spark, folder):
        return ev.head_metrics(view(spark, folder, "predictions")).select(*pick)


_metrics_query("e1_accuracy", "round(100 * po, 6) AS accuracy", ["accuracy"])
_metrics_query(
    "e2_macro_f1", "round(100 * (SELECT avg(f1) FROM per_class), 6) AS macro_f1", ["macro_f1"]
)
_metrics_query("e3_kappa", "round((po - pe) / (1 - pe), 6) AS kappa", ["kappa"])
_metrics_query(
    "e4_lift",
    "round(baseline, 6) AS baseline, round(100 * po - baseline, 6) AS lift",
    ["baseline", "lift"],
)


@query(
    "e5_classification_report",
    over(
        "predictions",
        """SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per_class
        UNION ALL SELECT 'accuracy', NULL, NULL, round(po, 6), CAST(n AS BIGINT) FROM chance
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
          CAST(sum(support) AS BIGINT) FROM per_class
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
          round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
          CAST(sum(support) AS BIGINT) FROM per_class""",
        scored("predictions"),
    ),
)
def classification_report(spark, folder):
    return ev.classification_report(view(spark, folder, "predictions"))


@query(
    "e6_confusion_matrix",
    over(
        "predictions",
        """SELECT a.c AS y, b.c AS p, count(q.y) AS n FROM classes a JOIN classes b ON TRUE
        LEFT JOIN predictions q ON q.y = a.c AND q.p = b.c GROUP BY ALL""",
        "classes AS (SELECT y AS c FROM predictions UNION SELECT p FROM predictions)",
    ),
)
def confusion_matrix(spark, folder):
    return ev.confusion_matrix(view(spark, folder, "predictions"))


CURVE = """cuts AS (SELECT (200 + 5 * i) / 1000.0e0 AS cut FROM range(160) r(i)),
 curve AS (SELECT cut, count(conf) AS kept, avg(CASE WHEN y = p THEN 1.0e0 WHEN conf IS NOT NULL THEN 0.0e0 END) AS precision
   FROM cuts LEFT JOIN {source} ON conf >= cut GROUP BY cut)"""
COVERAGE = "kept * 1.0e0 / (SELECT count(*) FROM predictions) AS coverage"


@query(
    "e7_gate_curve",
    over(
        "predictions",
        f"SELECT cut, kept, round(precision, 6) AS precision, {COVERAGE} FROM curve",
        CURVE.replace("{source}", "predictions"),
    ),
)
def gate_curve(spark, folder):
    curve = ev.gate_curve(view(spark, folder, "predictions"))
    return curve.withColumn("precision", F.round("precision", 6))


def _threshold_query(name: str, min_rows: int, target: float):
    sql = over(
        "predictions",
        f"""SELECT min(cut) AS threshold, round(100 * arg_min(precision, cut), 6) AS precision_pct,
        round(100 * arg_min(coverage, cut), 6) AS coverage_pct, count(*) > 0 AS gatable
        FROM (SELECT *, {COVERAGE} FROM curve) WHERE precision >= {target}e0 AND kept >= {min_rows}""",
        CURVE.replace("{source}", "predictions"),
    )

    @query(name, sql)
    def run(spark, folder):
        curve = ev.gate_curve(view(spark, folder, "predictions"))
        return ev.find_threshold(curve, min_rows, target)


_threshold_query("e8_threshold", 100, 0.95)
_threshold_query("e8_threshold_not_reached", 400, 0.95)


@query(
    "e9_vocabulary_comparison",
    over(
        "level_predictions",
        """SELECT a.accuracy AS native_accuracy, b.accuracy AS merged_accuracy, a.lift AS native_lift, b.lift AS merged_lift,
        round(b.accuracy - a.accuracy, 6) AS accuracy_change, round(b.lift - a.lift, 6) AS lift_change
        FROM m6 a JOIN m3 b ON TRUE""",
        """banded AS (SELECT
           CASE WHEN y IN ('Internship', 'Entry level') THEN 'Entry' WHEN y IN ('Director', 'Executive') THEN 'Senior' ELSE 'Mid-Senior' END AS y,
           CASE WHEN p IN ('Internship', 'Entry level') THEN 'Entry' WHEN p IN ('Director', 'Executive') THEN 'Senior' ELSE 'Mid-Senior' END AS p
           FROM level_predictions),
        m6 AS (SELECT round(100 * avg(CAST(y = p AS INTEGER)), 6) AS accuracy, round(100 * avg(CAST(y = p AS INTEGER)) -
           (SELECT 100.0e0 * max(n) / sum(n) FROM (SELECT count(*) AS n FROM level_predictions GROUP BY y)), 6) AS lift FROM level_predictions),
        m3 AS (SELECT round(100 * avg(CAST(y = p AS INTEGER)), 6) AS accuracy, round(100 * avg(CAST(y = p AS INTEGER)) -
           (SELECT 100.0e0 * max(n) / sum(n) FROM (SELECT count(*) AS n FROM banded GROUP BY y)), 6) AS lift FROM banded)""",
    ),
)
def vocabulary_comparison(spark, folder):
    native = view(spark, folder, "level_predictions").select(F.lit("native").alias("vocabulary"), "y", "p")
    merged = native.select(
        F.lit("merged").alias("vocabulary"),
        map_experience3(F.col("y")).alias("y"),
        map_experience3(F.col("p")).alias("p"),
    )
    metrics = ev.head_metrics(native.unionByName(merged), by=["vocabulary"])
    return ev.compare_vocabularies(metrics, "native", "merged")


@query(
    "e10_summary_table",
    over(
        "predictions",
        f"""SELECT 'all' AS head, {METRICS_SELECT} FROM chance
        UNION ALL SELECT 'confident' AS head, {METRICS_SELECT.replace('per_class', 'per_class2')} FROM chance2""",
        scored("predictions")
        + ", sure AS (SELECT * FROM predictions WHERE conf >= 0.6e0), "
        + scored("sure").replace("scored", "scored2").replace("per_class", "per_class2").replace("chance AS", "chance2 AS"),
    ),
)
def summary(spark, folder):
    """Two heads in one pass: all predictions, and the confident ones on their own."""
    heads = F.array_compact(F.array(F.lit("all"), F.when(F.col("conf") >= 0.6, F.lit("confident"))))
    rows = view(spark, folder, "predictions").withColumn("head", F.explode(heads))
    return ev.head_metrics(rows, by=["head"])


@query(
    "l13_majority_baseline",
    over(
        "predictions",
        """SELECT CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS largest_class, round(100.0e0 * max(n) / sum(n), 6) AS baseline
        FROM (SELECT y, count(*) AS n FROM predictions GROUP BY y)""",
    ),
)
def majority_baseline(spark, folder):
    return ev.majority_baseline(view(spark, folder, "predictions"))


# --- splits ---------------------------------------------------------------------------

FOLD_SQL = "CAST(('0x' || substring(md5({g}), 1, 8))::BIGINT % 5 AS INTEGER)"
HELD_SQL = "('0x' || substring(md5('42:' || {g}), 9, 8))::BIGINT < 858993459"


@query(
    "m1_group_fold",
    f"SELECT doc_id, {FOLD_SQL.replace('{g}', 'g')} AS fold FROM (SELECT doc_id, {group_sql('text')} AS g FROM documents)",
)
def group_fold(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", splits.fold_of(group_key(F.col("text"))).alias("fold"))


@query(
    "m2_held_out",
    f"SELECT doc_id, {HELD_SQL.replace('{g}', 'g')} AS held FROM (SELECT doc_id, {group_sql('text')} AS g FROM documents)",
)
def held_out(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", splits.held_out(group_key(F.col("text"))).alias("held"))


@query(
    "m2_calibration_usable",
    f"""SELECT CAST(sum(CASE WHEN held THEN n ELSE 0 END) AS BIGINT) AS held_out_rows, count(*) FILTER (NOT held) AS classes_left,
    sum(CASE WHEN held THEN n ELSE 0 END) >= 200 AND count(*) FILTER (NOT held) = (SELECT count(DISTINCT lang) FROM documents) AS usable
    FROM (SELECT held, lang, count(*) AS n FROM (SELECT lang, {HELD_SQL.replace('{g}', 'g')} AS held FROM
      (SELECT lang, {group_sql('text')} AS g FROM documents)) GROUP BY ALL)""",
)
def calibration_usable(spark, folder):
    rows = table(spark, folder, "documents").select(
        "lang", splits.held_out(group_key(F.col("text"))).alias("held")
    )
    classes = rows.select("lang").distinct().count()
    return splits.calibration_usable(rows, "lang", "held", classes)


@query(
    "m3_balanced_weights",
    """SELECT vec_id, label, (SELECT count(*) FROM embeddings) * 1.0e0 /
    ((SELECT count(DISTINCT label) FROM embeddings) * count(*) OVER (PARTITION BY label)) AS weight FROM embeddings""",
)
def balanced_weights(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "label")
    return splits.balanced_weights(rows, "label", row_id="vec_id")


# --- features -------------------------------------------------------------------------

# Whole texts, accents folded, runs of two or more word characters, and their neighbours.
TERMS_CTE = r"""words AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
 tokens AS (SELECT doc_id, unnest(w) AS term FROM words
   UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
 counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
 kept AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM counts GROUP BY term HAVING count(*) >= 3
   ORDER BY cf DESC, term LIMIT {size}),
 vocab AS (SELECT *, ln((1 + (SELECT count(*) FROM documents)) * 1.0e0 / (1 + df)) + 1 AS idf FROM kept)"""


def _term_rows(spark, folder):
    documents = table(spark, folder, "documents")
    return with_terms(documents, "text").select("doc_id", "terms")


def _vocabulary_query(name: str, size: int):
    sql = f"WITH {TERMS_CTE.replace('{size}', str(size))} SELECT term, cf, df, round(idf, 6) AS idf FROM vocab"

    @query(name, sql)
    def run(spark, folder):
        vocab = tfidf.vocabulary(_term_rows(spark, folder), max_features=size)
        return vocab.withColumn("idf", F.round("idf", 6))


_vocabulary_query("f1_vocabulary", 40000)
_vocabulary_query("f1_vocabulary_small", 500)


@query(
    "f1_vocabularies_by_fold",
    f"""WITH {TERMS_CTE.replace('{size}', '1')},
    folds AS (SELECT doc_id, CAST(doc_id % 5 AS INTEGER) AS own FROM documents),
    outside AS (SELECT f.fold, c.term, CAST(sum(c.tf) AS BIGINT) AS cf, count(*) AS df FROM counts c
      JOIN folds o ON o.doc_id = c.doc_id JOIN (SELECT CAST(i AS INTEGER) AS fold FROM range(5) r(i)) f ON f.fold <> o.own
      GROUP BY ALL HAVING count(*) >= 3),
    sizes AS (SELECT f.fold, count(*) AS n FROM folds o JOIN (SELECT CAST(i AS INTEGER) AS fold FROM range(5) r(i)) f ON f.fold <> o.own GROUP BY ALL)
    SELECT o.fold, term, cf, df, round(ln((1 + n) * 1.0e0 / (1 + df)) + 1, 6) AS idf FROM outside o JOIN sizes s ON o.fold = s.fold
    QUALIFY row_number() OVER (PARTITION BY o.fold ORDER BY cf DESC, term) <= 40000""",
)
def vocabularies_by_fold(spark, folder):
    rows = _term_rows(spark, folder).withColumn("fold", (F.col("doc_id") % 5).cast("int"))
    vocab = tfidf.vocabularies_by_fold(rows)
    return vocab.withColumn("idf", F.round("idf", 6))


@query(
    "f2_tfidf_long",
    f"""WITH {TERMS_CTE.replace('{size}', '40000')},
    raw AS (SELECT doc_id, c.term, tf, (1 + ln(tf)) * idf AS r FROM counts c JOIN vocab v ON c.term = v.term)
    SELECT doc_id, term, tf, round(r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def tfidf_long(spark, folder):
    rows = _term_rows(spark, folder)
    weights = tfidf.tfidf_long(rows, tfidf.vocabulary(rows), key="doc_id")
    return weights.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


@query("f3_strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def strip_accents_query(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", strip_accents(F.col("text")).alias("plain"))


@query(
    "f6_l2_normalise",
    """SELECT vec_id, list_transform(embedding, lambda x: round(x / sqrt(list_sum(list_transform(embedding, lambda z: CAST(z AS DOUBLE) * z))), 6)) AS unit
    FROM embeddings""",
)
def l2_normalise(spark, folder):
    rows = table(spark, folder, "embeddings")
    unit = features.l2_normalise(F.col("embedding"))
    return rows.select("vec_id", F.transform(unit, lambda x: features.rounded(x, 6)).alias("unit"))


@query(
    "f7_label_encode",
    "SELECT doc_id, lang || source AS class, CAST(dense_rank() OVER (ORDER BY lang || source) - 1 AS INTEGER) AS label_index FROM documents",
)
def label_encode(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.concat("lang", "source").alias("class"))
    return features.label_encode(rows, "class", row_id="doc_id")


@query(
    "s3_alignment",
    """SELECT count(d.doc_id) AS rows, count(e.vec_id) AS vectors, count(*) FILTER (e.vec_id IS NULL) AS rows_without_vector,
    count(*) FILTER (d.doc_id IS NULL) AS vectors_without_row, CAST(min(len(e.embedding)) AS INTEGER) AS min_size,
    CAST(max(len(e.embedding)) AS INTEGER) AS max_size FROM documents d FULL JOIN embeddings e ON d.doc_id = e.vec_id""",
)
def alignment(spark, folder):
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    return features.alignment_report(rows, vectors)


# --- ranking of classes and review ----------------------------------------------------


@query(
    "w4_top_two",
    """SELECT vec_id, CAST(list_position(embedding, s[1]) - 1 AS INTEGER) AS first, CAST(list_position(embedding, s[2]) - 1 AS INTEGER) AS second,
    s[1] AS best FROM (SELECT vec_id, embedding, list_reverse_sort(embedding) AS s FROM embeddings)""",
)
def top_two(spark, folder):
    """Vectors read as class scores."""
    rows = table(spark, folder, "embeddings")
    ranked = rows.select("vec_id", ranked_classes(F.col("embedding")).alias("r"))
    return ranked.select(
        "vec_id",
        (-F.get("r", F.lit(0))["minus_index"]).alias("first"),
        (-F.get("r", F.lit(1))["minus_index"]).alias("second"),
        F.get("r", F.lit(0))["p"].alias("best"),
    )


@query(
    "w7_argmax",
    """SELECT vec_id, list_max(embedding) AS best, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS position FROM embeddings""",
)
def argmax(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.array_max("embedding").alias("best")
    )
    position = (F.array_position("embedding", F.col("best")) - 1).cast("int")
    return rows.select("vec_id", "best", position.alias("position"))


@query(
    "p2_head_detail",
    over(
        "review",
        """SELECT row_id, label AS top1, second AS top2, round(conf * 100, 1) AS conf, threshold FROM review""",
    ),
)
def head_detail(spark, folder):
    rows = view(spark, folder, "review")
    return rows.select(
        "row_id",
        F.col("label").alias("top1"),
        F.col("second").alias("top2"),
        predict.conf_percent(F.col("conf")).alias("conf"),
        "threshold",
    )


@query(
    "p3_review_flag",
    over(
        "review",
        """SELECT row_id, CASE WHEN rule_fired OR threshold IS NULL THEN FALSE ELSE conf < threshold END AS title_review,
        CASE WHEN NOT present THEN TRUE WHEN rule_fired THEN FALSE WHEN NOT gatable THEN TRUE ELSE conf < threshold END AS column_review,
        CASE WHEN NOT present THEN 'model_missing' WHEN rule_fired THEN 'rule' WHEN NOT gatable THEN 'ungatable' ELSE '' END AS note
        FROM review""",
    ),
)
def review_flag(spark, folder):
    rows = view(spark, folder, "review")
    fired, conf, threshold = F.col("rule_fired"), F.col("conf"), F.col("threshold")
    return rows.select(
        "row_id",
        predict.review_title_ruled(fired, conf, threshold).alias("title_review"),
        predict.review_column_ruled(
            F.col("present"), fired, F.col("gatable"), conf, threshold
        ).alias("column_review"),
        predict.note_column_ruled(F.col("present"), fired, F.col("gatable")).alias("note"),
    )


@query(
    "p4_alternate_label",
    over(
        "review",
        """SELECT row_id, CASE WHEN NOT rule_fired AND conf < threshold AND label <> 'Others' THEN second END AS alternate FROM review""",
    ),
)
def alternate_label(spark, folder):
    rows = view(spark, folder, "review")
    alternate = predict.alternate_label(
        F.col("rule_fired"), F.col("label"), F.col("conf"), F.col("threshold"), F.col("second")
    )
    return rows.select("row_id", alternate.alias("alternate"))


@query(
    "p5_conf_percent",
    over("predictions", "SELECT row_id, round(conf * 100, 1) AS conf FROM predictions"),
)
def conf_percent(spark, folder):
    rows = view(spark, folder, "predictions")
    return rows.select("row_id", predict.conf_percent(F.col("conf")).alias("conf"))
