"""Learned heads, prediction, table round trips and incremental runs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.catalog.fixtures import table, view
from sortlane.catalog.label_queries import DAILY_SQL, LABEL_COLUMNS, MERGED_SQL, RECOVERY, fill_blanks_cte, rule_updates
from sortlane.catalog.registry import group_sql, hit, model_text_sql, over, over_many, query
from sortlane.catalog.text_queries import NON_ENGLISH_SQL, STAMP, keyword_merge_ctes
from sortlane.functions.terms import with_terms
from sortlane.functions.text import blank_if_null, group_hash
from sortlane.operators import columns, features, heads, labels, predict, splits, tfidf, titles
from sortlane.operators.evaluation import find_threshold, gate_curve
from sortlane.plans import training
from sortlane.plans.daily import rules_only
from sortlane.plans.workspace import materialise, new_folder
from sortlane.rules import labels as fixed
from sortlane.rules import remote as remote_rules
from sortlane.schema import JOBS_SCHEMA, TARGET_COLUMNS
from sortlane.sources import tables, versioned
from sortlane.streaming import drain, pages

# --- table round trips ----------------------------------------------------------------

POSTING_COLUMNS = (
    "title, description, formatted_work_type, formatted_experience_level, remote_allowed"
)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@query("s1_read_postings", over("postings", f"SELECT {POSTING_COLUMNS} FROM postings"))
def read_postings(spark, folder):
    """All postings through a quoted multi-line CSV with more columns than are read."""
    path = new_folder(spark, "postings")
    _write_csv(view(spark, folder, "postings"), path)
    return tables.read_postings(spark, path)


@query("s2_read_training", over("training", "SELECT title, description, industry, role FROM training"))
def read_training(spark, folder):
    path, stored = new_folder(spark, "training"), new_folder(spark, "numbered")
    _write_csv(view(spark, folder, "training"), path)
    numbered = tables.ingest(tables.read_training(spark, path), stored)
    return numbered.dropDuplicates(["row_id"]).drop("row_id")


@query(
    "s7_write_training",
    over_many(
        ["postings", "training"],
        "SELECT row_id, title, description, "
        + ", ".join(f"coalesce({c}, '') AS {c}" for c in LABEL_COLUMNS)
        + " FROM recovered",
        RECOVERY,
    ),
)
def write_training(spark, folder):
    path = new_folder(spark, "augmented")
    recovered = labels.recover_labels(view(spark, folder, "training"), view(spark, folder, "postings"))
    tables.write_training(recovered, path)
    return spark.read.parquet(path)


@query("u3_snapshot", over("jobs", "SELECT * FROM jobs WHERE classified_at IS NULL"))
def snapshot(spark, folder):
    """The queue read back from a partitioned snapshot."""
    path = new_folder(spark, "snapshot")
    tables.write_snapshot(view(spark, folder, "jobs"), path)
    return tables.read_snapshot(spark, path, only_queue=True).select(*JOBS_SCHEMA.fieldNames())


def _versioned_jobs(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "versioned")
    versioned.create(tables.conform_jobs(view(spark, folder, "jobs")), path, rows_per_file=500)
    return path


@query("j4_file_updates", MERGED_SQL)
def file_updates(spark, folder):
    """The updates merged file by file, twice: the second time they are known by their number."""
    root = _versioned_jobs(spark, folder)
    for _ in range(2):
        versioned.update(spark, root, view(spark, folder, "updates"), STAMP, transaction=1)
    return versioned.read(spark, root)


# --- incremental runs -----------------------------------------------------------------


def _arrivals(spark: SparkSession, folder: str) -> str:
    """The jobs as a folder of files that arrived one after the other."""
    path = new_folder(spark, "arrivals")
    jobs = tables.conform_jobs(view(spark, folder, "jobs"))
    jobs.repartition(8, "id").write.parquet(path)
    return path


@query("k9_keyword_run", over("jobs", "SELECT * FROM keyword_merged", keyword_merge_ctes()))
def keyword_run(spark, folder):
    sink = new_folder(spark, "keyword")
    drain.keyword_run(
        spark, _arrivals(spark, folder), sink, new_folder(spark, "progress"), STAMP, files_per_batch=3
    )
    return drain.read_results(spark, sink)


DRAINED_SQL = over(
    "jobs",
    "SELECT * FROM merged WHERE id IN (SELECT id FROM rule_updates)",
    rule_updates("jobs") + ", " + fill_blanks_cte("jobs", "rule_updates"),
)


@query("u4_drain", DRAINED_SQL)
def drain_query(spark, folder):
    sink = new_folder(spark, "drained")
    drain.drain(
        spark,
        _arrivals(spark, folder),
        rules_only,
        sink,
        new_folder(spark, "progress"),
        STAMP,
        files_per_batch=3,
    )
    return drain.read_results(spark, sink)


@query(
    "u4_drain_snapshot",
    over("jobs", "SELECT * FROM merged", rule_updates("jobs") + ", " + fill_blanks_cte("jobs", "rule_updates")),
)
def drain_snapshot(spark, folder):
    """The whole table after a drain, twice: a replay into the same sink changes nothing."""
    sink, arrivals = new_folder(spark, "drained"), _arrivals(spark, folder)
    for _ in range(2):
        drain.drain(spark, arrivals, rules_only, sink, new_folder(spark, "progress"), STAMP, files_per_batch=3)
    return drain.merged_snapshot(tables.conform_jobs(view(spark, folder, "jobs")), sink)


@query(
    "u4_drain_pages",
    over(
        "jobs",
        "SELECT * FROM merged",
        rule_updates("page") + ", " + fill_blanks_cte("jobs", "rule_updates"),
    ).replace("blank AS (", "page AS (SELECT * FROM jobs WHERE classified_at IS NULL ORDER BY id LIMIT 900), blank AS (", 1),
)
def drain_pages(spark, folder):
    """The table after two runs over ordered pages of 350 rows that share a total of 900."""
    root = _versioned_jobs(spark, folder)
    pages.run_pages(spark, root, rules_only, STAMP, 350, total=900, max_pages=1)
    pages.run_pages(spark, root, rules_only, STAMP, 350, total=900)
    return versioned.read(spark, root)


@query(
    "u4_drain_heads",
    over("jobs", "SELECT id, title, remote_mode, TRUE AS stamped FROM jobs WHERE classified_at IS NULL"),
)
def drain_heads(spark, folder):
    """A drain with fitted heads: which rows are stamped, and that the remote mode is not the model's."""
    sink, fitted = new_folder(spark, "drained"), loaded_heads(spark, folder)
    classify = lambda rows: predict.predict_batch(rows, fitted)
    drain.drain(spark, _arrivals(spark, folder), classify, sink, new_folder(spark, "progress"), STAMP, files_per_batch=3)
    results = drain.read_results(spark, sink)
    return results.select("id", "title", "remote_mode", F.col("classified_at").isNotNull().alias("stamped"))


@query("u5_daily_stream", DAILY_SQL)
def daily_stream(spark, folder):
    sink = new_folder(spark, "daily")
    drain.daily_stream(
        spark, _arrivals(spark, folder), rules_only, sink, new_folder(spark, "progress"), STAMP
    )
    return drain.read_results(spark, sink)


@query("l14_run_report", over("jobs", "SELECT count(*) AS rows, CAST(3 AS BIGINT) AS batches, TRUE AS timed FROM jobs WHERE classified_at IS NULL"))
def run_report(spark, folder):
    """Rows and batches of a run that writes nothing; the time is checked to be there."""
    report = drain.drain(
        spark,
        _arrivals(spark, folder),
        rules_only,
        None,
        new_folder(spark, "progress"),
        STAMP,
        files_per_batch=3,
    )
    return spark.createDataFrame(
        [(report.rows, report.batches, report.rows_per_second > 0)],
        "rows long, batches long, timed boolean",
    )


@query(
    "l14_batch_throughput",
    over(
        "jobs",
        "SELECT count(*) AS logged, count(*) AS written, CAST(3 AS BIGINT) AS batches, TRUE AS agree FROM jobs WHERE classified_at IS NULL",
    ),
)
def batch_throughput(spark, folder):
    """The log of a drain against what each of its batches wrote."""
    sink, log = new_folder(spark, "drained"), new_folder(spark, "throughput")
    drain.drain(
        spark, _arrivals(spark, folder), rules_only, sink, new_folder(spark, "progress"), STAMP, files_per_batch=3, log=log
    )
    written = spark.read.parquet(sink).groupBy("batch_id").agg(F.count("*").alias("n"))
    # A batch without rows has a log entry only.
    paired = drain.read_throughput(spark, log).join(written, "batch_id", "full")
    return paired.agg(
        F.sum("rows").alias("logged"),
        F.sum("n").alias("written"),
        F.count("rows").alias("batches"),
        F.bool_and((F.col("rows") == F.coalesce("n", F.lit(0))) & (F.col("rows_per_second") >= 0)).alias("agree"),
    )


# --- vectors and terms in one head ------------------------------------------------------


@query(
    "p1_encoded_heads",
    """SELECT doc_id AS id, TRUE AS same, TRUE AS sound FROM documents JOIN labels USING (doc_id)""",
)
def encoded_heads(spark, folder):
    """A head over terms and vectors, predicting from stored vectors and from an encoder's.

    The stand-in encoder gives the vectors that are stored, so both ways agree.
    """
    documents = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    rows = documents.select(
        F.col("doc_id").alias("id"), F.lit("").alias("title"), F.col("text").alias("description"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality"),
    )
    rows = materialise(features.encode(rows, letter_encoder), "encoded")
    frame = with_terms(rows.withColumn("_text", F.col("description")), "_text").select(
        F.col("id").alias("row_id"), group_hash(F.col("description")).alias("group"), "terms", "embedding", "quality"
    )
    spec = heads.HeadSpec("role", "quality", floor=2)
    train = materialise(heads.training_rows(frame, spec), "training-rows")
    classes = sorted(r["y"] for r in train.select("y").distinct().collect())
    fitted = {"role": heads.fit_head(train, classes, spec, tfidf.vocabulary(train))}
    stored = predict.score_heads(rows, fitted).select("id", F.col("role_top1").alias("a"), F.col("role_conf").alias("c"))
    fresh = predict.score_heads(rows.drop("embedding"), fitted, letter_encoder).select("id", F.col("role_top1").alias("b"))
    joined = stored.join(fresh, "id")
    return joined.select("id", (F.col("a") == F.col("b")).alias("same"), F.col("a").isin(classes) & F.col("c").between(0.0, 1.0 + 1e-9))\
        .toDF("id", "same", "sound")


# --- learned heads --------------------------------------------------------------------


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their quality label as training rows."""
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels"), "doc_id")
    rows = labelled.select(
        F.col("doc_id").alias("row_id"),
        group_hash(F.col("text")).alias("group"),
        "text",
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality"),
    )
    return with_terms(rows, "text").drop("text")


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with their label; no terms, every row a group of its own."""
    rows = table(spark, folder, "embeddings")
    return rows.select(
        F.col("vec_id").alias("row_id"),
        F.col("vec_id").cast("string").cast("binary").alias("group"),
        F.array().cast("array<string>").alias("terms"),
        features.l2_normalise(F.col("embedding")).alias("embedding"),
        F.concat(F.lit("class "), "label").alias("label"),
    )


QUALITY = heads.HeadSpec("quality", "quality", floor=5)
QUALITY_SVM = heads.HeadSpec("quality", "quality", floor=5, learner="svm")
VECTOR_LABEL = heads.HeadSpec("label", "label", floor=5, separate_gate=False)


def _split(rows: DataFrame, spec: heads.HeadSpec) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training and held-out rows, group-disjoint, and the classes."""
    rows = materialise(heads.training_rows(rows, spec), "training-rows")
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    return rows.filter(~F.col("held_out")), rows.filter(F.col("held_out")), classes


def _fit_and_score(spark, folder, spec: heads.HeadSpec) -> DataFrame:
    train, held, classes = _split(labelled_documents(spark, folder), spec)
    vocab = tfidf.vocabulary(train, max_features=spec.max_features)
    head = heads.fit_head(train, classes, spec, vocab)
    scored = heads.score(held, head)
    return scored.select("row_id", "y", _sound(classes).alias("sound"))


def _sound(classes: list[str]) -> Column:
    """What holds for every score: two different classes of the head, the first at least as likely."""
    known = F.col("top1").isin(classes) & F.col("top2").isin(classes) & (F.col("top1") != F.col("top2"))
    return known & F.col("conf").between(1 / len(classes) - 1e-9, 1 + 1e-9)


# Held-out rows; the group is the MD5 of the group key, as bytes.
HELD_OUT_SQL = f"""SELECT doc_id AS row_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS y, TRUE AS sound
    FROM (SELECT doc_id, quality, md5(CAST('42:' AS BLOB) || unhex(md5({group_sql('text')}))) AS h FROM documents JOIN labels USING (doc_id))
    WHERE CAST(('0x' || substring(h, 9, 8)) AS BIGINT) < {int(0.2 * 16**8)}"""


@query("m4_fit_head", HELD_OUT_SQL)
def fit_head(spark, folder):
    """Multinomial logistic head over TF-IDF, applied to the held-out groups."""
    return _fit_and_score(spark, folder, QUALITY)


@query("m5_calibrated_svm", HELD_OUT_SQL)
def calibrated_svm(spark, folder):
    """Linear SVM with sigmoid calibration on three splits, applied to the held-out groups."""
    return _fit_and_score(spark, folder, QUALITY_SVM)


def _out_of_fold(spark, folder) -> DataFrame:
    """Every vector scored by a head that has not seen it."""
    rows = materialise(
        heads.training_rows(labelled_vectors(spark, folder), VECTOR_LABEL), "training-rows"
    )
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    return heads.out_of_fold(rows, classes, VECTOR_LABEL)


@query(
    "m6_out_of_fold",
    """WITH rows AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
    SELECT 'class ' || label AS y, n AS rows, n AS known, TRUE AS likely FROM rows""",
)
def out_of_fold(spark, folder):
    """By class: rows scored, those that got a class of the head, and whether all scores are shares."""
    scored = _out_of_fold(spark, folder)
    classes = [r["y"] for r in scored.select("y").distinct().collect()]
    return scored.groupBy("y").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("p").isin(classes)).alias("known"),
        F.every(F.col("conf").between(0.0, 1.0 + 1e-9)).alias("likely"),
    )


@query(
    "m6_scored_once",
    """SELECT vec_id AS row_id, CAST(('0x' || substring(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
    'class ' || label AS y FROM embeddings""",
)
def scored_once(spark, folder):
    """Row, fold and truth of the out-of-fold predictions: each row exactly once."""
    return _out_of_fold(spark, folder).select("row_id", "fold", "y")


@query("m6_out_of_fold_gate", "SELECT count(*) AS rows, TRUE AS consistent FROM embeddings")
def out_of_fold_gate(spark, folder):
    """The gate read from the curve: it holds if and only if a cut reaches the precision."""
    curve = gate_curve(_out_of_fold(spark, folder))
    gate = find_threshold(curve, min_rows=VECTOR_LABEL.min_kept).first()
    reached = curve.filter((F.col("kept") >= VECTOR_LABEL.min_kept) & (F.col("precision") >= fixed.TARGET_PRECISION)).count() > 0
    rows = table(spark, folder, "embeddings").agg(F.count("*").alias("rows"))
    return rows.withColumn("consistent", F.lit(bool(gate["gatable"]) == reached))


@query(
    "m7_train_heads",
    """SELECT 'quality' AS head, count(*) AS n_rows, CAST(count(DISTINCT quality) AS INTEGER) AS classes,
    round(100.0e0 * greatest(sum(quality), count(*) - sum(quality)) / count(*), 6) AS baseline FROM documents JOIN labels USING (doc_id)
    UNION ALL SELECT 'label', sum(n), CAST(count(*) AS INTEGER), round(100.0e0 * max(n) / sum(n), 6)
    FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""",
)
def train_heads(spark, folder):
    """Evaluation, gate and final fit of the document and the vector head."""
    fitted = heads.train_heads(labelled_documents(spark, folder), [QUALITY])
    fitted |= heads.train_heads(labelled_vectors(spark, folder), [VECTOR_LABEL])
    return heads.summary_table(spark, fitted).select("head", "n_rows", "classes", F.round("baseline", 6).alias("baseline"))


@query("f5_assemble", """SELECT vec_id, 64 + 2 AS size, round(embedding[1], 5) AS first FROM embeddings""")
def assemble(spark, folder):
    """A text vector of two entries next to the embedding."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        array_to_vector(F.array(F.lit(0.5), F.lit(0.25))).alias("text_vector"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding_vector"),
    )
    assembled = features.assemble(["text_vector", "embedding_vector"]).transform(rows)
    values = vector_to_array("features")
    return assembled.select(
        "vec_id",
        F.size(values).alias("size"),
        F.round(F.get(values, F.lit(2)), 5).cast("float").alias("first"),
    )


def letter_encoder():
    """A stand-in encoder for trial runs: how often each letter occurs."""
    import numpy as np

    def encode(texts):
        counts = [[t.lower().count(chr(97 + i)) for i in range(26)] for t in texts]
        return np.array(counts, dtype="float64")

    return encode


@query("f4_encode", over("jobs", "SELECT id, list_transform(c, lambda n: round(n / sqrt(list_sum(list_transform(c, lambda m: m * m))), 4)) AS unit FROM lettered", f"""
 texts AS (SELECT id, lower(concat('query: ', {model_text_sql('title', 'description')})) AS t FROM jobs),
 lettered AS (SELECT id, list_transform(range(97, 123), lambda i: CAST(length(t) - length(replace(t, chr(CAST(i AS INTEGER)), '')) AS DOUBLE)) AS c FROM texts)"""))
def encode(spark, folder):
    rows = features.encode(view(spark, folder, "jobs"), letter_encoder)
    return rows.select("id", F.transform("embedding", lambda x: F.round(x, 4)).alias("unit"))


# --- prediction -----------------------------------------------------------------------


_FRAMES: dict[tuple[str, str], DataFrame] = {}
_STORED: dict[tuple[str, str], str] = {}


def job_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The whole training frame with recovered labels; stored once per application and input."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FRAMES:
        recovered = labels.recover_labels(view(spark, folder, "training"), view(spark, folder, "postings"))
        _FRAMES[key] = materialise(training.training_frame(recovered), "training-frame")
    return _FRAMES[key]


def job_heads(spark: SparkSession, folder: str) -> dict[str, heads.Head]:
    """All standard heads whose classes the recovered labels offer."""
    return heads.train_heads(job_frame(spark, folder), training.STANDARD_HEADS, stored=True)


def stored_heads(spark: SparkSession, folder: str) -> str:
    """Folder of the stored heads; they are fitted once per application and input."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        path = new_folder(spark, "heads")
        heads.save_heads(spark.range(0), job_heads(spark, folder), path)
        _STORED[key] = path
    return _STORED[key]


def loaded_heads(spark: SparkSession, folder: str) -> dict[str, heads.Head]:
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return heads.load_heads(spark, stored_heads(spark, folder), TARGET_COLUMNS)


_SIGNALS = ", ".join(
    f"CAST({hit('concat(title, chr(10), description)', p)} AS INTEGER) AS s{i}"
    for i, (_, p) in enumerate(remote_rules.LABEL_SIGNALS)
)
# Rows of every class of the six heads, after curation and class floors.
HEAD_CLASSES = RECOVERY + f""", english AS (SELECT *, {group_sql('description')} AS g FROM recovered WHERE NOT {NON_ENGLISH_SQL}),
 curated AS (SELECT * FROM english QUALIFY row_number() OVER (PARTITION BY g ORDER BY row_id) <= 2),
 signals AS (SELECT remote_type, {_SIGNALS} FROM (SELECT remote_type, coalesce(title, '') AS title, coalesce(description, '') AS description FROM curated) q),
 labelled AS (SELECT 'industry' AS head, 5 AS floor, industry AS class FROM curated UNION ALL SELECT 'role', 5, role FROM curated
   UNION ALL SELECT 'job_type', 30, CASE WHEN job_type <> 'Volunteer' THEN job_type END FROM curated
   UNION ALL SELECT 'experience_level', 30, CASE WHEN experience_band IN ('Internship', 'Entry level') THEN 'Entry'
     WHEN experience_band IN ('Associate', 'Mid-Senior level') THEN 'Mid' WHEN experience_band = 'Director' THEN 'Senior'
     WHEN experience_band = 'Executive' THEN 'Executive' END FROM curated
   UNION ALL SELECT 'collar', 30, collar FROM curated
   UNION ALL SELECT 'remote_mode', 30, CASE WHEN s0 + s1 + s2 > 1 THEN NULL WHEN s0 = 1 THEN 'Remote' WHEN s1 = 1 THEN 'Hybrid'
     WHEN s2 = 1 THEN 'On-site' ELSE remote_type END FROM signals),
 head_classes AS (SELECT head, class, count(*) AS n FROM labelled WHERE class IS NOT NULL GROUP BY head, class HAVING count(*) >= max(floor)
   QUALIFY count(*) OVER (PARTITION BY head) > 1)"""


# Rows of every class of the source's own vocabularies and of the three bands.
NATIVE_CLASSES = HEAD_CLASSES.split(", signals AS")[0] + """,
 native AS (SELECT 'job_type_native' AS head, job_type AS class FROM curated UNION ALL SELECT 'experience_native', experience_band FROM curated
   UNION ALL SELECT 'remote_binary', CASE WHEN job_type IS NOT NULL THEN CASE WHEN coalesce(remote_type, '') <> '' THEN 'Remote' ELSE 'Not-remote' END END FROM curated
   UNION ALL SELECT 'bands', CASE WHEN experience_band IN ('Internship', 'Entry level') THEN 'Entry' WHEN experience_band IN ('Associate', 'Mid-Senior level') THEN 'Mid'
     WHEN experience_band IN ('Director', 'Executive') THEN 'Senior' END FROM curated),
 native_classes AS (SELECT head, class, count(*) AS n FROM native WHERE class IS NOT NULL GROUP BY head, class HAVING count(*) >= 30
   QUALIFY count(*) OVER (PARTITION BY head) > 1),
 native_facts AS (SELECT head, CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS INTEGER) AS classes, round(100.0e0 * max(n) / sum(n), 6) AS baseline
   FROM native_classes GROUP BY head)"""


@query(
    "m7_native_heads",
    over_many(["postings", "training"], "SELECT * FROM native_facts WHERE head <> 'bands'", NATIVE_CLASSES),
)
def native_heads(spark, folder):
    """Heads over the source's own vocabularies, on the whole training frame: their facts."""
    fitted = heads.train_heads(job_frame(spark, folder), training.NATIVE_HEADS, stored=True)
    return heads.summary_table(spark, fitted).select("head", "n_rows", "classes", "baseline")


@query(
    "e9_vocabulary_fits",
    over_many(
        ["postings", "training"],
        """SELECT CASE head WHEN 'bands' THEN 'merged' ELSE 'native' END AS vocabulary, n_rows, classes, baseline, TRUE AS consistent
        FROM native_facts WHERE head IN ('bands', 'experience_native')""",
        NATIVE_CLASSES,
    ),
)
def vocabulary_fits(spark, folder):
    """The six levels and the three bands, each fitted out of fold: sizes, baselines and whether the lift follows."""
    metrics, _ = training.compare_experience_vocabularies(job_frame(spark, folder))
    lift = F.abs(F.col("accuracy") - F.col("baseline") - F.col("lift")) < 1e-5
    return metrics.select("vocabulary", "n_rows", F.col("classes").cast("int").alias("classes"), "baseline", lift.alias("consistent"))


_GROUPS = f"SELECT doc_id AS row_id, unhex(md5({group_sql('text')})) AS g FROM documents"


@query(
    "m1_balanced_fold",
    f"""WITH RECURSIVE rows AS ({_GROUPS}), sized AS (
      SELECT g, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, md5(g), g) AS i FROM rows GROUP BY g
    ), dealt AS (
      SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BLOB) AS g, CAST(0 AS INTEGER) AS fold, [0, 0, 0, 0, 0]::BIGINT[] AS loads
      UNION ALL
      SELECT s.i, s.g, CAST(list_position(d.loads, list_min(d.loads)) - 1 AS INTEGER),
        list_transform(d.loads, lambda x, k: CASE WHEN k = list_position(d.loads, list_min(d.loads)) THEN x + s.n ELSE x END)
      FROM dealt d JOIN sized s ON s.i = d.i + 1
    ) SELECT row_id, fold FROM rows JOIN dealt USING (g)""",
)
def balanced_fold(spark, folder):
    """Folds of all documents, their groups dealt out by size."""
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), group_hash(F.col("text")).alias("group"))
    return splits.balanced_folds(rows).select("row_id", "fold")


@query(
    "m2_exact_quota",
    f"""WITH rows AS ({_GROUPS}), ranked AS (
      SELECT g, row_number() OVER (ORDER BY md5(CAST('42:' AS BLOB) || g)) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT g FROM rows)
    ) SELECT row_id, i <= floor(0.2 * n) AS held_out FROM rows JOIN ranked USING (g)""",
)
def exact_quota(spark, folder):
    """The calibration part of all documents: exactly a fifth of the groups."""
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), group_hash(F.col("text")).alias("group"))
    return splits.exact_quota(rows).select("row_id", "held_out")


@query(
    "s6_load_heads",
    over_many(
        ["postings", "training"],
        """SELECT head, CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS INTEGER) AS classes,
        round(100.0e0 * max(n) / sum(n), 6) AS baseline FROM head_classes GROUP BY head""",
        HEAD_CLASSES,
    ),
)
def load_heads(spark, folder):
    """Size and baseline of the stored heads; those with fewer than two classes were not fitted."""
    summary = heads.summary_table(spark, loaded_heads(spark, folder))
    return summary.select("head", "n_rows", "classes", "baseline")


@query(
    "s10_save_head",
    over_many(["postings", "training"], "SELECT head, class FROM head_classes", HEAD_CLASSES),
)
def save_head(spark, folder):
    """Classes of every stored head, from the stored facts."""
    stored = stored_heads(spark, folder)
    facts = [
        spark.read.parquet(f"{stored}/{name}/info").withColumn("head", F.lit(name))
        for name in loaded_heads(spark, folder)
    ]
    whole = facts[0]
    for part in facts[1:]:
        whole = whole.unionByName(part)
    classes = F.from_json(F.get_json_object("info", "$.info.classes"), "array<string>")
    return whole.select("head", F.explode(classes).alias("class"))


def _predicted(spark, folder) -> DataFrame:
    jobs = view(spark, folder, "jobs").select("id", "title", "description")
    return predict.predict_batch(jobs, loaded_heads(spark, folder))


RULED = rule_updates("jobs").replace(" WHERE classified_at IS NULL", "")


@query("p1_predict_batch", over("jobs", "SELECT id, remote_rule AS remote_mode, TRUE AS sound FROM column_ruled", RULED))
def predict_batch(spark, folder):
    """Six labels of every job and the confidence of the role head: what is known whatever the heads say."""
    predicted = _predicted(spark, folder)
    sound = F.coalesce(F.col("conf").between(0.0, 100.0), F.lit(True))
    for column in TARGET_COLUMNS:
        sound = sound & F.col(column).isNotNull()
    return predicted.select("id", "remote_mode", sound.alias("sound"))


@query(
    "p1_rule_decided",
    over(
        "jobs",
        """SELECT id, title_reason, CASE WHEN title_reason <> '' THEN new_role END AS ruled_role, collar_code IS NOT NULL AS collar_ruled,
        CASE WHEN collar_code IS NOT NULL THEN new_collar END AS ruled_collar, remote_rule AS remote_mode FROM column_ruled""",
        rule_updates("jobs").replace(" WHERE classified_at IS NULL", ""),
    ),
)
def rule_decided(spark, folder):
    """The part of the predictions that the rules fix, whatever the heads say."""
    predicted = _predicted(spark, folder)
    ruled = F.col("title_reason") != ""
    collar = columns.collar_code(blank_if_null(F.col("title"))).isNotNull()
    # "Director, Engineering" keeps the head's role, which SQL cannot know.
    keeps = predicted.withColumn("_function", titles.title_rule(blank_if_null(F.col("title"))))
    role = F.when(ruled & (F.col("_function") != 5), F.col("role")).when(ruled, F.lit(""))
    return keeps.select(
        "id",
        "title_reason",
        role.alias("ruled_role"),
        collar.alias("collar_ruled"),
        F.when(collar, F.col("collar")).alias("ruled_collar"),
        "remote_mode",
    )


@query("p2_predict_detail", over("jobs", "SELECT id, TRUE AS sound FROM jobs"))
def predict_detail(spark, folder):
    jobs = view(spark, folder, "jobs").select("id", "title", "description")
    detail = predict.predict_detail(jobs, loaded_heads(spark, folder))
    sound = F.lit(True)
    for column in TARGET_COLUMNS:
        part = F.col(column)
        sound = sound & part["value"].isNotNull() & part["review"].isNotNull() & part["note"].isNotNull()
        sound = sound & F.coalesce(part["conf"].between(0.0, 100.0), F.lit(True))
    return detail.select("id", sound.alias("sound"))


@query("s8_write_predictions", over("jobs", "SELECT title, count(*) AS n FROM jobs GROUP BY ALL"))
def write_predictions(spark, folder):
    """The written predictions read back: rows by title."""
    path = new_folder(spark, "predictions")
    jobs = view(spark, folder, "jobs").select("id", "title", "description")
    detail = predict.predict_detail(jobs, loaded_heads(spark, folder))
    tables.write_predictions(predict.flat_predictions(detail), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("title").agg(F.count("*").alias("n"))


@query(
    "s9_write_sample_results",
    over(
        "jobs",
        """SELECT b.id, substring(coalesce(title, ''), 1, 80) AS title, new_industry AS industry, new_role AS role,
        new_job_type AS job_type, new_experience AS experience_level, new_collar AS collar, remote_rule AS remote_mode,
        new_notes AS rules_fired FROM column_ruled b""",
        rule_updates("jobs"),
    ),
)
def write_sample_results(spark, folder):
    """The rule layers over unknown labels, written and read back."""
    path = new_folder(spark, "sample")
    jobs = view(spark, folder, "jobs").filter(F.col("classified_at").isNull())
    tables.write_sample_results(predict.sample_results(rules_only(jobs)), path)
    return spark.read.parquet(path)
