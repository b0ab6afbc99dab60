"""Learned heads: features, folds, both learners, gate, storage and prediction."""

from __future__ import annotations

import warnings

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sortlane.functions.terms import with_terms
from sortlane.operators import features, heads, joint, predict, tfidf
from sortlane.plans import training
from sortlane.schema import TARGET_COLUMNS

WORDS = {
    "a": ["red", "rose", "petal", "garden"],
    "b": ["steel", "bolt", "wrench", "garage"],
    "c": ["note", "chord", "tempo", "garden"],
}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = []
    for i in range(240):
        y = "abc"[i % 3]
        words = [WORDS[y][k] for k in rng.integers(0, 4, 6)] + [f"w{k}" for k in rng.integers(0, 9, 3)]
        vector = [float(x) for x in rng.normal(size=4) + 3 * np.eye(4)[i % 3]]
        made.append((i, f"group {i // 2}", " ".join(words), vector, y))
    df = spark.createDataFrame(made, "row_id long, group string, text string, embedding array<float>, y string")
    # Two partitions: the fits below are many short jobs.
    few = df.coalesce(2)
    return with_terms(few, "text").drop("text").withColumnRenamed("y", "label").cache()


def spec(**changes):
    base = dict(name="letter", label="label", floor=5, max_iter=8, min_kept=20)
    return heads.HeadSpec(**(base | changes))


def test_pipeline_weights_equal_the_long_form(spark, rows):
    vocab = tfidf.vocabulary(rows)
    vocab_rows = vocab.collect()
    frame = rows
    stages = tfidf.tfidf_stages(spark, vocab_rows)
    for stage in stages:
        frame = stage.transform(frame)
    names = stages[0].vocabulary
    dense = frame.select("row_id", vector_to_array("tfidf").alias("v")).collect()
    got = {(r.row_id, names[i]): w for r in dense for i, w in enumerate(r.v) if w}
    long = {(r.row_id, r.term): r.weight for r in tfidf.tfidf_long(rows, vocab).collect()}
    assert got.keys() == long.keys()
    assert all(got[k] == pytest.approx(long[k]) for k in got)


def test_long_form_makes_terms_once(spark):
    """No filter before the shuffle looks at the terms, which would make them a second time."""
    texts = spark.createDataFrame([(1, "red rose red"), (2, ""), (3, "a b"), (4, None)], "row_id long, text string").repartition(2)
    vocab = spark.createDataFrame([("red", 1.0), ("rose", 2.0)], "term string, idf double")
    long = tfidf.tfidf_long(with_terms(texts, "text"), vocab)
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "size(" not in plan
    assert {(r.row_id, r.term, r.tf) for r in long.collect()} == {(1, "red", 2), (1, "rose", 1)}


def test_fold_vocabularies_equal_separate_fits(rows):
    folded = rows.withColumn("fold", (F.col("row_id") % 5).cast("int"))
    shared = tfidf.vocabularies_by_fold(folded, max_features=40).collect()
    for f in range(5):
        alone = tfidf.vocabulary(folded.filter(F.col("fold") != f), max_features=40).collect()
        got = {(r.term, r.cf, r.df, round(r.idf, 9)) for r in shared if r.fold == f}
        assert got == {(r.term, r.cf, r.df, round(r.idf, 9)) for r in alone}


@pytest.mark.parametrize(("learner", "folds"), [("logistic", 5), ("svm", 2)])
def test_train_store_load(spark, rows, tmp_path, learner, folds):
    head, oof = heads.train_head(rows, spec(learner=learner, folds=folds))
    scored = oof.collect()
    assert sorted(r.row_id for r in scored) == list(range(240))
    groups = {r.row_id: r.group for r in rows.select("row_id", "group").collect()}
    folds_of_group = {}
    for r in scored:
        folds_of_group.setdefault(groups[r.row_id], set()).add(r.fold)
    assert all(len(f) == 1 for f in folds_of_group.values())
    assert head.info.accuracy > 90 and head.info.classes == ["a", "b", "c"]
    assert all(0 <= r.conf <= 1 for r in scored)

    heads.save_head(spark, head, str(tmp_path / "stored" / "letter"))
    again = heads.load_head(spark, str(tmp_path / "stored" / "letter"))
    assert again.info == head.info
    first = heads.score(rows, head).select("row_id", "top1", "top2", F.round("conf", 9)).collect()
    second = heads.score(rows, again).select("row_id", "top1", "top2", F.round("conf", 9)).collect()
    assert sorted(first) == sorted(second)


def test_two_class_svm(rows):
    binary = rows.filter("label <> 'c'")
    frame = heads.training_rows(binary, spec(learner="svm"))
    head = heads.fit_head(frame, ["a", "b"], spec(learner="svm"), tfidf.vocabulary(frame))
    right = heads.score(frame, head).filter("y = top1 and top1 <> top2 and conf >= 0.5").count()
    assert right > 0.95 * frame.count()


@pytest.mark.parametrize("learner", ["svm", "logistic"])
def test_thin_class_in_one_group(spark, rows, tmp_path, learner):
    """A class of six rows in one group leaves splits with one label; nothing fails."""
    thin = rows.filter("row_id < 6").withColumns({"label": F.lit("z"), "group": F.lit("lone"), "row_id": F.col("row_id") + 1000})
    both = rows.filter("label <> 'c'").unionByName(thin).coalesce(2)
    head, oof = heads.train_head(both, spec(learner=learner, folds=2))
    assert head.info.classes == ["a", "b", "z"] and oof.count() == 166
    assert head.info.extra["iterations"] > 0 and (head.info.extra["unfitted"] > 0) == (learner == "svm")
    assert head.info.accuracy > 85
    heads.save_head(spark, head, str(tmp_path / "thin"))
    again = heads.load_head(spark, str(tmp_path / "thin"))
    scores = [heads.score(both, h).select("row_id", F.round("conf", 9)).collect() for h in (head, again)]
    assert sorted(scores[0]) == sorted(scores[1]) and all(0 <= r[1] <= 1 for r in scores[0])


def test_many_rows_in_few_groups_meet_all_splits(spark):
    """Three groups that the hash puts into one split, with 400 rows of a class."""
    by_hash = spark.range(60).select(F.concat(F.lit("g"), "id").alias("group")).withColumn("split", F.pmod(F.xxhash64("group"), F.lit(3)))
    few = [r.group for r in by_hash.filter("split = 0").limit(3).collect()]
    train = [(few[i % 3], [1]) for i in range(400)] + [(f"other{i}", [0]) for i in range(400)]
    parted = joint._dealt_groups(spark.createDataFrame(train, "group string, y array<int>"), 3).withColumn("split", F.get("split", F.lit(0)))
    assert {r.split for r in parted.filter("y[0] = 1").select("split").distinct().collect()} == {0, 1, 2}
    assert parted.select("group", "split").distinct().count() == 403 and parted.count() == 800


def test_gate_needs_enough_held_out_rows(rows):
    head, _ = heads.train_head(rows, spec(folds=2))
    assert (head.info.threshold, head.info.gatable, head.info.threshold_from) == (None, False, "none")
    gated, _ = heads.train_head(rows, spec(separate_gate=False, folds=2))
    assert gated.info.gatable and gated.info.threshold >= 0.2


def test_nothing_to_learn(rows):
    assert heads.train_head(rows.filter("label = 'a'"), spec()) == (None, None)


def test_missing_heads_stay_blank(spark, tmp_path):
    text = spark.createDataFrame(
        [(i, "Red garden" if i % 2 else "Steel bolt", "rose petal" if i % 2 else "wrench garage", "x" if i % 2 else "y") for i in range(60)],
        "row_id long, title string, description string, role string",
    )
    frame = with_terms(text.withColumn("t", F.concat_ws(" . ", "title", "description")), "t").withColumn("group", F.col("row_id").cast("string"))
    head, _ = heads.train_head(frame.coalesce(2), spec(name="role", label="role", folds=2))
    heads.save_head(spark, head, str(tmp_path / "role"))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        loaded = heads.load_heads(spark, str(tmp_path), TARGET_COLUMNS)
    assert set(loaded) == {"role"} and sum("missing" in str(w.message) for w in caught) == 5
    with pytest.raises(heads.MissingHeads), warnings.catch_warnings():
        warnings.simplefilter("ignore")
        heads.load_heads(spark, str(tmp_path / "nowhere"), TARGET_COLUMNS)

    jobs = text.select(F.col("row_id").cast("string").alias("id"), "title", "description")
    batch = predict.predict_batch(jobs, loaded).collect()
    assert {r.industry for r in batch} == {""} and {r.role for r in batch} == {"x", "y"}
    assert {r.remote_mode for r in batch} == {"On-site"}
    detail = predict.predict_detail(jobs, loaded).first()
    assert (detail.collar.value, detail.collar.review, detail.collar.note) == ("", True, "model_missing")
    flat = predict.flat_predictions(predict.predict_detail(jobs, loaded))
    assert flat.columns[:5] == ["title", "industry", "industry_conf", "industry_review", "industry_note"]
    plan = predict.predict_batch(jobs, loaded)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_heads_over_vectors_take_stored_ones_or_an_encoder(spark, rows):
    frame = heads.training_rows(rows, spec(name="role"))
    head = heads.fit_head(frame, ["a", "b", "c"], spec(name="role"), tfidf.vocabulary(frame))
    jobs = rows.limit(6).select(F.col("row_id").cast("string").alias("id"), F.lit("red").alias("title"), F.lit("rose petal").alias("description"), "embedding")
    assert heads.needs_vectors(head)
    with pytest.raises(ValueError, match="fitted on vectors"):
        predict.predict_batch(jobs.drop("embedding"), {"role": head})
    stored = predict.predict_batch(jobs, {"role": head})
    assert stored.count() == 6 and "embedding" in stored.columns
    encoded = predict.predict_batch(jobs.drop("embedding"), {"role": head}, lambda: lambda texts: np.ones((len(texts), 4)))
    assert encoded.count() == 6 and "embedding" not in encoded.columns


def test_encoder_is_called_in_batches_and_gives_unit_vectors(spark):
    def make():
        def encode(texts):
            assert len(texts) <= 4
            return [[len(t), 1.0, 0.0] for t in texts]

        return encode

    df = spark.createDataFrame([(f"title {i}", "x" * i) for i in range(30)], "title string, description string")
    vectors = [r.embedding for r in features.encode(df, make, batch_size=4).collect()]
    assert all(np.linalg.norm(v) == pytest.approx(1, abs=1e-6) for v in vectors)


def test_alignment_is_enforced(spark):
    rows = spark.range(4).withColumnRenamed("id", "row_id")
    vectors = rows.withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)))
    features.check_alignment(rows, vectors)
    with pytest.raises(ValueError):
        features.check_alignment(rows, vectors.filter("row_id < 3"))


def test_training_frame_targets(spark):
    rows = [
        (1, "A", "hybrid schedule", "I", "Designer", "Full-time", "Director", "Remote"),
        (2, "B", "text", "I", "Others", "Volunteer", "Associate", ""),
        (3, "C", "other text", "", "Driver & Logistics", "", "", ""),
    ]
    df = spark.createDataFrame(rows, "row_id long, title string, description string, industry string, role string, job_type string, experience_band string, remote_type string")
    got = {r.row_id: r for r in training.training_frame(df).collect()}
    assert (got[1].job_type_5, got[1].experience_4, got[1].experience_3, got[1].collar) == ("Full-time", "Senior", "Senior", "White")
    assert (got[1].remote_label, got[1].remote_binary) == ("Hybrid", "Remote")
    assert (got[2].job_type_5, got[2].experience_4, got[2].collar, got[2].remote_binary) == (None, "Mid", None, "Not-remote")
    assert (got[3].industry, got[3].job_type, got[3].remote_binary, got[3].collar) == (None, None, None, "Blue")
