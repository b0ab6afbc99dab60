"""Learned heads: fit, calibrate, predict out of fold, gate and store.

A head is a Spark ML pipeline over two columns, an array of ``terms`` and an ``embedding``.
Two learners exist. ``logistic`` is a multinomial logistic regression: one fit for all
classes, with probabilities. ``svm`` is a squared-hinge linear SVM per class with sigmoid
calibration on held-out margins, averaged over three group-disjoint splits; all such heads and
all their folds are fitted together (``joint``).
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sortlane.functions.text import let
from sortlane.operators import joint, svm
from sortlane.operators.curation import class_floor
from sortlane.operators.evaluation import find_threshold, gate_curve, head_metrics
from sortlane.operators.features import assemble
from sortlane.operators.splits import balanced_weights, calibration_usable, fold_of, held_out
from sortlane.operators.tfidf import (
    scratch_columns,
    tfidf_stages,
    vocabularies_by_fold,
    vocabulary,
)
from sortlane.plans.workspace import materialise
from sortlane.rules import labels as fixed


@dataclass
class HeadSpec:
    """What a head predicts and how it is fitted."""

    name: str
    label: str
    floor: int = fixed.DEFAULT_CLASS_FLOOR
    learner: str = "logistic"
    separate_gate: bool = True
    min_kept: int = fixed.MIN_KEPT_HELD_OUT
    label_source: str = "curated"
    folds: int = fixed.FOLDS
    max_iter: int = fixed.SVM_MAX_ITER
    tolerance: float = 1e-4
    svm_c: float = fixed.SVM_C
    min_df: int = fixed.NGRAM_MIN_DF
    max_features: int = fixed.NGRAM_MAX_FEATURES
    parallelism: int = 4


@dataclass
class HeadInfo:
    """Facts stored next to a fitted head."""

    name: str
    classes: list[str]
    learner: str
    n_train: int
    threshold: float | None
    gatable: bool
    gate_precision: float | None
    gate_coverage: float | None
    accuracy: float
    macro_f1: float
    kappa: float | None
    baseline: float
    lift: float
    label_source: str
    threshold_from: str
    evaluation: str = "group-disjoint folds"
    extra: dict = field(default_factory=dict)


@dataclass
class Head:
    """Feature stages and the fitted classifiers, with the class names in order."""

    info: HeadInfo
    features: PipelineModel
    # One entry per averaged model: a multinomial model or a ``MarginMember``.
    members: list


@dataclass
class MarginMember:
    """Margins of all classes of one or several splits, split by split, and for each its sigmoid's
    (slope, offset) or a fixed share."""

    model: LogisticRegressionModel
    sigmoids: list


class MissingHeads(Exception):
    pass


def class_index(label: Column, classes: list[str]) -> Column:
    """Position of a label in the ordered class list, as a double; null if it is not in it."""
    pairs = [x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))]
    return F.try_element_at(F.create_map(*pairs), label.cast("string"))


def _vocab_rows(vocab: DataFrame) -> list:
    """The capped vocabulary, in term order."""
    return sorted(vocab.select("term", "idf").collect(), key=lambda r: r["term"])


def _feature_pipeline(
    spark: SparkSession, name: str, vocab_rows: list, with_embedding: bool
) -> PipelineModel:
    """Stages from ``terms`` and ``embedding_vector`` to <name>_features."""
    inputs, stages = [], []
    if vocab_rows:
        stages += tfidf_stages(spark, vocab_rows, f"{name}_")
        inputs.append(f"{name}_tfidf")
    if with_embedding:
        inputs.append("embedding_vector")
    if not inputs:
        raise ValueError("no features: no term reaches the minimum and there is no embedding")
    stages.append(assemble(inputs, f"{name}_features"))
    return PipelineModel(stages)


def needs_vectors(head: Head) -> bool:
    """Whether the head was fitted on embeddings."""
    return "embedding_vector" in head.features.stages[-1].getInputCols()


def featurise(df: DataFrame, features: dict[str, PipelineModel]) -> DataFrame:
    """Add <name>_features for several heads at once.

    The heads go through their stages side by side, so that the Arrow steps of all of them
    are one round trip per batch.
    """
    wide = df
    if "embedding" in df.columns:
        vector = array_to_vector(F.col("embedding").cast("array<double>"))
        wide = df.withColumn("embedding_vector", vector)
    longest = max(len(f.stages) for f in features.values())
    for step in range(longest):
        for pipeline in features.values():
            if step < len(pipeline.stages):
                wide = pipeline.stages[step].transform(wide)
    scratch = {"embedding_vector"}
    for name in features:
        scratch |= {*scratch_columns(f"{name}_"), f"{name}_tfidf"}
    return wide.drop(*[c for c in wide.columns if c in scratch])


def _fit_logistic(train: DataFrame, classes: int, spec: HeadSpec, n: int) -> LogisticRegressionModel:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label_index",
        weightCol="weight",
        family="multinomial",
        regParam=1.0 / (spec.svm_c * max(n, 1)),
        standardization=False,
        maxIter=spec.max_iter,
        tol=spec.tolerance,
    ).fit(train)


def _margin_model(spark: SparkSession, weights: np.ndarray, constants: np.ndarray) -> LogisticRegressionModel:
    """A linear model whose raw predictions are the margins of all classes; ``weights`` is (classes, features)."""
    sc = spark.sparkContext
    matrix = DenseMatrix(*weights.shape, weights.ravel(order="F"))
    kind = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    return LogisticRegressionModel(kind(f"margins-{uuid.uuid4().hex}", _py2java(sc, matrix), _py2java(sc, Vectors.dense(constants)), len(constants), True))


def _joint_head(spark: SparkSession, fits: joint.JointFit, number: int, spec: HeadSpec) -> Head:
    """The final fit of one head as stages and one member, the calibration splits side by side."""
    fit = next(f for f in fits.fits if f.head == number and f.kind == "final")
    k, splits = fit.classes, fixed.CALIBRATION_FOLDS
    known = np.flatnonzero(fits.idf[:, fit.number] > 0)
    vocab = [{"term": fits.terms[i], "idf": float(fits.idf[i, fit.number])} for i in known.tolist()]
    features = _feature_pipeline(spark, spec.name, vocab, fits.dimensions > 0)
    order = []
    if vocab:
        place = dict(zip((v["term"] for v in vocab), known.tolist()))
        order = [place[t] for t in features.stages[0].vocabulary]
    width = len(fits.terms) + fits.dimensions + 1
    w = svm.coefficients(fits.fitted.state, fit, splits * k, width)
    used = w[[*order, *range(len(fits.terms), width - 1)]]
    member = MarginMember(_margin_model(spark, used.T, w[-1]), fits.sigmoids[fit.number])
    return Head(_bare_info(spec, fits.classes[number]), features, [member])


def _side_by_side(df: DataFrame, task, items: list, threads: int) -> list:
    """Independent fits from several driver threads, to fill the gaps between short jobs."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(task), items))


def _logistic_member(
    df: DataFrame, features: str, model: LogisticRegressionModel, tag: str
) -> DataFrame:
    """Class probabilities of a multinomial model."""
    renamed = {
        model.featuresCol: features,
        model.probabilityCol: tag + "p",
        model.rawPredictionCol: tag + "r",
        model.predictionCol: tag + "c",
    }
    scored = model.copy(renamed).transform(df)
    return scored.withColumn(tag, vector_to_array(tag + "p")).drop(tag + "p", tag + "r", tag + "c")


def _margin_scores(df: DataFrame, features: str, member: MarginMember, classes: int, tag: str) -> DataFrame:
    """Sigmoids of the margins of every split, scaled to sum up to one."""
    model = member.model
    renamed = {
        model.featuresCol: features,
        model.probabilityCol: tag + "p",
        model.rawPredictionCol: tag + "r",
        model.predictionCol: tag + "c",
    }
    scored = model.copy(renamed).transform(df).withColumn(tag, vector_to_array(tag + "r"))
    sigmoids = []
    for c, fitted in enumerate(member.sigmoids):
        if isinstance(fitted, float):
            sigmoids.append(F.lit(fitted))
        else:
            sigmoids.append(1 / (1 + F.exp(-(F.get(tag, F.lit(c)) * fitted[0] + fitted[1]))))
    splits = [sigmoids[at : at + classes] for at in range(0, len(sigmoids), classes)]
    probs = [let(F.array(*own), lambda scores: joint.shares(scores, F.lit(classes))) for own in splits]
    return scored.withColumns({f"{tag}_{s}": p for s, p in enumerate(probs)}).drop(tag, tag + "p", tag + "r", tag + "c")


def _probabilities(df: DataFrame, features: str, members: list, classes: int) -> DataFrame:
    """Add ``probs``, one probability per class, averaged over the members and their splits."""
    tags = []
    for m, member in enumerate(members):
        if isinstance(member, LogisticRegressionModel):
            df = _logistic_member(df, features, member, f"_m{m}")
            tags.append(f"_m{m}")
        else:
            df = _margin_scores(df, features, member, classes, f"_m{m}")
            tags += [f"_m{m}_{s}" for s in range(len(member.sigmoids) // classes)]
    if len(tags) == 1:
        return df.withColumnRenamed(tags[0], "probs")
    sums = [sum((F.get(tag, F.lit(c)) for tag in tags[1:]), F.get(tags[0], F.lit(c))) for c in range(classes)]
    return df.withColumn("probs", F.array(*[s / len(tags) for s in sums])).drop(*tags)


def fitting_report(members: list, max_iter: int) -> dict:
    """Most iterations of the logistic fits just made, and whether all ended before the limit."""
    steps = [m.summary.totalIterations for m in members]
    return {"iterations": max(steps, default=0), "converged": all(x < max_iter for x in steps), "unfitted": 0}


def _joint_report(fits: joint.JointFit, number: int) -> dict:
    """Passes and rounds of the joint fits, and what the head's final fit reached."""
    final = next(f for f in fits.fits if f.head == number and f.kind == "final")
    gap = float(fits.fitted.gap[final.number].max())
    return {
        "iterations": fits.fitted.passes,
        "rounds": fits.fitted.rounds,
        "converged": gap <= svm.TOLERANCE,
        "gap": gap,
        "unfitted": sum(isinstance(s, float) for s in fits.sigmoids[final.number]),
    }


def ranked_classes(probs: Column) -> Column:
    """Classes from most to least probable as (p, index); ties go to the earlier class."""
    pairs = F.transform(probs, lambda p, i: F.struct(p.alias("p"), (-i).alias("minus_index")))
    return F.reverse(F.array_sort(pairs))


def top_two(df: DataFrame, classes: list[str], prefix: str = "") -> DataFrame:
    """Replace ``probs`` by the best label, its confidence and the second label."""
    ranked = df.withColumn("_ranked", ranked_classes(F.col("probs"))).drop("probs")
    names = F.array(*[F.lit(c) for c in classes])

    def label(rank: int) -> Column:
        return F.get(names, -F.get(F.col("_ranked"), F.lit(rank))["minus_index"])

    return ranked.withColumns(
        {
            prefix + "top1": label(0),
            prefix + "top2": label(1),
            prefix + "conf": F.get(F.col("_ranked"), F.lit(0))["p"],
        }
    ).drop("_ranked")


def score(df: DataFrame, head: Head, prefix: str = "") -> DataFrame:
    """Add the head's best label, runner-up and confidence to every row, without a shuffle."""
    name = head.info.name
    wide = featurise(df, {name: head.features})
    return _score_features(wide, head, prefix)


def score_all(df: DataFrame, heads: dict[str, Head]) -> DataFrame:
    """Like ``score`` for several heads; the columns are prefixed by the head's key."""
    wide = featurise(df, {h.info.name: h.features for h in heads.values()})
    for key, head in heads.items():
        wide = _score_features(wide, head, f"{key}_")
    return wide


def _score_features(wide: DataFrame, head: Head, prefix: str) -> DataFrame:
    column = f"{head.info.name}_features"
    with_probs = _probabilities(wide, column, head.members, len(head.info.classes))
    return top_two(with_probs.drop(column), head.info.classes, prefix)


def training_rows(df: DataFrame, spec: HeadSpec) -> DataFrame:
    """Labelled rows of learnable classes, ready to be reused over folds.

    ``df`` holds ``row_id``, ``group``, the label, ``terms`` and possibly ``embedding``.
    """
    keep = ["row_id", "group", "terms"] + (["embedding"] if "embedding" in df.columns else [])
    labelled = df.filter(F.col(spec.label).isNotNull()).select(
        *keep, F.col(spec.label).cast("string").alias("y")
    )
    return class_floor(labelled, "y", spec.floor).withColumns(
        {"fold": fold_of(F.col("group"), spec.folds), "held_out": held_out(F.col("group"))}
    )


def _prepare(rows: DataFrame, classes: list[str]) -> DataFrame:
    weighted = balanced_weights(rows, "y")
    return weighted.withColumn("label_index", class_index(F.col("y"), classes))


def _fit_on(train: DataFrame, vocab_rows: list, classes: list[str], spec: HeadSpec) -> Head:
    features = _feature_pipeline(
        train.sparkSession, spec.name, vocab_rows, "embedding" in train.columns
    )
    wide = featurise(_prepare(train, classes), {spec.name: features}).select(
        "label_index", "weight", F.col(f"{spec.name}_features").alias("features")
    )
    # Stored, so that an iteration's tasks read vectors and carry no feature stages.
    frame = materialise(wide, "vectors")
    return Head(_bare_info(spec, classes), features, [_fit_logistic(frame, len(classes), spec, frame.count())])


def out_of_fold(rows: DataFrame, classes: list[str], spec: HeadSpec) -> DataFrame:
    """Every row scored by a model that saw neither it nor any other row of its group."""
    if spec.learner == "svm":
        fits = joint.fit_jointly(rows, [replace(spec, label="y", separate_gate=False)], classes=[classes], final=False)
        return fits.predictions.filter("kind = 'fold'").select("row_id", "fold", "y", "p", "conf")
    vocab = vocabularies_by_fold(
        rows, folds=spec.folds, min_df=spec.min_df, max_features=spec.max_features
    )
    per_fold: dict[int, list] = {f: [] for f in range(spec.folds)}
    # At most folds x max_features rows.
    for r in vocab.select("fold", "term", "idf").collect():
        per_fold[r["fold"]].append(r)
    present = sorted(r["fold"] for r in rows.select("fold").distinct().collect())

    def one_fold(f: int) -> DataFrame:
        vocab_rows = sorted(per_fold[f], key=lambda r: r["term"])
        head = _fit_on(rows.filter(F.col("fold") != f), vocab_rows, classes, spec)
        test = score(rows.filter(F.col("fold") == f), head)
        return test.select("row_id", "fold", "y", F.col("top1").alias("p"), "conf")

    scored = _side_by_side(rows, one_fold, present, spec.parallelism)
    whole = scored[0]
    for part in scored[1:]:
        whole = whole.unionByName(part)
    return whole


def fit_head(train: DataFrame, classes: list[str], spec: HeadSpec, vocab: DataFrame | None) -> Head:
    """Fit on rows of ``training_rows`` shape, without evaluation or gate."""
    if spec.learner == "svm":
        fits = joint.fit_jointly(train, [replace(spec, label="y")], True, _vocab_rows(vocab) if vocab is not None else [], [classes])
        return _joint_head(train.sparkSession, fits, 0, spec)
    return _fit_on(train, _vocab_rows(vocab) if vocab is not None else [], classes, spec)


def _bare_info(spec: HeadSpec, classes: list[str]) -> HeadInfo:
    return HeadInfo(
        spec.name, classes, spec.learner, 0, None, False, None, None, 0.0, 0.0, None, 0.0, 0.0,
        spec.label_source, "",
    )


def _gate_predictions(rows: DataFrame, classes: list[str], spec: HeadSpec) -> DataFrame | None:
    """Held-out rows scored by a model fitted on the rest, if the split is usable."""
    usable = calibration_usable(rows, "y", "held_out", len(classes)).first()["usable"]
    if not usable:
        return None
    rest, held = rows.filter(~F.col("held_out")), rows.filter(F.col("held_out"))
    vocab = vocabulary(rest, min_df=spec.min_df, max_features=spec.max_features)
    head = fit_head(rest, classes, spec, vocab)
    return score(held, head).select("y", F.col("top1").alias("p"), "conf")


def _info(spec: HeadSpec, classes: list[str], metrics: Row, gate: Row | None, source: str, extra: dict) -> HeadInfo:
    return HeadInfo(
        name=spec.name,
        classes=classes,
        learner=spec.learner,
        n_train=metrics["n_rows"],
        threshold=gate["threshold"] if gate else None,
        gatable=bool(gate and gate["gatable"]),
        gate_precision=gate["precision_pct"] if gate else None,
        gate_coverage=gate["coverage_pct"] if gate else None,
        accuracy=metrics["accuracy"],
        macro_f1=metrics["macro_f1"],
        kappa=metrics["kappa"],
        baseline=metrics["baseline"],
        lift=metrics["lift"],
        label_source=spec.label_source,
        threshold_from=source,
        extra=extra,
    )


SEPARATE, OUT_OF_FOLD = "separate group-disjoint part", "out-of-fold predictions"


def _train_jointly(df: DataFrame, specs: list[HeadSpec]) -> tuple[dict[str, Head], DataFrame | None]:
    """All heads from one joint fit, and their out-of-fold predictions (head, row_id, fold, y, p, conf)."""
    fits = joint.fit_jointly(df, specs)
    if fits is None:
        return {}, None
    predictions = materialise(fits.predictions, "out-of-fold")
    folds = predictions.filter("kind = 'fold'")
    metrics = {r["head"]: r for r in head_metrics(folds, by=["head"]).collect()}
    gated = [h for h, s in enumerate(specs) if s.separate_gate]
    apart = F.col("head").isin(gated)
    curve = materialise(gate_curve(predictions.filter(F.when(apart, F.col("kind") == "gate").otherwise(F.col("kind") == "fold")), by=["head"]), "gate-curves")
    gates = {}
    for least in {s.min_kept for s in specs}:
        for r in find_threshold(curve, least, by=["head"]).collect():
            if specs[r["head"]].min_kept == least:
                gates[r["head"]] = r

    def finished(h: int) -> Head:
        spec = specs[h]
        head = _joint_head(df.sparkSession, fits, h, spec)
        source = (SEPARATE if spec.separate_gate else OUT_OF_FOLD) if h in gates else "none"
        head.info = _info(spec, fits.classes[h], metrics[h], gates.get(h), source, _joint_report(fits, h))
        return head

    heads = _side_by_side(df, finished, sorted(metrics), specs[0].parallelism)
    return {head.info.name: head for head in heads}, folds.drop("kind")


def train_head(df: DataFrame, spec: HeadSpec) -> tuple[Head | None, DataFrame | None]:
    """Evaluate out of fold, set the gate, then fit on all rows.

    Returns the head and its out-of-fold predictions; nothing where fewer than two classes
    are learnable.
    """
    if spec.learner == "svm":
        heads, predictions = _train_jointly(df, [spec])
        return heads.get(spec.name), predictions.drop("head") if heads else None
    rows = materialise(training_rows(df, spec), "training-rows")
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    if len(classes) < 2:
        return None, None
    predictions = materialise(out_of_fold(rows, classes, spec), "out-of-fold")
    metrics = head_metrics(predictions).first()
    gate_rows = _gate_predictions(rows, classes, spec) if spec.separate_gate else predictions
    source = "none" if gate_rows is None else SEPARATE if spec.separate_gate else OUT_OF_FOLD
    gate = None if gate_rows is None else find_threshold(gate_curve(gate_rows), spec.min_kept).first()
    vocab = vocabulary(rows, min_df=spec.min_df, max_features=spec.max_features)
    head = fit_head(rows, classes, spec, vocab)
    head.info = _info(spec, classes, metrics, gate, source, fitting_report(head.members, spec.max_iter))
    return head, predictions


def _shared_options(spec: HeadSpec) -> tuple:
    return spec.learner, spec.folds, spec.svm_c, spec.min_df, spec.max_features


def train_heads(df: DataFrame, specs: list[HeadSpec], stored: bool = False) -> dict[str, Head]:
    """Fit every head over one shared, stored frame of terms and embeddings; ``stored`` says that ``df`` is one.

    SVM heads that share their options are fitted together.
    """
    shared = df if stored else materialise(df, "training-frame")
    fitted = {}
    for options in dict.fromkeys(_shared_options(s) for s in specs if s.learner == "svm"):
        fitted |= _train_jointly(shared, [s for s in specs if _shared_options(s) == options])[0]
    for spec in specs:
        if spec.learner != "svm":
            head, _ = train_head(shared, spec)
            if head is not None:
                fitted[spec.name] = head
    return {s.name: fitted[s.name] for s in specs if s.name in fitted}


def summary_table(spark: SparkSession, heads: dict[str, Head]) -> DataFrame:
    """One row per head: rows, classes, scores, baseline and lift."""
    rows = [
        (
            h.info.name, h.info.n_train, len(h.info.classes), h.info.accuracy, h.info.macro_f1,
            h.info.kappa, h.info.baseline, h.info.lift, h.info.threshold, h.info.gatable,
        )
        for h in heads.values()
    ]
    return spark.createDataFrame(
        rows,
        "head string, n_rows long, classes int, accuracy double, macro_f1 double, kappa double,"
        " baseline double, lift double, threshold double, gatable boolean",
    )


# --- storage --------------------------------------------------------------------------


def save_head(spark: SparkSession, head: Head, path: str) -> None:
    """Write the stages as ML models and the facts as one row of JSON."""
    head.features.write().overwrite().save(f"{path}/features")
    shape = []
    for m, member in enumerate(head.members):
        own = isinstance(member, MarginMember)
        (member.model if own else member).write().overwrite().save(f"{path}/member{m}")
        shape.append(member.sigmoids if own else None)
    payload = json.dumps({"info": asdict(head.info), "members": shape})
    spark.createDataFrame([(payload,)], "info string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/info"
    )


def save_heads(df: DataFrame, heads: dict[str, Head], folder: str) -> None:
    """Every head below ``folder``; their many small files are written side by side."""
    _side_by_side(df, lambda item: save_head(df.sparkSession, item[1], f"{folder}/{item[0]}"), list(heads.items()), len(heads) or 1)


def load_head(spark: SparkSession, path: str) -> Head:
    payload = json.loads(spark.read.parquet(f"{path}/info").first()["info"])
    members = []
    for m, sigmoids in enumerate(payload["members"]):
        model = LogisticRegressionModel.load(f"{path}/member{m}")
        if sigmoids is not None:
            model = MarginMember(model, [tuple(s) if isinstance(s, list) else s for s in sigmoids])
        members.append(model)
    return Head(HeadInfo(**payload["info"]), PipelineModel.load(f"{path}/features"), members)


def load_heads(spark: SparkSession, folder: str, names: list[str]) -> dict[str, Head]:
    """The heads found under ``folder``; a missing one is reported and left out."""
    import warnings

    heads = {}
    jvm = spark._jvm
    for name in names:
        location = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/info")
        files = location.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(location):
            heads[name] = load_head(spark, f"{folder}/{name}")
        else:
            warnings.warn(f"head '{name}' is missing, its column stays blank", stacklevel=2)
    if not heads:
        raise MissingHeads(f"no heads under {folder}")
    return heads
