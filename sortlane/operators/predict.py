"""Prediction: score all heads, apply the rule layers, decide what needs review."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.terms import with_terms
from sortlane.functions.text import model_text
from sortlane.operators.columns import apply_column_rules, notes_text
from sortlane.operators.features import encode
from sortlane.operators.heads import Head, needs_vectors, score_all
from sortlane.operators.titles import apply_title_rules, wants_second_label
from sortlane.schema import TARGET_COLUMNS

TITLE_RULED = ["industry", "role"]
COLUMN_RULED = ["job_type", "experience_level", "collar", "remote_mode"]


def score_heads(df: DataFrame, heads: dict[str, Head], make_encoder: Callable | None = None) -> DataFrame:
    """Add <head>_top1, _top2 and _conf for every head over one shared set of terms and vectors.

    Heads fitted on vectors read the column ``embedding`` or, without one, the vectors of
    ``make_encoder`` (see ``features.encode``), made once for all heads. A missing head yields
    '' with confidence 0. The whole chain is a map over the rows.
    """
    used = {c: heads[c] for c in TARGET_COLUMNS if c in heads}
    dense = [c for c, head in used.items() if needs_vectors(head)]
    encoded = bool(dense) and "embedding" not in df.columns
    if encoded:
        if make_encoder is None:
            raise ValueError(f"heads {dense} were fitted on vectors: give a column 'embedding' or an encoder")
        df = encode(df, make_encoder)
    text = df.withColumn("_text", model_text(F.col("title"), F.col("description")))
    scored = with_terms(text, "_text").drop("_text")
    scored = score_all(scored, used).drop("terms", *(["embedding"] if encoded else []))
    for name in TARGET_COLUMNS:
        if name not in heads:
            scored = scored.withColumns(
                {
                    f"{name}_top1": F.lit(""),
                    f"{name}_top2": F.lit(None).cast("string"),
                    f"{name}_conf": F.lit(0.0),
                }
            )
    return scored


def predict_batch(df: DataFrame, heads: dict[str, Head], make_encoder: Callable | None = None) -> DataFrame:
    """Six labels, the confidence of the role head and the rules that fired."""
    scored = score_heads(df, heads, make_encoder)
    labelled = scored.withColumns({c: F.col(f"{c}_top1") for c in TARGET_COLUMNS})
    return apply_rules(labelled).withColumn("conf", F.col("role_conf")).drop(
        *[f"{c}_{part}" for c in TARGET_COLUMNS for part in ("top1", "top2", "conf")]
    )


def apply_rules(df: DataFrame) -> DataFrame:
    """Title rules, then column rules, over a frame that holds the six labels."""
    return apply_column_rules(apply_title_rules(df))


def conf_percent(conf: Column) -> Column:
    return F.round(conf * 100, 1)


def review_title_ruled(rule_fired: Column, conf: Column, threshold: Column) -> Column:
    """Industry and role: below the threshold, unless a rule decided or there is none."""
    return ~rule_fired & threshold.isNotNull() & F.coalesce(conf < threshold, F.lit(False))


def review_column_ruled(
    present: bool | Column, rule_fired: Column, gatable: Column, conf: Column, threshold: Column
) -> Column:
    """The other four: always without a head, never after a rule, always if ungatable."""
    present = F.lit(present) if isinstance(present, bool) else present
    return (
        F.when(~present, F.lit(True))
        .when(rule_fired, F.lit(False))
        .when(~gatable, F.lit(True))
        .otherwise(F.coalesce(conf < threshold, F.lit(False)))
    )


def note_column_ruled(present: bool | Column, rule_fired: Column, gatable: Column) -> Column:
    present = F.lit(present) if isinstance(present, bool) else present
    return (
        F.when(~present, F.lit("model_missing"))
        .when(rule_fired, F.lit("rule"))
        .when(~gatable, F.lit("ungatable"))
        .otherwise(F.lit(""))
    )


def alternate_label(
    rule_fired: Column, label: Column, conf: Column, threshold: Column, second: Column
) -> Column:
    """The runner-up where the head hesitates between two real classes and no rule decided."""
    torn = F.coalesce(wants_second_label(label, conf, threshold), F.lit(False))
    return F.when(~rule_fired & threshold.isNotNull() & torn, second)


def predict_detail(df: DataFrame, heads: dict[str, Head], make_encoder: Callable | None = None) -> DataFrame:
    """Per column the value, confidence in percent, review flag, second label and note."""
    scored = score_heads(df, heads, make_encoder)
    labelled = scored.withColumns({c: F.col(f"{c}_top1") for c in TARGET_COLUMNS})
    # Title rules need both of their columns; without one of them only the rest is ruled.
    if all(c in heads for c in TITLE_RULED):
        labelled = apply_title_rules(labelled)
    else:
        labelled = labelled.withColumn("title_reason", F.lit(""))
    ruled = apply_column_rules(labelled)
    for c in TARGET_COLUMNS:
        head = heads.get(c)
        threshold = F.lit(head.info.threshold if head else None).cast("double")
        gatable = F.lit(bool(head and head.info.gatable))
        conf, value = F.col(f"{c}_conf"), F.col(c)
        if c in TITLE_RULED:
            fired = F.col("title_reason") != ""
            review = review_title_ruled(fired, conf, threshold)
            second = alternate_label(fired, value, conf, threshold, F.col(f"{c}_top2"))
            note = F.when(fired, F.concat(F.lit("rule:"), "title_reason")).otherwise(F.lit(""))
        else:
            fired = F.lit(c == "remote_mode") | ~value.eqNullSafe(F.col(f"{c}_top1"))
            review = review_column_ruled(head is not None, fired, gatable, conf, threshold)
            second = F.lit(None).cast("string")
            note = note_column_ruled(head is not None, fired, gatable)
        shown = value if head else F.lit("")
        ruled = ruled.withColumn(
            f"{c}_detail",
            F.struct(
                shown.alias("value"),
                conf_percent(conf).alias("conf"),
                review.alias("review"),
                second.alias("alt"),
                note.alias("note"),
            ),
        )
    scratch = [f"{c}_{part}" for c in TARGET_COLUMNS for part in ("top1", "top2", "conf")]
    kept = ruled.drop(*scratch, *TARGET_COLUMNS, "title_reason", "notes")
    return kept.withColumnsRenamed({f"{c}_detail": c for c in TARGET_COLUMNS})


def flat_predictions(detail: DataFrame) -> DataFrame:
    """Title plus value, confidence, review ('yes' or '') and note of every column."""
    columns = [F.col("title")]
    for c in TARGET_COLUMNS:
        columns += [
            F.col(c)["value"].alias(c),
            F.col(c)["conf"].alias(f"{c}_conf"),
            F.when(F.col(c)["review"], F.lit("yes")).otherwise(F.lit("")).alias(f"{c}_review"),
            F.col(c)["note"].alias(f"{c}_note"),
        ]
    return detail.select(*columns)


def sample_results(predictions: DataFrame, title_chars: int = 80) -> DataFrame:
    """Id, shortened title, the six labels ('' if unknown) and the rules that fired."""
    return predictions.select(
        "id",
        F.substring(F.coalesce("title", F.lit("")), 1, title_chars).alias("title"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in TARGET_COLUMNS],
        notes_text(F.col("notes")).alias("rules_fired"),
    )
