"""Title overrides for industry and role: participation offers, traps, leaders by function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.regex import first_match, matches
from sortlane.functions.text import blank_if_null
from sortlane.rules import titles as fixed


def is_participation_offer(title: Column) -> Column:
    return matches(title, fixed.JUNK) & ~matches(title, fixed.JUNK_EXEMPT)


def _outcomes() -> list[tuple[str, str, str | None]]:
    """(reason, industry, role) of every rule, in priority order."""
    return (
        [(fixed.REASON_JUNK, *fixed.JUNK_CLASS)]
        + [(fixed.REASON_TRAP, ind, role) for _, ind, role in fixed.TRAPS]
        + [(fixed.REASON_LEADER, ind, role) for _, ind, role in fixed.LEADER_FUNCTIONS]
    )


def title_rule(title: Column) -> Column:
    """Number of the first title rule that fires, null if none does."""
    conditions = [is_participation_offer(title)]
    conditions += [matches(title, pattern) for pattern, _, _ in fixed.TRAPS]
    leader = matches(title, fixed.LEADER)
    conditions += [leader & matches(title, pattern) for pattern, _, _ in fixed.LEADER_FUNCTIONS]
    return first_match([(c, number) for number, c in enumerate(conditions)])


def rule_reason(rule: Column) -> Column:
    return first_match([(rule == i, o[0]) for i, o in enumerate(_outcomes())], F.lit(""))


def rule_industry(rule: Column, current: Column) -> Column:
    return first_match([(rule == i, o[1]) for i, o in enumerate(_outcomes())], current)


def rule_role(rule: Column, current: Column) -> Column:
    return first_match([(rule == i, o[2]) for i, o in enumerate(_outcomes()) if o[2]], current)


def apply_title_rules(
    df: DataFrame,
    title: str = "title",
    industry: str = "industry",
    role: str = "role",
    reason: str = "title_reason",
) -> DataFrame:
    """Override industry and role in place and add the reason ('' when no rule fired)."""
    ruled = df.withColumn("_title_rule", title_rule(blank_if_null(F.col(title))))
    rule = F.col("_title_rule")
    return ruled.withColumns(
        {
            industry: rule_industry(rule, F.col(industry)),
            role: rule_role(rule, F.col(role)),
            reason: rule_reason(rule),
        }
    ).drop("_title_rule")


def wants_second_label(label: Column, confidence: Column, threshold: Column) -> Column:
    """Uncertain between two real classes; the catch-all class is never ambiguous."""
    return (confidence < threshold) & (label != fixed.UNCLASSIFIED_ROLE)
