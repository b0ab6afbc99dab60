"""Registered queries: a name, a Spark callable and, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sortlane.catalog.fixtures import VIEWS

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return add


def over(view: str, select: str, more: str = "") -> str:
    """SQL over one of the fixture views; ``more`` holds further CTEs."""
    return f"WITH {view} AS ({VIEWS[view]}){', ' + more if more else ''}\n{select}"


def over_many(views: list[str], select: str, more: str = "") -> str:
    parts = [f"{v} AS ({VIEWS[v]})" for v in views]
    return f"WITH {', '.join(parts)}{', ' + more if more else ''}\n{select}"


# --- DuckDB text helpers --------------------------------------------------------------

# Blanks as the engine counts them; RE2's \s knows the ASCII ones only.
BLANKS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def hit(column: str, pattern: str) -> str:
    """A pattern in any case."""
    return f"regexp_matches({column}, {quoted('(?i)' + pattern)})"


def low_hit(column: str, pattern: str) -> str:
    """A pattern over lower-case text."""
    return f"regexp_matches({column}, {quoted('(?s)' + pattern)})"


def sub(column: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({column}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def squeeze(column: str) -> str:
    return f"trim({sub(column, BLANKS + '+', ' ')})"


def stripped(column: str) -> str:
    return sub(column, f"^{BLANKS}+|{BLANKS}+$", "")


def no_tags(column: str) -> str:
    return squeeze(sub(f"coalesce({column}, '')", "<[^>]+>", " "))


def title_sql(column: str) -> str:
    ws = BLANKS
    numbers = rf"{ws}*\((?:[\d,\s#/-]+)\){ws}*$"
    reference = rf"{ws}*[-#]{ws}*\d{{3,}}{ws}*$"
    return squeeze(sub(sub(f"coalesce({column}, '')", numbers, ""), reference, ""))


def description_sql(column: str) -> str:
    return squeeze(sub(sub(f"coalesce({column}, '')", "<[^>]+>", " "), "&[a-z#0-9]+;", " "))


def fold_sql(column: str) -> str:
    return f"replace(lower({column}), 'ß', 'ss')"


def key_sql(title: str, description: str) -> str:
    """The join key as one text."""
    t = fold_sql(title_sql(title))
    d = fold_sql(f"substring({description_sql(description)}, 1, 180)")
    return f"concat({t}, chr(10), {d})"


def group_sql(column: str) -> str:
    return f"substring(lower({squeeze('coalesce(' + column + ', chr(32))')}), 1, 300)"


def model_text_sql(title: str, description: str) -> str:
    return f"trim(concat({no_tags(title)}, ' . ', substring({no_tags(description)}, 1, 600)))"


def cases(column: str, rules: list[tuple[str, str]], matcher=low_hit) -> str:
    """The WHEN branches of an ordered rule list."""
    return "\n".join(f"WHEN {matcher(column, p)} THEN {quoted(v)}" for v, p in rules)
