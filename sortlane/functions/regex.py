"""Regular expressions as Catalyst columns.

Two families of patterns exist. *Text* patterns are matched without regard to case and
with Unicode classes, where ``.`` stops at a newline only. *Lowered* patterns run over text
that is already lower case, and there ``.`` spans newlines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_FLAGS = "(?iudU)"
LOWERED_FLAGS = "(?sU)"

# Unicode \s leaves out the four ASCII separators that count as blanks here. Needs (?U).
WHITESPACE = r"[\s\x1c-\x1f]"


def text(pattern: str) -> str:
    return TEXT_FLAGS + pattern


def lowered(pattern: str) -> str:
    return LOWERED_FLAGS + pattern


def matches(column: Column, pattern: str) -> Column:
    """The text pattern occurs somewhere in the column."""
    return column.rlike(text(pattern))


def matches_lowered(column: Column, pattern: str) -> Column:
    return column.rlike(lowered(pattern))


# The characters beside a-z that match an ASCII letter when case is ignored, as they are
# before lower-casing; the Kelvin sign needs no mention, it lower-cases to k.
ODD_LETTERS = "\u0130\u0131\u017f"


@dataclass(frozen=True)
class LongText:
    """A long text with what a cheap look at it needs: the lower-cased text, and whether it
    has letters that lower-casing does not bring to ASCII although a pattern accepts them."""

    text: Column
    low: Column
    odd: Column

    def matches(self, pattern: str, needs: Sequence[str]) -> Column:
        """The text pattern occurs; ``needs`` are lower-case strings, one of which is part of
        every possible match. A search for a plain string is far cheaper than the pattern and
        settles most texts."""
        return (self.odd | contains_any(self.low, needs)) & matches(self.text, pattern)


def with_long_text(df: DataFrame, name: str, value: Column) -> tuple[DataFrame, LongText, list[str]]:
    """Add a text and its helpers, each computed once; returns the names to drop later."""
    low, odd = name + "_low", name + "_odd"
    first = df.withColumn(name, value)
    scoped = first.withColumns({low: F.lower(name), odd: contains_any(F.col(name), ODD_LETTERS)})
    return scoped, LongText(F.col(name), F.col(low), F.col(odd)), [name, low, odd]


def contains_any(column: Column, needs: Sequence[str]) -> Column:
    found = F.lit(False)
    for literal in needs:
        found = found | column.contains(literal)
    return found


def first_match(rules: Sequence[tuple[Column, object]], otherwise: Column | None = None) -> Column:
    """Value of the first rule whose condition holds; null (or ``otherwise``) if none does."""
    chain = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(otherwise) if otherwise is not None else chain
