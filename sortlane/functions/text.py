"""Text normalisation as column expressions (no Python in the row path)."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sortlane.functions.regex import WHITESPACE, matches

# --- Fixed values ---------------------------------------------------------------------

TRAILING_NUMBER_GROUP = r"\s*\((?:[\d,\s#/-]+)\)\s*$"
TRAILING_REFERENCE = r"\s*[-#]\s*\d{3,}\s*$"
MARKUP_TAG = r"<[^>]+>"
MARKUP_ENTITY = r"&[a-z#0-9]+;"
NON_ENGLISH = (
    r"[äöüßÄÖÜéèêàçñÉÈÀ]|\b(und|für|mit|der|die|das|pour|avec|les|des|dans)\b"
)
KEY_CHARS = 180
GROUP_CHARS = 300
MODEL_TEXT_CHARS = 600
LANGUAGE_CHARS = 200
ENCODER_PREFIX = "query: "
TITLE_TEXT_SEPARATOR = " . "

# --------------------------------------------------------------------------------------


def blank_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def collapse(column: Column) -> Column:
    """Runs of whitespace become one space; none at either end."""
    return F.trim(F.regexp_replace(column, f"(?U){WHITESPACE}+", " "))


def strip(column: Column) -> Column:
    """Drop whitespace of any kind from both ends."""
    ws = WHITESPACE
    return F.regexp_replace(column, rf"(?U)\A{ws}+|{ws}+\z", "")


def clean_title(title: Column) -> Column:
    t = F.regexp_replace(blank_if_null(title), "(?U)" + TRAILING_NUMBER_GROUP, "")
    t = F.regexp_replace(t, "(?U)" + TRAILING_REFERENCE, "")
    return collapse(t)


def clean_description(description: Column) -> Column:
    d = F.regexp_replace(blank_if_null(description), MARKUP_TAG, " ")
    return collapse(F.regexp_replace(d, MARKUP_ENTITY, " "))


def strip_html(column: Column) -> Column:
    return collapse(F.regexp_replace(blank_if_null(column), MARKUP_TAG, " "))


@lru_cache(maxsize=1)
def _fold_exceptions() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Lower-case characters whose case fold differs from themselves.

    Returned as the two sides of a one-to-one translation plus the characters that fold to
    several. Derived from the interpreter's Unicode data.
    """
    one_from, one_to, many = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        ch = chr(point)
        if ch.lower() != ch or ch.casefold() == ch:
            continue
        folded = ch.casefold()
        if len(folded) == 1:
            one_from.append(ch)
            one_to.append(folded)
        else:
            many.append((ch, folded))
    return "".join(one_from), "".join(one_to), tuple(many)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def casefold(column: Column) -> Column:
    one_from, one_to, many = _fold_exceptions()
    # One literal "from to" per line: cheap to build and folded to a constant array.
    pairs = F.split(F.lit("\n".join(f"{a} {b}" for a, b in many)), "\n")
    rare = "[" + "".join(ch for ch, _ in many) + "]"

    def expand(text: Column) -> Column:
        expanded = F.aggregate(
            pairs,
            text,
            lambda t, p: F.replace(t, F.substring_index(p, " ", 1), F.substring_index(p, " ", -1)),
        )
        return F.when(text.rlike(rare), expanded).otherwise(text)

    return let(F.translate(F.lower(column), one_from, one_to), expand)


def key_title(title: Column) -> Column:
    return casefold(clean_title(title))


def key_description(description: Column) -> Column:
    return casefold(F.substring(clean_description(description), 1, KEY_CHARS))


def key_hash(title: Column, description: Column) -> Column:
    """The join key as 16 bytes: what is shuffled instead of up to 180+ characters."""
    return F.unhex(F.md5(F.concat(key_title(title), F.lit("\n"), key_description(description))))


def model_text(title: Column, description: Column) -> Column:
    """Text scored by the heads: both parts cleaned, the description cut."""
    body = F.substring(strip_html(description), 1, MODEL_TEXT_CHARS)
    return F.trim(F.concat(strip_html(title), F.lit(TITLE_TEXT_SEPARATOR), body))


def training_text(title: Column, description: Column) -> Column:
    """Text the heads are fitted on: neither cleaned nor cut."""
    return strip(
        F.concat(blank_if_null(title), F.lit(TITLE_TEXT_SEPARATOR), blank_if_null(description))
    )


def encoder_text(title: Column, description: Column) -> Column:
    return F.concat(F.lit(ENCODER_PREFIX), model_text(title, description))


def normal_form(column: Column) -> Column:
    return F.lower(collapse(blank_if_null(column)))


def group_key(description: Column) -> Column:
    return F.substring(normal_form(description), 1, GROUP_CHARS)


def group_hash(description: Column) -> Column:
    """The group key as 16 bytes."""
    return F.unhex(F.md5(group_key(description)))


def non_english(title: Column, description: Column) -> Column:
    head = F.substring(blank_if_null(description), 1, LANGUAGE_CHARS)
    return matches(F.concat(blank_if_null(title), F.lit(" "), head), NON_ENGLISH)


def lowered_title(title: Column) -> Column:
    return F.lower(blank_if_null(title))


def lowered_text(title: Column, description: Column) -> Column:
    return F.lower(F.concat(blank_if_null(title), F.lit(" "), blank_if_null(description)))


def title_and_text(title: Column, description: Column) -> Column:
    """Title and description on separate lines, the scope of most text rules."""
    return F.concat(blank_if_null(title), F.lit("\n"), blank_if_null(description))
