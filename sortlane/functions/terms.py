"""Terms of a text: accent folding, tokens, one- and two-grams."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sortlane.functions.text import let

TOKEN = r"[\p{L}\p{N}_]{2,}"


HANGUL, LAST_HANGUL = 0xAC00, 0xD7A3
# Holds every character that folds to several, in few ranges, since each is tried for each character.
PERHAPS_SEVERAL = r"[\u00BC-\u00BE\u0132-\u0149\u01C4-\u01F3\u0587-\x{10FFFF}]"


def _folded(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters that fold to something else, Hangul syllables left out.

    Returned as the two sides of a translation, the characters that vanish standing last, plus
    those that fold to several. Derived from the interpreter's Unicode data.
    """
    one, gone, many = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        ch = chr(point)
        if not unicodedata.decomposition(ch) and not unicodedata.combining(ch):
            continue
        folded = _folded(ch)
        if not folded:
            gone.append(ch)
        elif len(folded) == 1:
            one.append((ch, folded))
        else:
            many.append((ch, folded))
    return "".join(c for c, _ in one) + "".join(gone), "".join(f for _, f in one), tuple(many)


def _place(ch: Column) -> Column:
    """Where a character stands in the listing of those that fold to several, 0 if it doesn't."""
    return F.position(F.concat(F.lit("\n"), ch, F.lit("\t")), F.lit(_listing()))


def _listing() -> str:
    return "\n" + "".join(f"{a}\t{b}\n" for a, b in _fold_table()[2])


def _several(ch: Column) -> Column:
    """What a character folds to that folds to several: from a listing, Hangul syllables by arithmetic."""
    longest = max(len(b) for _, b in _fold_table()[2])
    known = F.substring_index(F.substring(F.lit(_listing()), _place(ch) + 3, F.lit(longest + 1)), "\n", 1)
    # A lead, a vowel and perhaps a tail.
    number = F.ascii(ch) - HANGUL
    lead = "".join(_folded(chr(HANGUL + i * 588))[0] for i in range(19))
    vowel = "".join(_folded(chr(HANGUL + i * 28))[1] for i in range(21))
    tail = "".join(_folded(chr(HANGUL + i))[2] for i in range(1, 28))
    syllable = F.concat(
        F.substring(F.lit(lead), F.floor(number / 588).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(vowel), F.floor(number % 588 / 28).cast("int") + 1, F.lit(1)),
        F.when(number % 28 > 0, F.substring(F.lit(tail), number % 28, F.lit(1))).otherwise(""),
    )
    return F.when(ch.between(chr(HANGUL), chr(LAST_HANGUL)), syllable).otherwise(known)


def strip_accents(column: Column) -> Column:
    """Compatibility decomposition without combining marks.

    Without the marks nothing is left to reorder, so characters fold one by one: those that fold
    to one or none in a translation, the rare other ones each where it occurs.
    """
    source, target, _ = _fold_table()

    def expand(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({PERHAPS_SEVERAL})")))
        each = F.filter(found, lambda c: c.between(chr(HANGUL), chr(LAST_HANGUL)) | (_place(c) > 0))
        expanded = F.aggregate(each, text, lambda t, c: F.replace(t, c, _several(c)))
        return F.when(text.rlike(PERHAPS_SEVERAL), expanded).otherwise(text)

    folded = let(F.translate(column, source, target), expand)
    return F.when(column.rlike(r"[^\x00-\x7F]"), folded).otherwise(column)


def tokens(folded: Column) -> Column:
    """Runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(folded, F.lit(TOKEN), F.lit(0))


def bigrams(words: Column) -> Column:
    """Neighbouring tokens joined by a space."""
    following = F.slice(words, 2, 2_000_000_000)
    # The last token has no neighbour; its pair comes out null and is dropped.
    return F.array_compact(F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b)))


def with_terms(df, text: str, out: str = "terms"):
    """Add the one- and two-grams of a text as one array.

    Lowered and folded text and tokens get projections of their own, so each is computed once.
    """
    lowered = df.withColumn("_lowered", F.lower(F.col(text)))
    folded = lowered.withColumn("_folded", strip_accents(F.col("_lowered"))).drop("_lowered")
    words = folded.withColumn("_words", tokens(F.col("_folded"))).drop("_folded")
    return words.withColumn(out, F.concat("_words", bigrams(F.col("_words")))).drop("_words")
