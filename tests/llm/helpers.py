"""Small tables with everything awkward in them."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, doc long, part string, node int, "
    "key string, size string, copies string, chance string, `start` int, row string, _doc int, words int"
)


def documents(spark, rows):
    """(doc_id, text, source) rows with columns whose names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), -7, "p", -8, "k", "z", "c", "h", -9, "r", -3, -4) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, n: int) -> str:
    """Words that hardly repeat."""
    state, out = seed * 2654435761 % (1 << 32) + 1, []
    for _ in range(n):
        state = (1103515245 * state + 12345) % (1 << 31)
        out.append("".join(chr(97 + (state >> k) % 26) for k in (3, 7, 11, 15, 19)))
    return " ".join(out)


PASSAGE = prose(99, 60)
AWKWARD = [
    (0, None, "a"),
    (1, "", "a"),
    (2, " \n\t ", "a"),
    (3, "word", "a"),
    (4, "Two words", None),
    (5, prose(1, 80) + "\n" + PASSAGE, "b"),
    (6, PASSAGE + " " + prose(2, 70), "b"),
    (7, prose(3, 4000), "b"),
    (8, prose(4, 50), "b"),
    (9, prose(4, 50), "c"),
    (10, prose(4, 49) + " zzzzz", "c"),
    (10, prose(5, 30) + " " + PASSAGE, "c"),
    (11, "same line again\n" * 40, "c"),
    (12, "été " + "naïve façade  " * 9 + "<|endoftext|> x", None),
    (12, "été " + "naïve façade  " * 9 + "<|endoftext|> x", None),
    (None, prose(6, 40) + " " + PASSAGE, "d"),
    (13, "a" * 3000, "d"),
    (14, prose(7, 400) + " " + prose(7, 400), "d"),
]
