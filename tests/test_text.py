"""Text functions against Python on awkward and on generated texts."""

from __future__ import annotations

import re
import sys
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sortlane.functions import terms
from sortlane.functions import text as fn
from sortlane.operators import tfidf

AWKWARD = [
    "",
    " ",
    "Straße ẞ ﬁn ΑΣ ς İ ı",
    "a\x1cb\x1f \x85c d　",
    "<p>one</p>&amp;two &AMP; three<br/>",
    "Project Manager #12345",
    "Product Owner (1,234)",
    "Nurse (12) - 00123",
    "Driver - 12",
    "x < y > z <unclosed",
    "éàü ñ ́ ½ ² ǅ",
    "tab\tand\nnewline\r\n",
]


def one_column(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    return [r[1] for r in df.select("n", column(F.col("t"))).orderBy("n").collect()]


def squeeze(t):
    return re.sub(r"\s+", " ", t).strip()


def check_all(spark, texts):
    assert one_column(spark, texts, fn.casefold) == [t.casefold() for t in texts]
    assert one_column(spark, texts, fn.collapse) == [squeeze(t) for t in texts]
    assert one_column(spark, texts, fn.strip) == [t.strip() for t in texts]
    assert one_column(spark, texts, fn.strip_html) == [
        squeeze(re.sub("<[^>]+>", " ", t)) for t in texts
    ]
    folded = [
        "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        for t in texts
    ]
    assert one_column(spark, texts, terms.strip_accents) == folded
    words = [re.findall(r"\w\w+", t) for t in folded]
    df = spark.createDataFrame(list(enumerate(folded)), "n int, t string")
    got = df.select("n", terms.tokens(F.col("t")).alias("w")).orderBy("n")
    assert [r.w for r in got.collect()] == words


def test_awkward_texts(spark):
    check_all(spark, AWKWARD)


# Letters, digits, blanks and markup; no surrogates, no marks that start a text.
CHARACTERS = st.sampled_from(list("abzAZßéüñçΣς09_ \t\n  \x1c<>/&;#-(),.'’ﬁŒłИй漢字"))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(CHARACTERS, max_size=60), min_size=20, max_size=20))
def test_generated_texts(spark_for_hypothesis, texts):
    check_all(spark_for_hypothesis, texts)


def test_clean_title(spark):
    got = one_column(spark, AWKWARD[5:9], fn.clean_title)
    assert got == ["Project Manager", "Product Owner", "Nurse (12)", "Driver - 12"]


def test_clean_description_keeps_upper_case_entities(spark):
    (got,) = one_column(spark, [AWKWARD[4]], fn.clean_description)
    assert got == "one two &AMP; three"


def test_null_texts(spark):
    df = spark.createDataFrame([(None, None)], "t string, d string")
    row = df.select(
        fn.model_text(F.col("t"), F.col("d")),
        fn.group_key(F.col("d")),
        fn.key_title(F.col("t")),
        fn.non_english(F.col("t"), F.col("d")),
        terms.strip_accents(F.col("t")),
    ).first()
    assert list(row) == [".", "", "", False, None]


def test_bigrams_and_terms(spark):
    df = spark.createDataFrame([("One two two",), ("a",), ("",)], "text string")
    got = [r.terms for r in terms.with_terms(df, "text").collect()]
    assert got == [["one", "two", "two", "one two", "two two"], [], []]


def test_accents_without_python(spark):
    """Every character that folds, alone and between others, and no batch of texts in a Python worker."""
    def folded(text):
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))

    points = [chr(p) for p in range(0x80, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    odd = [c for c in points if folded(c) != c and not "가" <= c <= "힣"]
    odd += [chr(p) for p in range(0xAC00, 0xD7A4, 37)]
    texts = ["a" + "b".join(odd[i : i + 40]) for i in range(0, len(odd), 40)] + ["ẹ́x", "한국어 ½ … “q”", "漢字"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").withColumn("f", terms.strip_accents(F.col("t")))
    assert [r.f for r in df.orderBy("n").collect()] == [folded(t) for t in texts]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_fold_are_in_every_vocabulary(spark):
    """A row of no fold is nobody's to leave out."""
    rows = [(0, ["a", "a", "b"]), (1, ["a", "b"]), (None, ["a", "c"]), (None, ["c"])]
    df = spark.createDataFrame(rows, "fold int, terms array<string>")
    found = tfidf.vocabularies_by_fold(df, folds=2, min_df=1).collect()
    assert {(r.fold, r.term, r.cf, r.df) for r in found} == {
        (0, "a", 2, 2), (0, "b", 1, 1), (0, "c", 2, 2), (1, "a", 3, 2), (1, "b", 1, 1), (1, "c", 2, 2)
    }


def test_terms_are_counted_without_python(spark):
    df = spark.createDataFrame([("Été à Zürich",), ("ete a zurich",)], "text string")
    counted = tfidf.term_statistics(terms.with_terms(df, "text"))
    assert {(r.term, r.cf, r.df) for r in counted.collect()} == {("ete", 2, 2), ("zurich", 2, 2), ("ete zurich", 2, 2)}
    assert "Python" not in counted._jdf.queryExecution().executedPlan().toString()
