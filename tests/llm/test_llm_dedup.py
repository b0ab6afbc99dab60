"""MinHash, substring and suffix dedup against brute force."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from helpers import AWKWARD, PASSAGE, documents, prose

from sortlane.llm import components, minhash, substring, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width, per_cent):
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for g, (d, _) in zip(group, rows):
        d = -(1 << 63) if d is None else d
        least[g] = min(least.get(g, d), d)
    return sorted((str(d), len(s), str(None if least[g] < 0 else least[g])) for g, s, (d, _) in zip(group, sets, rows))


def test_groups_of_awkward_rows(awkward):
    for width in (2, 5):
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in minhash.grouped(awkward, width, 80).collect())
        assert got == brute_components([(d, t) for d, t, _ in AWKWARD], width, 80)


def test_chains_and_hubs_of_near_copies(spark):
    base = prose(11, 120).split()
    rows = []
    for i in range(60):  # near the base, but not always near each other
        words = list(base)
        for k in range(i % 8):
            words[(17 * i + 31 * k) % 120] = f"x{i}y{k}"
        rows.append((100 - i, " ".join(words), "s"))
    rows += [(200 + i, prose(300 + i, 90), "s") for i in range(20)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in minhash.grouped(documents(spark, rows)).collect())
    assert got == brute_components([(d, t) for d, t, _ in rows], 2, 80)


def test_pairs_of_a_large_group_are_no_rows(spark, monkeypatch):
    """Sets that are near each other but not linked are told apart in their blocks, not by a row for each pair."""
    base, rows = prose(21, 200).split(), []
    for i in range(160):
        words = list(base)
        for k in range(12):
            words[(37 * i + 16 * k) % 200] = f"x{i}y{k}"
        rows.append((i, " ".join(words), "s"))
    rows += [(500 + i, t + " more", s) for i, t, s in rows[:20]]
    tried, plain = [], minhash.confirmed

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(minhash, "confirmed", counted)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in minhash.grouped(documents(spark, rows)).collect())
    assert got == brute_components([(d, t) for d, t, _ in rows], 2, 80)
    print("pairs tried as rows", tried)
    assert sum(tried) < 5000


def test_keep_one_keeps_rows_whole(awkward):
    kept = minhash.keep_one(awkward, 5, 80)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert {0, 1, 2, 3, 8} <= set(ids) and 9 not in ids and ids.count(12) == 1
    assert all(r.node == -8 and r._doc == -3 for r in rows)


def test_sketches_agree_like_the_sets():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 1 << 62, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[200:1200])
    sketch = minhash.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 2048)
    assert (sketch != 0).all()
    assert abs((sketch[0] == sketch[1]).mean() - 800 / 1200) < 0.05
    one = minhash.sketches(pool[:1], np.array([0, 1]), 64)
    assert (one != 0).all()


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (None, 1), *[(50 + i, 51 + i) for i in range(40)], *[(200, 201 + i) for i in range(30)]]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got[5] == got[4] == got[3] == 3 and got[9] == 8 and 7 not in got
    assert {got[50 + i] for i in range(41)} == {50} and {got[201 + i] for i in range(30)} == {200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_more_links_are_merged(spark):
    first = components.components(spark.createDataFrame([(5, 4), (9, 8), (20, 21)], "a long, b long"))
    more = spark.createDataFrame([(5, 9), (8, 9), (30, 31), (40, 20)], "a long, b long")
    got = sorted(tuple(r) for r in components.merged(first, more).collect())
    assert got == [(4, 4), (5, 4), (8, 4), (9, 4), (20, 20), (21, 20), (30, 30), (31, 30), (40, 20)]


def brute_words(rows, k=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        words = WORD.findall(rows[i][1] or "")
        gone = set()
        for at in range(len(words) - k + 1):
            window = tuple(words[at : at + k])
            if window in seen:
                gone.update(range(at, at + k))
            seen.add(window)
        out.append((str(rows[i][0]), len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return sorted(out)


ONE_TEXT_EACH = [r for n, r in enumerate(AWKWARD) if n not in (11, 14)]


def test_substrings(spark):
    rows = documents(spark, ONE_TEXT_EACH)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring.remove(rows).collect())
    assert got == brute_words([(d, t) for d, t, _ in ONE_TEXT_EACH])


def test_substrings_of_repeated_ids(awkward):
    rows = substring.remove(awkward).collect()
    assert len(rows) == len(AWKWARD)
    twins = [r for r in rows if r.doc_id == 12]
    assert twins[0] == twins[1] and twins[0].n_removed == 0
    # The null id comes first, so the passage stays there and goes everywhere else.
    assert sum(PASSAGE in r.kept for r in rows) == 1 and [r.n_removed for r in rows if r.doc_id is None] == [0]


def test_deduplicated_keeps_columns(awkward):
    out = substring.deduplicated(awkward)
    assert out.columns == awkward.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[2].text == " \n\t " and rows[0].text is None and PASSAGE not in rows[6].text and rows[6].start == -9


def brute_bytes(rows, k=400):
    raw = [(t or "").encode() for _, t in rows]
    times = Counter(b[i : i + k] for b in raw for i in range(len(b) - k + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        gone = [False] * len(b)
        for i in range(len(b) - k + 1):
            if times[b[i : i + k]] > 1:
                gone[i : i + k] = [True] * k
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(d), len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out)


def test_suffixes(spark, awkward):
    long_ = "".join(PASSAGE)
    for frame, rows in (
        (awkward, AWKWARD),
        (documents(spark, x := [(1, long_ * 3, "a"), (2, "é" + long_ * 2, "a"), (3, "b" * 399, "a"), (4, "b" * 400, "a")]), x),
    ):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove(frame).collect())
        assert got == brute_bytes([(d, t) for d, t, _ in rows])


def test_frequent_passages_are_found(spark):
    """A passage in every document: its grams are listed as frequent, and the rows stay right."""
    rows = [(i, prose(500 + i, 30) + " " + PASSAGE + " " + prose(900 + i, 30), "s") for i in range(80)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring.remove(documents(spark, rows)).collect())
    assert got == brute_words([(d, t) for d, t, _ in rows])
    from sortlane.llm import superkmers

    grams = superkmers.frequent_grams(documents(spark, rows), substring.scheme())
    assert len(grams) == 60 - substring.GRAM + 1


def test_no_documents(nothing):
    for out in (minhash.grouped(nothing), minhash.keep_one(nothing), substring.remove(nothing), substring.deduplicated(nothing), suffixes.remove(nothing)):
        assert out.count() == 0


def test_texts_outside_buckets_are_not_packed(spark, monkeypatch):
    """Wide rows pass a bitmap of the wanted keys before they are shuffled: all wanted ones, few others."""
    from pyspark.sql import functions as F

    from sortlane.llm import tables

    rows = spark.range(20_000).select(F.col("id").alias("doc"), (F.col("id") % 3).alias("part"), F.lit("x").alias("text"))
    wanted = rows.filter("doc % 100 = 7").select("doc", "part")
    left = tables.likely_among(rows, wanted, ["doc", "part"])
    assert left.columns == rows.columns
    assert left.join(wanted, ["doc", "part"]).count() == 200 and left.count() < 400
    assert tables.likely_among(rows, wanted.limit(0), ["doc", "part"]).count() == 0
    # Too many keys for the bitmap cost rows that pass, never a wanted one.
    monkeypatch.setattr(tables, "BITMAP_WORDS", 1)
    assert tables.likely_among(rows, wanted, ["doc", "part"]).join(wanted, ["doc", "part"]).count() == 200
    seen = []
    monkeypatch.setattr(minhash, "map_arrow", lambda df, run, schema: seen.append(df) or tables.map_arrow(df, run, schema))
    monkeypatch.setattr(tables, "BITMAP_WORDS", 1 << 18)
    texts = rows.select("*")
    texts.several = False
    packed = minhash._packed(texts, wanted.withColumn("node", F.col("doc")))
    assert packed.count() == 200 and seen[0].count() < 400
