"""Filter audit, line dedup and vector codes against brute force and by hand."""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from sortlane.llm import filter_audit, line_dedup, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- filter audit -----------------------------------------------------------------------


def brute_failing(rows):
    """Letters that each (doc_id, text) fails."""
    out = []
    for doc, text in rows:
        text = text or ""
        words = WORD.findall(text)
        earlier = doc is not None and any(d is not None and d < doc and (t or "") == text for d, t in rows)
        hits = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": earlier,
        }
        out.append({k for k, hit in hits.items() if hit})
    return out


def brute_audit(rows, labels):
    """``rows`` are (doc_id, text, source), ``labels`` (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = brute_failing([(d, t) for d, t, _ in rows])
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(d, f) for (d, _, s), f in zip(rows, fails) if (s or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, letter in enumerate(order, 1):
                now = [x for x in left if letter in x[1]]
                redundant = sum(letter in f for _, f in gone)
                left, gone = [x for x in left if letter not in x[1]], gone + now
                removed_by[letter] += len(now)
                only = sum(f == {letter} for _, f in mine)
                out[part, "".join(order), step] = [len(left), len(now), redundant, only, sum(d in good for d, _ in now), sum(d in toxic for d, _ in now)]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                out[part, "".join(order), step].append(removed_by[letter])
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(frame):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in frame.collect()}


def audit_cases():
    rows = [*AWKWARD, (20, "A#b " * 300, "a"), (21, "Q " + prose(3, 4000), "b"), (22, prose(3, 4000), None), (22, prose(3, 4000), ""), (23, prose(3, 4000), "x")]
    rows += [(None, prose(4, 50), "x"), (None, prose(4, 50), "x"), (30, prose(8, 300), "x"), (30, prose(8, 300), "y"), (31, prose(8, 300), "y"), (32, "É" * 400, "x")]
    rows += [(40 + i, prose(8, 300), "hot") for i in range(60)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 110, 2)] + [(31, 0, 1), (31, 1, 0), (33, None, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_audit_equals_brute_force(spark):
    rows, labels = audit_cases()
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    assert audit_rows(filter_audit.audit(documents(spark, rows).repartition(5), marks)) == brute_audit(rows, labels)


def test_audit_without_labels_or_rows(spark, nothing):
    rows, _ = audit_cases()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(documents(spark, rows), none)) == brute_audit(rows, [])
    assert filter_audit.audit(nothing, none).count() == 0


def test_steps_add_up(spark):
    rows, labels = audit_cases()
    got = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    totals = got.groupBy("part", "filter_order").agg(F.sum("removed").alias("removed"), F.min("kept").alias("kept"), F.count("*").alias("n"))
    sizes = {}
    for _, _, s in rows:
        sizes[s or ""] = sizes.get(s or "", 0) + 1
    assert all(r.removed + r.kept == sizes[r.part] and r.n == 5 for r in totals.collect())


def test_positional_popcounts_equal_plain_counts():
    rng = np.random.default_rng(3)
    for n, segments in ((1, 1), (2, 5), (400, 3), (3000, 900)):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        segment, times = rng.integers(0, segments, n), rng.integers(1, 1 << int(rng.integers(1, 34)), n)
        want = np.zeros((segments, 32), dtype=np.int64)
        for w, s, t in zip(words.tolist(), segment.tolist(), times.tolist()):
            want[s] += [t * (w >> b & 1) for b in range(32)]
        assert (filter_audit.positional_popcounts(words, segment, times, segments) == want).all()


def test_a_very_long_text_in_the_audit(spark):
    text = "Word other " * 900_000
    got = audit_rows(filter_audit.audit(documents(spark, [(1, text, "a"), (2, text, "a")]), spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert got["a", "BCDEA", 1][:2] == [0, 2] and got["a", "EBACD", 1][:2] == [1, 1]


# --- line dedup -------------------------------------------------------------------------


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, least, keep_first=False):
    """Sorted (doc_id, lines, dropped, kept text, bitmap as 0/1 string) by row."""
    where = {}
    for doc, text, *_ in rows:
        for i, line in enumerate((text or "").split("\n")):
            where.setdefault(line_key(line), set()).add((-(1 << 63) if doc is None else doc, text or "", i))
    often = {k for k, places in where.items() if k and len({p[:2] for p in places}) >= least}
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        drop = [line_key(x) in often for x in lines]
        kept = [x for x, gone in zip(lines, drop) if not gone]
        out.append((str(doc), len(lines), sum(drop), "\n".join(kept), "".join("01"[not d] for d in drop)))
    return sorted(out)


def line_rows(frame):
    got = []
    for r in frame.collect():
        bits, at, on = "", 0, True
        for end in r.keep:
            bits, at, on = bits + "01"[on] * (end - at), end, not on
        got.append((r.doc_id, r.n_lines, r.n_dropped, bits))
    return got


def line_cases():
    shared = ["Read more", "  read MORE \t", "©2020 Élan", "©2020 élan", "x", ""]
    rows = list(AWKWARD)
    for i in range(40):
        lines = [prose(200 + i, 3), shared[i % 6], prose(300 + i % 25, 2), shared[(i * 5 + 1) % 6], "same", "same"]
        rows.append((100 + i, "\n".join(lines), "s"))
    rows += [(200, "read more\nread more", "s"), (201, "same", None), (201, "same", None), (None, "same\nx\n", "s"), (None, "Read more\r\n\x0b", "s"), (202, "\n\n", "s")]
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_lines_equal_brute_force(spark, monkeypatch, hot):
    rows = line_cases()
    if hot:  # every key is cut into ranges of documents
        monkeypatch.setattr(line_dedup, "HOT_SAMPLE", 1.0)
        monkeypatch.setattr(line_dedup, "LEAST_SAMPLED", 1)
        monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.0)
    frame = documents(spark, rows).repartition(4)
    for least in (2, 10):
        want = brute_lines(rows, least)
        got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in line_dedup.deduplicated(frame, least).collect())
        assert got == [w[:4] for w in want]
        bits = sorted((str(d), n, m, b) for d, n, m, b in line_rows(line_dedup.bitmaps(frame, least)))
        assert bits == sorted((d, n, m, b) for d, n, m, _, b in want)
    assert sum(w[2] for w in want) > 60


@pytest.mark.parametrize("hot", [False, True])
def test_first_lines_can_stay(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(line_dedup, "HOT_SAMPLE", 1.0)
        monkeypatch.setattr(line_dedup, "LEAST_SAMPLED", 1)
        monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.0)
    rows = [(1, "a\nb\na", "s"), (2, "A\nc", "s"), (3, "c\nb", "s"), (4, "a", "s")]
    got = {r.doc_id: r.kept for r in line_dedup.deduplicated(documents(spark, rows), 2, keep_first=True).collect()}
    assert got == {1: "a\nb", 2: "c", 3: "", 4: ""}


def test_lines_of_nothing_and_of_a_very_long_text(spark, nothing):
    assert line_dedup.deduplicated(nothing).count() == 0
    long = "\n".join(["Menu", "text"] * 300_000)
    rows = [(0, long, "a"), (-1, None, "a")] + [(i, "menu\nown " + str(i), "a") for i in range(1, 10)]
    got = {r.doc_id: r for r in line_dedup.deduplicated(documents(spark, rows)).collect()}
    assert (got[0].n_lines, got[0].n_dropped, got[0].kept) == (600_000, 300_000, "\n".join(["text"] * 300_000))
    assert (got[-1].n_lines, got[-1].n_dropped, got[-1].kept) == (1, 0, "") and got[3].kept == "own 3"


def test_lines_use_no_python_and_one_sort_after_the_ranges(awkward):
    plan = line_dedup.deduplicated(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    streamed = line_dedup._streamed(awkward, 10, [1])._jdf.queryExecution().executedPlan().toString()
    assert streamed.count("Exchange") == 1 and "rangepartitioning(_h" in streamed


# --- vector codes -----------------------------------------------------------------------


def brute_codes(rows, rounds=2):
    """[(vec_id, code, error, label_error)] and the codebooks' digest, in Python's integers."""
    from math import floor, isfinite
    from fractions import Fraction

    kept = [(i, lab, v) for i, lab, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = -(-max([len(v) for _, _, v in kept] + [1]) // 16) * 16
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = [[floor(Fraction(c) * 256) for c in v] + [0] * (width - len(v)) for _, _, v in kept]
    w = width // 16
    parts = [[row[p * w : p * w + w] for row in x] for p in range(16)]
    books = [[list(c) for c in part[:64]] for part in parts]

    def nearest(c, book):
        return min((sum((a - b) ** 2 for a, b in zip(c, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            mine = [nearest(c, books[p])[1] for c in parts[p]]
            for e in range(len(books[p])):
                group = [c for c, m in zip(parts[p], mine) if m == e]
                if group:
                    books[p][e] = [sum(col) // len(group) for col in zip(*group)]
    found = [[nearest(parts[p][r], books[p]) for p in range(16)] for r in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, lab, _), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    cap = lambda e: e if e < 1 << 63 else None
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), cap(err), cap(by_label[lab])) for (i, lab, _), f, err in zip(kept, found, errors)), digest


def coded(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, code string, _key int")
    out, books = vector_codes.encode(frame.repartition(3))
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in out.collect())
    return got, None if books is None else vector_codes.digest(books)


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(900 - i, [None, 0, 1][i % 3], (np.round(rng.normal(size=32) * 0.2, 3 if i % 2 else 1)).tolist()) for i in range(230)]
    rows += [(2000 + i, 7, rows[4][2]) for i in range(40)] + [(671, 1, [0.25] * 32), (671, 1, [-0.25] * 32), (None, 1, rows[9][2])]
    rows += [(1, 0, None), (2, 0, [float("nan")] * 32), (3, 0, [None] + [0.0] * 31), (4, 0, [float("inf")] + [0.0] * 31), (5, None, []), (6, 0, [1.0])]
    assert coded(spark, rows) == brute_codes(rows)


def test_codes_of_few_huge_or_no_vectors(spark):
    few = [(3, 1, [0.5, -0.001]), (1, None, [1e300, -3e5]), (2, 1, [5e-324, 2.0**40])]
    assert coded(spark, few) == brute_codes(few)
    assert coded(spark, [(1, 1, None)]) == ([], None)
    same = [(i, 1, [0.1] * 16) for i in range(100)]
    assert coded(spark, same) == brute_codes(same)


def test_trees_assign_like_a_plain_search():
    rng = np.random.default_rng(4)
    saved = 0
    for n, m, spread in ((1, 1, 3), (3, 9, 3), (900, 64, 2), (900, 64, 60), (2500, 64, 4000)):
        centres = rng.integers(-spread, spread, (m, 4))
        points = centres[rng.integers(0, m, n)] + rng.integers(-2, 3, (n, 4))
        tree = vector_codes.Tree(points, vector_codes.LEAF, cached=True)
        codes, count, sums, compared = vector_codes.assign(tree, centres)
        want = ((points[tree.order][:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        real = tree.real
        assert (codes[real] == want[real]).all() and (count == np.bincount(want[real], minlength=m)).all()
        plain = np.zeros_like(centres)
        np.add.at(plain, want[real], points[tree.order][real])
        assert (sums == plain).all()
        saved += n - compared
    assert saved > 1000
