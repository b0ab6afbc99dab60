"""Quality rules, BPE, toxicity and mixing."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from tokenizers import Tokenizer

from sortlane.llm import bpe, mixing, quality, toxicity
from sortlane.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    counts = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*counts, n < 10 or 100 * len(covered) > 20 * n)


def test_quality_counts(awkward, spark):
    marks = documents(spark, extra := [(1, "a | b #$%& <x>\nrow\nrow\n row", "s"), (2, " \n".join(["é ü"] * 9), "s")])
    for frame, rows in ((awkward, AWKWARD), (marks, extra)):
        scored = quality.score(frame, quality.QualityModel(None)).collect()
        got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in scored)
        assert got == sorted((str(d), *base(t)) for d, t, _ in rows)
        assert all(r.kept == (not r.base_failed) and r.probability is None for r in scored)


def junk(seed, n):
    return " ".join(w.upper() + "!!" if i % 3 else w + "$$$" for i, w in enumerate(prose(seed, n).split()))


def test_quality_is_learned(spark):
    rows = [(i, prose(i, 60) if i % 3 else junk(i, 60), "s") for i in range(240)]
    frame = documents(spark, rows)
    labels = [(i, int(bool(i % 3)), 0) for i in range(160)] + [(None, 1, 0), (5, 0, 0), (7, None, 1), (500, 1, 1)]
    model = quality.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), per_class=60)
    scored = quality.score(frame, model).collect()
    unseen = [(r.doc_id, r.kept) for r in scored if r.doc_id >= 160]
    assert sum(kept == bool(d % 3) for d, kept in unseen) >= 0.95 * len(unseen)
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(r.kept for r in scored)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(1, 1, 0), (1, 0, 0)], [(None, 0, 1)]])
def test_too_few_labels(spark, awkward, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert quality.fit(awkward, labels).weights is None
    model = toxicity.fit(awkward, labels)
    assert model.weights is None and toxicity.score(awkward, model).filter("score BETWEEN 0 AND 1").count() == len(AWKWARD)


@pytest.mark.parametrize("kept", [4, 100_000])
def test_bpe_is_exact(spark, folder, awkward, kept):
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    odd = [(1, "don't I'll 1234 ÀÉ <|startoftext|>x   \u0085 á ﻿", "s"), (2, "Ⅷ ﬁ ß İ Σας " * 40, "s"), (3, "\x1c\x1d y" * 90, "s")]
    odd += [(4, "日本語" * 300, "s"), (5, "x" * 5000, "s")]
    real = spark.read.parquet(f"{folder}/documents.parquet").limit(60).select("doc_id", "text")
    frames = [(awkward, [(d, t) for d, t, _ in AWKWARD]), (documents(spark, odd), [(d, t) for d, t, _ in odd])]
    frames.append((real, [(r.doc_id, r.text) for r in real.collect()]))
    for frame, rows in frames:
        want = []
        for d, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((str(d), ids, library.decode(ids, skip_special_tokens=False)))
        got = [(str(r.doc_id), r.ids, r.decoded) for r in bpe.encode(frame, tokenizer_path(), kept).collect()]
        assert sorted(got) == sorted(want)


def test_joins_that_differ_are_repaired():
    """An encoder that merges words over a blank: chunks on both sides are encoded together."""
    encoder = bpe.ChunkEncoder(tokenizer_path())
    plain = encoder._ids

    def merging(texts):
        return [(b"\1\0\0\0", "ab ") if t.split() == [b"a", b"b"] else own for t, own in zip(texts, plain(texts))]

    encoder._ids = merging
    (ids, text), (other, _) = encoder.encode([[b"a", b" b"], [b"a", b" c"]])
    assert (ids, text) == (b"\1\0\0\0", "ab") and len(other) == 8


def test_frequent_words_outlive_the_limit_of_kept_words():
    """Words that every text holds are encoded once, however many rare ones come by."""
    encoder, asked = bpe.ChunkEncoder(tokenizer_path(), 40), []
    plain = encoder._ids

    def counted(texts):
        asked.extend(texts)
        return plain(texts)

    encoder._ids = counted
    for i in range(120):
        encoder.encode([[b"often met w%d x%d y%d" % (i, i, i)]])
    assert asked.count(b"often") == asked.count(b"met") == 1
    assert len(encoder.words) + len(encoder.older) <= 4 * 40


def test_kept_words_hold_their_ids_alone():
    """Texts are decoded from the ids of whole chunks, so a worker keeps none for each word."""
    encoder = bpe.ChunkEncoder(tokenizer_path(), 400)
    for i in range(300):
        encoder.encode([[b"w%d" % i, b" x%d" % i]])
    assert all(type(ids) is bytes for ids in encoder.words.values())
    assert len(encoder.chunks) <= 400 // bpe.WORDS_A_CHUNK


def test_unused_memory_is_returned():
    from sortlane.llm import tables

    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) // 1024

    held = [bytearray(16_000) for _ in range(10_000)]
    pins = held[::1000]  # without them the end of the heap would shrink by itself
    del held
    before = anonymous()
    tables._return_memory()
    assert pins and before - anonymous() > 50


def test_chunks_join_to_the_text(awkward):
    from sortlane.llm import arrays as A

    texts = [t or "" for _, t, _ in AWKWARD]
    import pyarrow as pa

    cut = bpe.cut(*A.flat(pa.array(texts)))
    assert [b"".join(c) for c in cut] == [t.encode() for t in texts]
    assert max(map(len, cut)) > 20


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("pattern", [r"\p{L}+ \p{L}+|[^\s\p{L}]+", r" ?\p{L}+", r"\s+|\p{L}+", r"[^\p{L}]+", r"a.b", r"[a-z ]+", r"\p{Z}", r"x\x20y", ""])
def test_patterns_that_match_blanks_are_refused(pattern, tmp_path):
    import json

    with open(tokenizer_path(), encoding="utf-8") as f:
        settings = json.load(f)
    bpe.ChunkEncoder(tokenizer_path())
    settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = pattern
    (tmp_path / "other.json").write_text(json.dumps(settings), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.ChunkEncoder(str(tmp_path / "other.json"))


def test_toxicity_is_learned(spark):
    insults = ["blockhead", "numbskull", "nitwits", "dunderhead"]

    def text(i):
        words = prose(i, 80).split()
        if i % 4 == 0:
            words[i % 60], words[(7 * i) % 60 + 10] = insults[i % 3], insults[(i // 4) % 4]
        return " ".join(words)

    frame = documents(spark, [(i, text(i), "s") for i in range(600)])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(500)], "doc_id long, quality int, toxic int")
    scored = toxicity.score(frame, toxicity.fit(frame, labels)).collect()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    unseen = [r for r in scored if r.held_out or r.doc_id >= 500]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in unseen) >= 0.95 * len(unseen)


def test_dictionaries_hold_all_words_worth_taking():
    words = [w.encode() for w in prose(5, 80).split()]
    texts = [words[i % 80] + b" " + words[(i + 4) % 80] for i in range(480)]
    found = toxicity.cover(texts, [prose(1000 + i, 40).encode() for i in range(480)], 20.0)
    assert all(any(s in b" " + w + b" " for s in found) for w in words)


def test_phrases_of_common_words_are_learned(spark):
    """The words, some of one or two letters, are in every text; only their order tells."""
    common = [a + b for a in "bdfgl" for b in "aeiouy"] + ["a", "i"]

    def text(i):
        words = np.random.default_rng(i).permutation(common * 2).tolist()
        return " ".join(words[:30] + (["go", "la", "a", "du", "be"] if i % 4 == 0 else ["du", "a", "be", "go", "la"]) + words[30:])

    frame = documents(spark, [(i, text(i), "s") for i in range(600)])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(500)], "doc_id long, quality int, toxic int")
    scored = toxicity.score(frame, toxicity.fit(frame, labels)).collect()
    unseen = [r for r in scored if r.held_out or r.doc_id >= 500]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in unseen) >= 0.95 * len(unseen)


def test_held_out_rows_are_never_learned_from(spark):
    out = [i for i in range(400) if toxicity.held_out(i)]
    frame = documents(spark, [(i, prose(i, 30), "s") for i in range(400)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in out], "doc_id long, quality int, toxic int")
    assert toxicity.fit(frame, labels) == toxicity.ToxicityModel()


def test_targets():
    assert mixing.targets([]) == {}
    assert mixing.targets([("b", 10), ("a", 10)]) == pytest.approx({"a": 100 / 7, "b": 40 / 7})
    got = mixing.targets([("a", 1), ("b", 100), ("c", 50), (None, 49), ("d", 0)])
    assert got["a"] == 3 and got["d"] == 0 and sum(got.values()) == pytest.approx(200)
    assert all(got[s] <= 3 * n + 1e-9 for s, n in [("a", 1), ("b", 100), ("c", 50), (None, 49)])


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(3)
    size, chance = rng.integers(1, 5000, 3000).astype(float), rng.random(3000)
    p = mixing.flight(chance, size, 17)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert p.sum() == pytest.approx(chance.sum(), abs=1e-4) and p @ size == pytest.approx(chance @ size, rel=1e-6)
    landed = mixing.land(p, size, float(chance @ size))
    assert set(landed) <= {0.0, 1.0} and abs(landed @ size - chance @ size) <= size.min() * 2


def test_flight_is_unbiased():
    chance, size = np.full(9, 1 / 3), np.array([1.0, 2, 3, 4, 5, 6, 7, 8, 9])
    mean = np.mean([mixing.flight(chance, size, seed) for seed in range(3000)], axis=0)
    assert np.abs(mean - 1 / 3).max() < 0.04


def test_mix(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)  # several levels of blocks
    rows = [(i, prose(i, 5 + 37 * i % 90), ["x", "y", "z", None][0 if i % 5 else i % 4]) for i in range(900)]
    for frame, n in ((documents(spark, rows), 900), (awkward, len(AWKWARD))):
        got = mixing.mix(frame).collect()
        again = mixing.mix(frame.repartition(7)).collect()
        assert len(got) == n and sorted(map(str, got)) == sorted(map(str, again))
        for source in {r.source for r in got}:
            own = [r for r in got if r.source == source]
            assert {r.source_size for r in own} == {sum(r.size for r in own)}
            assert all(0 <= r.copies <= 3 for r in own)
            if n == 900:
                assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 20
        drawn = mixing.mixed_documents(frame)
        assert drawn.columns == frame.columns
        assert drawn.count() == sum(r.copies for r in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
