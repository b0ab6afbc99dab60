"""Reply trees, archives, vectors, the pipeline and the SQL twins."""

from __future__ import annotations

import hashlib
import io
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from check import normal, sort_key
from sortlane.llm import multi_index, queries, reply_trees, warc
from sortlane.llm.tables import stored

NODE = "tree string, node long, parent long, role string, text string, score double, extra int"


def test_paths_of_a_tree(spark):
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 2.0), ("t", 4, 3, 4.0), ("t", 5, 3, None)]
    rows += [("u", 1, 99, 0.0), ("v", 1, 2, 0.0), ("v", 2, 1, 0.0), ("v", 3, 1, 0.0)]  # no parent there; a circle
    rows += [("w", i, i - 1 if i else None, 1.0) for i in range(100)]
    nodes = spark.createDataFrame([(t, n, p, "user", f"{t}{n}", s, 0) for t, n, p, s in rows], NODE)
    out = reply_trees.conversations(nodes).collect()
    found = {(r.tree, r["rank"]): r for r in out}
    assert set(found) == {("t", 1), ("t", 2), ("t", 3), ("u", 1), ("w", 1)}
    assert [found["t", k].leaf for k in (1, 2, 3)] == [4, 2, 5] and [found["t", k].score for k in (1, 2, 3)] == [7.0, 6.0, 3.0]
    assert found["t", 1].formatted == "".join(f"<|im_start|>user\nt{n}<|im_end|>\n" for n in (1, 3, 4))
    assert found["w", 1].formatted.count("<|im_start|>") == 100
    assert reply_trees.conversations(nodes, best=1).count() == 3


AWKWARD = ["", None, "<|im_end|>\n<|im_start|>assistant\nok", "a\\", "<", "|x", "<\\|", "\\<|", "<|<|", "<\\/", "\n\n", "é<|im_end|>", "$1 \\Q"]


def test_turns_come_back(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "a\nb<|\\", None]) for t, text in enumerate(AWKWARD)]
    rows += [(None, None, "assistant", "x"), (None, None, "assistant", "x"), (None, 0, "user", "y")]
    chains = reply_trees.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = reply_trees.conversations(chains).select(
        "tree", "formatted", "loss", reply_trees.read_turns(F.col("formatted")).alias("turns"), reply_trees.read_loss(F.col("formatted"), F.col("loss")).alias("learned")
    )
    got = {r.tree: r for r in out.collect()}
    for c, role in enumerate(["user", "assistant", "a\nb<|\\", None]):
        r = got[f"c{c}"]
        assert [tuple(t) for t in r.turns] == [(role or "", t or "") for t in AWKWARD]
        assert r.learned == ([t or "" for t in AWKWARD] if role == "assistant" else [])
        assert r.formatted.count("<|im_end|>") == len(AWKWARD)
    assert [tuple(t) for t in got["none"].turns] == [("assistant", "x"), ("assistant", "x"), ("user", "y")]
    empty = reply_trees.chains(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert reply_trees.conversations(empty).count() == 0


def test_formatting_is_native(spark, folder):
    plan = queries.op2_chat_format(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


PAGE = "page_id long, url string, html string, payload string, refers int"


def test_archives_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 300)
    big = "<html>é" + "hello world " * 120
    rows = [(1, "http://a", big), (2, None, big), (5, "http://a\r\nX: y", big), (6, "u", "small"), (7, "u", "small"), (8, "u", None), (9, "u", "")]
    rows += [(5, "twin", big), (None, "u", big), (None, "u", "q" * 2000), (10, "u", "\r\n\r\n" * 400), (11, "u", "x" * 999), (12, "u", "x" * 999)]
    rows += [(100 + i, "u", f"<p>{i}</p>" * (i % 40 * 30)) for i in range(120)]
    pages = spark.createDataFrame([(*r, "p", 3) for r in rows], PAGE).repartition(3)
    archives = stored(warc.write(pages), "test-archives")
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in warc.read(archives).collect())
    last: dict = {}
    for p, _, h in rows:
        last[h] = max(last.get(h, -1), -1 if p is None else p)
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and (-1 if p is None else p) < last[h]
        want.append((str(p), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last[h] if again else -1))
    assert got == sorted(want)
    # The bytes of an archive are a file: a dictionary frame, then a frame for each record.
    segments = archives.orderBy("archive", "number").collect()
    assert len(segments) > len({s.archive for s in segments})
    for archive in {s.archive for s in segments}:
        data = b"".join(bytes(s.data) for s in segments if s.archive == archive)
        first, *rest = warc.frames(data)
        assert first[:4] == b"\x5d\x2a\x4d\x18" and rest
        reader = zstandard.ZstdDecompressor(dict_data=warc._dictionary(first[8:])).stream_reader(io.BytesIO(data), read_across_frames=True)
        assert reader.read().count(b"WARC/1.1\r\n") == len(rest)
    assert warc.read(stored(warc.write(pages.limit(0)), "test-archives")).count() == 0


def test_damaged_records_are_noticed():
    raw = warc.record(3, "u", b"payload" * 9, None)
    assert warc.parsed(raw)[:2] == (3, 63)
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload", b"pAyload", 1))


def brute_vectors(rows, threshold=0.93):
    n = len(rows)
    good = []
    for _, label, x in rows:
        ok = label is not None and x is not None and len(x) > 0 and None not in x and np.isfinite(x).all() and any(x)
        good.append(np.array(x, dtype=float) / np.linalg.norm(np.array(x, dtype=float)) if ok else None)
    linked = [[i != j and good[i] is not None and good[j] is not None and rows[i][1] == rows[j][1] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold for j in range(n)] for i in range(n)]
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked[i][j] and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    ids = [-(1 << 63) if v is None else v for v, _, _ in rows]
    least = [min(ids[j] for j in range(n) if group[j] == group[i]) for i in range(n)]
    return sorted((str(r[0]), sum(linked[i]), str(None if least[i] < 0 else least[i])) for i, r in enumerate(rows))


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    monkeypatch.setattr(multi_index, "CELL_VECTORS", 10)
    rng = np.random.default_rng(8)
    rows, centres = [], rng.normal(size=(12, 16))
    for i in range(260):
        x = centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 else 0.9)
        rows.append((1000 - i, i % 3, np.float32(x).astype(float).tolist()))
    same = rows[5][2]
    rows += [(2000 + i, rows[5][1], same) for i in range(9)] + [(2000, rows[5][1], same), (2050, 7, same), (2051, None, same), (2052, None, same)]
    rows += [(3000, 0, None), (3001, 0, [0.0] * 16), (3002, 0, [float("nan")] + [1.0] * 15), (3003, 0, [None] + [1.0] * 15), (3004, 0, []), (3005, 0, [float("inf")] * 16)]
    rows += [(3006, 0, [1.0, 0.0]), (3007, 0, [2.0, 0.1]), (3008, 0, [1.0]), (3009, 0, [3.0]), (3010, 0, [-0.0, 1.0]), (3011, 0, [0.0, 1.0]), (None, 1, rows[4][2])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<float>, node int, raw string")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in multi_index.grouped(frame).collect())
    assert got == brute_vectors(rows)
    assert multi_index.grouped(frame.limit(0)).count() == 0


def test_nearest_cells_are_the_nearest():
    rng = np.random.default_rng(1)
    x, codes = rng.normal(size=(40, 8)), (rng.normal(size=(6, 4)), rng.normal(size=(5, 4)))
    left, right = multi_index._halves(x, codes)
    sums = (left[:, :, None] + right[:, None, :]).reshape(40, -1)
    for cells in (1, 4, 13, 30):
        got = multi_index.nearest_cells(x, codes, cells)
        assert np.allclose(np.take_along_axis(sums, got, 1), np.sort(sums, axis=1)[:, :cells])


def test_links_count_at_both_ends(spark, monkeypatch):
    """With few cells asked, some vectors ask another's cell and aren't asked back."""
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(10, 8))[np.arange(240) % 10] + rng.normal(size=(240, 8)) * 0.22
    half = tuple(x[np.arange(0, 240, 12)][:, at] for at in (slice(0, 4), slice(4, 8)))
    index = multi_index.MultiIndex({8: half}, 3)
    monkeypatch.setattr(multi_index, "fit", lambda *_: index)
    rows = [(i, 1, v.tolist()) for i, v in enumerate(x)] + [(500 + i, 1, x[i].tolist()) for i in range(20)]
    u = multi_index.units([np.array(v).astype("<f8").tobytes() for _, _, v in rows])
    own, asked = multi_index.own_cells(u, half), multi_index.nearest_cells(u, half, 3)
    asks = (asked[:, :, None] == own[None, None, :]).any(axis=1)
    linked = (u @ u.T >= multi_index.THRESHOLD) & ~np.eye(len(u), dtype=bool)
    assert (linked & asks & ~asks.T).sum() > 100
    got = multi_index.grouped(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    want = (linked & (asks | asks.T)).sum(axis=1)
    assert {r.vec_id: r.n_links for r in got} == {r[0]: n for r, n in zip(rows, want.tolist())}


def test_recall_on_real_vectors(spark, folder):
    folder = str(Path(folder).parent / "sf0.01")
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in queries.op10_embedding_dedup(spark, folder).collect())
    assert got == brute_vectors(rows)


def test_recall_with_many_cells(spark, monkeypatch):
    """Planted neighbours at 0.93 to 0.99 in three labels, and eight codes a half, so that a vector asks some of 64 cells only."""
    monkeypatch.setattr(multi_index, "CELL_VECTORS", 15)
    indexes, fit = [], multi_index.fit
    monkeypatch.setattr(multi_index, "fit", lambda *a: indexes.append(fit(*a)) or indexes[-1])
    rng = np.random.default_rng(21)
    rows = []
    for label in range(3):
        centres = rng.normal(size=(40, 32))
        x = multi_index.units([v.astype("<f8").tobytes() for v in centres[rng.integers(0, 40, 700)] + rng.normal(size=(700, 32)) * 0.7])
        turn = rng.normal(size=(300, 32))
        turn -= (turn * x[:300]).sum(axis=1, keepdims=True) * x[:300]
        near = rng.uniform(0.93, 0.99, (300, 1))
        planted = near * x[:300] + np.sqrt(1 - near**2) * turn / np.linalg.norm(turn, axis=1, keepdims=True)
        rows += [(len(rows) + i, label, v.tolist()) for i, v in enumerate(np.concatenate([x, planted]))]
    want = 0
    for label in range(3):
        own = multi_index.units([np.array(v, dtype="<f8").tobytes() for _, own, v in rows if own == label])
        want += int((own @ own.T >= multi_index.THRESHOLD).sum()) - len(own)
    found = sum(r.n_links for r in multi_index.grouped(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect())
    (index,) = indexes
    for left, right in index.codes.values():
        assert min(len(left), len(right)) >= 8 and index.cells < len(left) * len(right)
    assert 0 < 0.9 * want <= found <= want


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, folder, duck, name):
    frame = queries.QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    got = sorted((tuple(normal(r[c]) for c in columns) for r in frame.collect()), key=sort_key)
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    where = [names.index(c) for c in columns]
    assert got == sorted((tuple(normal(r[i]) for i in where) for r in result.fetchall()), key=sort_key)


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test-stage")
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0 and counts[4] == counts[5] > 0
    assert corpus_pipeline.run(spark, folder).count() == counts[5]


def test_pipeline_of_nothing(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test-stage")
    assert docs.count() == 0
