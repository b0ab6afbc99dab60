"""Quoted CSV in many pieces gives the rows of one pass over the file."""

from __future__ import annotations

import csv
import io
import random

import pytest

from sortlane.sources import quoted_csv
from sortlane.sources.quoted_csv import parse, read_quoted_csv, scan

COLUMNS = ["title", "text"]


def awkward(seed: int, rows: int) -> str:
    """Records with quotes, commas and line breaks wherever they may stand."""
    pick = random.Random(seed)
    parts = ["a", "é", ",", '"', "\n", "\n\n", '","', '"\n"', " ", "\r\n", ""]
    out = ["other,title,text\n"]
    for i in range(rows):
        fields = []
        for _ in range(3):
            text = "".join(pick.choice(parts) for _ in range(pick.randrange(9)))
            plain = not any(c in text for c in ',"\n\r') and pick.random() < 0.5
            fields.append(text if plain else '"' + text.replace('"', '""') + '"')
        out.append(",".join(fields) + pick.choice(["\n", "\r\n", "\n\n"]))
    # Quotes that open nothing, missing and additional fields.
    out.append('1,5" disk,b"c"d\n2\n3,x,y,z\n4,"in"out,"a"\n')
    return "".join(out)


def expected(text: str, columns: list[str]) -> list[tuple]:
    # Fed line by line at line feeds, so that a lone carriage return is text.
    lines = [line + "\n" for line in text.split("\n")]
    if lines[-1] == "\n":
        lines.pop()
    records = [r for r in csv.reader(lines) if r]
    header, body = records[0], records[1:]
    places = [header.index(c) for c in columns]
    return [tuple(r[p] if p < len(r) else "" for p in places) for r in body]


@pytest.fixture
def read(spark, monkeypatch):
    """Read with the plain lines split after so many bytes, and so many bytes in a piece."""
    key = "spark.sql.files.maxPartitionBytes"
    usual, cut = spark.conf.get(key), quoted_csv._pieces

    def run(path, piece_bytes, split_bytes):
        def split_finely(*args):
            spark.conf.set(key, split_bytes)
            try:
                return cut(*args)
            finally:
                spark.conf.set(key, usual)

        monkeypatch.setattr(quoted_csv, "_pieces", split_finely)
        rows = quoted_csv.read_quoted_csv(spark, path, COLUMNS, piece_bytes).collect()
        rows.sort(key=lambda r: r["row_id"])
        assert [r["row_id"] for r in rows] == list(range(len(rows)))
        return [tuple(r)[1:] for r in rows]

    return run


@pytest.mark.parametrize("split_bytes, piece_bytes", [(23, 5), (64, 1 << 20), (1 << 20, 40), (1 << 20, 1 << 20)])
def test_any_split_gives_the_same_rows(read, tmp_path, split_bytes, piece_bytes):
    text = awkward(3, 40)
    (tmp_path / "one.csv").write_bytes(text.encode())
    assert read(str(tmp_path), piece_bytes, split_bytes) == expected(text, COLUMNS)


@pytest.mark.parametrize("seed", range(40))
def test_every_cut_is_found(seed):
    """Cuts at each line break: states, counts and fragments fit together."""
    text = awkward(seed, 12)
    whole = list(parse(text.encode()))
    lines = [p for p in text.encode().replace(b"\n", b"\n\x00").split(b"\x00") if p]
    inside, records, open_part = False, [], b""
    for piece in lines:
        n, first, last, left = scan(piece, inside)
        if inside:
            open_part += piece[:first]
        if inside and not (left and first == len(piece)):
            records += list(parse(open_part))
        if first < last:
            records += list(parse(piece[first:last]))
        if left and first < len(piece):
            open_part = piece[last:]
        inside = bool(left)
    assert records == whole
    assert [tuple(v.decode() for v in r) for r in whole] == [
        tuple(r) for r in csv.reader([line + "\n" for line in text.split("\n")]) if r
    ]


def test_several_files_and_their_order(read, tmp_path):
    texts = [awkward(s, 30) for s in range(3)]
    for i, text in enumerate(texts):
        (tmp_path / f"part-{i}.csv").write_bytes((b"\xef\xbb\xbf" if i == 1 else b"") + text.encode())
    (tmp_path / "part-9.csv").write_bytes(b"")
    want = [row for text in texts for row in expected(text, COLUMNS)]
    assert read(str(tmp_path), 200, 300) == want


def test_header_only_open_end_and_long_record(read, tmp_path):
    def one(name, data):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_bytes(data)
        return str(tmp_path / name)

    assert read(one("header", b"title,text"), 8, 64) == []
    assert read(one("open", b'title,text\na,"b\nc'), 4, 64) == [("a", "b\nc\n")]
    assert read(one("bad", b"title,text\nx\xff,y"), 4, 64) == [("x�", "y")]
    long = "line, \"quoted\"\n" * 20_000
    data = io.StringIO()
    csv.writer(data, lineterminator="\n").writerows([COLUMNS, ["t", long], ["u", "v"]])
    assert read(one("long", data.getvalue().encode()), 10_000, 50_000) == [("t", long), ("u", "v")]


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,text\n1,2\n")
    (tmp_path / "b.csv").write_text("text,title\n3,4\n")
    with pytest.raises(Exception, match="header of a file"):
        read_quoted_csv(spark, str(tmp_path), COLUMNS).collect()
    with pytest.raises(ValueError, match="no column body"):
        read_quoted_csv(spark, str(tmp_path / "a.csv"), ["body"])


def test_texts_are_not_dealt_out(spark, tmp_path):
    """Only records that cross a border are shuffled."""
    (tmp_path / "a.csv").write_text(awkward(1, 50))
    plan = read_quoted_csv(spark, str(tmp_path), COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
