"""Quoted CSV with line breaks inside fields, read by many tasks.

Whether a line break ends a record depends on every quote before it, so a reader of quoted text
usually takes a file in one task. Here the file is scanned as plain lines, which split anywhere.
Runs of lines are stored as pieces together with what they do to the state "inside quotes" under
both assumptions about their start. Composing these steps over the pieces of a file tells each
piece its true state, the number of its first record and where a record that it opens goes on.
Pieces are then parsed on their own; only records that cross a border are put together in a
shuffle. All bytes are read by Spark itself, so any store that Spark reads will do.

Fields are separated by commas; a quote opens a quoted field only at its start and is doubled
inside it; text after the closing quote belongs to the field; a carriage return before the line
feed that ends a record is dropped. Blank records are left out, missing fields are '', a last
record without its closing quote ends with the file. All files have a header, with the columns
asked for in the same places.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortlane.plans.workspace import new_folder

PIECE_BYTES = 4 << 20
ROW_GROUP_BYTES = 32 << 20
# A longer record is taken for a quote that nobody closed.
MOST_RECORD_BYTES = 256 << 20
# Up to so many pieces, about 30 MB, what is known of them is sent to every executor.
BROADCAST_PIECES = 200_000

_QUOTED = rb'[^"]*+(?:""[^"]*+)*+'
_FIELD = rb'(?:"' + _QUOTED + rb'"[^,\n]*+|(?!")[^,\n]*+)'
_REST = rb"(?:," + _FIELD + rb")*+\n"
RECORD = re.compile(_FIELD + _REST)
# What is left of a record whose quoted field is open.
OPEN_REST = re.compile(_QUOTED + rb'"[^,\n]*+' + _REST)
VALUES = re.compile(rb'(?:"(' + _QUOTED + rb')"([^,\n]*+)|(?!")([^,\n]*+))(,|\n)')
BLANK = (b"\n", b"\r\n")
MARK = b"\xef\xbb\xbf"

PIECES_SCHEMA = (
    "file string, block long, piece long, data binary, "
    "end0 int, n0 long, from0 long, to0 long, end1 int, n1 long, from1 long, to1 long, opens1 int"
)


def scan(data: bytes, inside: bool) -> tuple[int, int, int, int]:
    """(records begun, start of the first, end of the last whole one, 1 if one is left open).

    Without any start of a record both places are the length.
    """
    at = 0
    if inside:
        rest = OPEN_REST.match(data)
        if rest is None:
            return 0, len(data), len(data), 1
        at = rest.end()
    first, n = at, 0
    while at < len(data):
        found = RECORD.match(data, at)
        if found is None:
            return n + 1, first, at, 1
        n += found.group() not in BLANK
        at = found.end()
    return n, first, at, 0


def parse(data: bytes) -> Iterator[list[bytes]]:
    """The records of bytes that hold whole ones only, blank ones left out."""
    record: list[bytes] = []
    for found in VALUES.finditer(data):
        quoted, after, plain, end = found.groups()
        tail = plain if quoted is None else after
        if end == b"\n" and tail.endswith(b"\r"):
            tail = tail[:-1]
        record.append(tail if quoted is None else quoted.replace(b'""', b'"') + tail)
        if end == b"\n":
            if len(record) > 1 or record[0] or quoted is not None:
                yield record
            record = []


def _piece_row(file: str, block: int, piece: int, data: bytes) -> tuple:
    n0, from0, to0, end0 = scan(data, False)
    n1, from1, to1, end1 = scan(data, True)
    return file, block, piece, data, end0, n0, from0, to0, end1, n1, from1, to1, int(end1 and from1 < len(data))


def _to_pieces(schema: pa.Schema, size: int):
    def table(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines arrive in their order, file by file and block by block."""
        at, piece, held, held_bytes = None, 0, [], 0
        for batch in batches:
            places = zip(batch.column("file").to_pylist(), batch.column("block").to_pylist())
            for place, line in zip(places, batch.column("line")):
                if place != at or held_bytes >= size:
                    if held:
                        yield table(_piece_row(*at, piece, b"\n".join([*held, b""])))
                    piece = piece + 1 if place == at else 0
                    at, held, held_bytes = place, [], 0
                text = line.as_py()
                held.append(text)
                held_bytes += len(text) + 1
        if held:
            yield table(_piece_row(*at, piece, b"\n".join([*held, b""])))

    return run


def _pieces(spark: SparkSession, path: str, size: int) -> DataFrame:
    # A line break is the line feed alone, whatever stands before it.
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    fields = [
        pa.field(name, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind])
        for name, kind in (part.split() for part in PIECES_SCHEMA.split(", "))
    ]
    folder = new_folder(spark, "csv-pieces")
    cut = lines.mapInArrow(_to_pieces(pa.schema(fields), size), PIECES_SCHEMA)
    cut.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    return spark.read.parquet(folder)


def _states(pieces: DataFrame) -> DataFrame:
    """What each piece needs to know of those before it; reads no text.

    A piece sets the state, keeps it or turns it around, so the state is that of the last piece
    that sets it, turned by those since. A row stands for a piece of some megabytes.
    """
    order = Window.partitionBy("file").orderBy("block", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    turns = F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0)
    known = pieces.select("file", "block", "piece", "end0", "n0", "from0", "to0", "end1", "n1", "from1", "to1", "opens1")
    turned = known.withColumn("_turns", F.sum(turns).over(so_far))
    sets = F.when(F.col("end0") == F.col("end1"), (F.col("end0") + F.col("_turns")) % 2)
    stated = turned.withColumn("_set", sets).withColumn(
        "inside",
        (
            F.coalesce(F.last("_set", ignorenulls=True).over(before), F.lit(0))
            + F.coalesce(F.lag("_turns").over(order), F.lit(0))
        )
        % 2
        == 1,
    )
    chosen = stated.select(
        "file",
        "block",
        "piece",
        "inside",
        *[F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0")).alias(c) for c in ("n", "from", "to")],
        F.when(F.col("inside"), F.col("opens1")).otherwise(F.col("end0")).alias("opens"),
    )
    placed = chosen.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # The record that is open when a piece begins: the last one of the last piece that opened any.
    last = F.when(F.col("opens") == 1, F.col("start") + F.col("n") - 1)
    return placed.withColumn("open_record", F.last(last, ignorenulls=True).over(before))


def _file_starts(states: DataFrame) -> DataFrame:
    """The rows before each file, its header not counted; one row a file, as in a file listing."""
    rows = states.groupBy("file").agg(F.greatest(F.sum("n") - 1, F.lit(0)).alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("file_start"))


def _positions(spark: SparkSession, path: str, columns: list[str]) -> dict[str, int]:
    """Where the columns stand in the header of the first file."""
    header = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=True).columns
    names = [name.removeprefix(MARK.decode()) for name in header]
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    return {c: names.index(c) for c in columns}


def _to_rows(positions: dict[str, int], schema: pa.Schema):
    """Rows of (start, file_start, data); data holds whole records, the first one numbered start."""

    def value(record: list[bytes], place: int) -> str:
        return record[place].decode("utf-8", "replace") if place < len(record) else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, file_start, data in zip(*[batch.column(c) for c in ("start", "file_start", "data")]):
                number, offset, text = start.as_py(), file_start.as_py(), data.as_py()
                if RECORD.match(text) is None:
                    # The record was open when its file ended.
                    text += b'"\n'
                out: list[list] = [[] for _ in schema]
                for record in parse(text):
                    if number == 0:
                        if record[0].startswith(MARK):
                            record[0] = record[0].removeprefix(MARK).strip(b'"')
                        odd = [c for c, p in positions.items() if value(record, p) != c]
                        if odd:
                            raise ValueError(f"the header of a file lacks {', '.join(odd)} in its place")
                    else:
                        out[0].append(offset + number - 1)
                        for held, place in zip(out[1:], positions.values()):
                            held.append(value(record, place))
                    number += 1
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return run


def read_quoted_csv(
    spark: SparkSession, path: str, columns: list[str], piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """(row_id, columns): every value a string, a missing one ''.

    ``row_id`` counts 0, 1, ... through the records in the order of file paths and places. It
    does not depend on how the files are split. An empty file gives no row. A record longer
    than ``MOST_RECORD_BYTES`` is an error, and so is a header without the columns.
    """
    positions = _positions(spark, path, columns)
    pieces = _pieces(spark, path, piece_bytes)
    states = _states(pieces)
    known = states.join(_file_starts(states), "file")
    if pieces.count() <= BROADCAST_PIECES:
        known = F.broadcast(known)
    stated = pieces.select("file", "block", "piece", "data").join(known, ["file", "block", "piece"])

    def part(start, stop):
        return F.substring(F.col("data"), (start + 1).cast("int"), (stop - start).cast("int"))

    whole = stated.filter(F.col("to") > F.col("from")).select(
        "start", "file_start", part(F.col("from"), F.col("to")).alias("data")
    )
    end = F.length("data")
    fragments = F.array(
        F.when(
            F.col("inside") & F.col("open_record").isNotNull(),
            F.struct(F.col("open_record").alias("start"), part(F.lit(0), F.col("from")).alias("data")),
        ),
        F.when(
            F.col("opens") == 1,
            F.struct((F.col("start") + F.col("n") - 1).alias("start"), part(F.col("to"), end).alias("data")),
        ),
    )
    cut = stated.select("file", "file_start", "block", "piece", F.explode(fragments).alias("_part")).filter(
        F.col("_part").isNotNull()
    )
    crossing = cut.groupBy("file", "file_start", F.col("_part.start").alias("start")).agg(
        F.sum(F.length("_part.data")).alias("_bytes"),
        F.array_sort(F.collect_list(F.struct("block", "piece", F.col("_part.data").alias("data")))).alias("_parts"),
    )
    joined = F.aggregate("_parts", F.lit(b""), lambda all_, p: F.concat(all_, p["data"]))
    checked = F.when(F.col("_bytes") <= MOST_RECORD_BYTES, joined).otherwise(
        F.raise_error(F.lit("a quote is never closed")).cast("binary")
    )
    border = crossing.select("start", "file_start", checked.alias("data"))

    schema = pa.schema([("row_id", pa.int64()), *[(c, pa.string()) for c in columns]])
    shape = ", ".join(["row_id long", *[f"`{c}` string" for c in columns]])
    parse_rows = _to_rows(positions, schema)
    return whole.mapInArrow(parse_rows, shape).unionByName(border.mapInArrow(parse_rows, shape))
