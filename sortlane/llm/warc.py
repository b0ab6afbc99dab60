"""WARC archives with a Zstandard dictionary, written and read back.

An archive is a skippable frame that holds a dictionary, followed by one Zstandard frame for each
record, compressed with that dictionary. The dictionary is trained on the archive's own first
records (at most ``SAMPLE_BYTES`` of them). A record whose payload stands in another record too
is a revisit: it names the record that has the payload and carries none.

Archives are tables of their bytes in order (archive, number, data): writing the ``data`` of one
archive one after the other gives a file that any reader of such archives takes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm.tables import NULL_ID, map_arrow, stored

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

LEAST_SHARED = 1000
SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 64_000
SEGMENT_BYTES = 4_000_000
LEVEL = 6

ARCHIVE = "archive int, number int, data binary"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def decided(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """The pages with ``payload`` and, for revisits, ``refers_to``: the largest page_id with that payload.

    Equal payloads are known by SHA-256 and length. Payloads are not shuffled for this: only
    digests are, reduced before the shuffle; a payload of a third of all pages is one row.
    """
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("page"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    groups = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.max("page").alias("first"), F.count("*").alias("n"))
    shared = stored(groups.filter("n > 1").select("digest", "first"), "warc-shared")
    own = rows.filter("digest IS NOT NULL").select("page", "digest").join(shared, "digest").filter("page < first")
    revisits = stored(own.select("page", "digest", "first").distinct(), "warc-revisits")
    # On the digest too: rows may share a page_id.
    key = F.coalesce("digest", F.lit(b""))
    joined = rows.withColumn("key", key).join(revisits.withColumnRenamed("digest", "key"), ["page", "key"], "left")
    return joined.select("page", "url", "payload", F.col("first").alias("refers"))


def _line(value: str) -> bytes:
    return " ".join(value.split()).encode("utf-8", "replace")


def record(page: int, url: str | None, payload: bytes, refers: int | None) -> bytes:
    """A response or revisit record; the digest and the length are those of the full payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest())
    head = HTTP_HEAD + b"Content-Length: %d\r\n\r\n" % len(payload)
    fields = [
        (b"WARC-Type", b"response" if refers is None else b"revisit"),
        (b"WARC-Record-ID", b"<urn:page:%d>" % page),
        (b"WARC-Target-URI", _line(url or "")),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
        (b"WARC-Payload-Digest", b"sha1:" + digest),
        (b"X-Payload-Length", b"%d" % len(payload)),
        (b"Content-Type", b"application/http; msgtype=response"),
    ]
    if refers is None:
        block = head + payload
    else:
        block = head
        fields += [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To", b"<urn:page:%d>" % refers)]
    fields.append((b"Content-Length", b"%d" % len(block)))
    return VERSION + b"\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[int, int, str, str, int | None]:
    """page, payload length, hex digest, type and the page referred to; checks the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(b": ", 1) for line in lines[1:])
    block = rest[: int(fields[b"Content-Length"])]
    digest = base64.b32decode(fields[b"WARC-Payload-Digest"][5:]).hex()
    page = int(fields[b"WARC-Record-ID"][len(b"<urn:page:") : -1])
    length = int(fields[b"X-Payload-Length"])
    if fields[b"WARC-Type"] == b"revisit":
        return page, length, digest, "revisit", int(fields[b"WARC-Refers-To"][len(b"<urn:page:") : -1])
    payload = block.partition(b"\r\n\r\n")[2]
    if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {page} is damaged")
    return page, length, digest, "response", None


def dictionary(samples: list[bytes]) -> bytes:
    """Trained on the records; of too few to train on, their own bytes serve as a raw dictionary."""
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    trained = raw[:4] == b"\x37\xa4\x30\xec"  # a trained one begins with this
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


def write(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """The archives (archive, number, data) of all pages, one archive for each partition.

    A null html is an empty payload, a null url an empty one. A null page_id is a page of its
    own kind that comes before all others. Every row gives a record, equal rows too: of rows that
    share payload and the largest page_id all are responses. No pages give no archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        archive = context.partitionId() if context else 0
        waiting, held, number, compressor, out, size = [], 0, 0, None, [], 0

        def segment(data: list[bytes]) -> pa.RecordBatch:
            columns = [pa.array([archive], pa.int32()), pa.array([number], pa.int32()), pa.array([b"".join(data)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "number", "data"])

        def start() -> list[bytes]:
            nonlocal compressor
            raw = dictionary(waiting)
            compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_checksum=True)
            return [struct.pack("<II", SKIPPABLE, len(raw)) + raw, *map(compressor.compress, waiting)]

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4))):
                raw = record(*(x.as_py() for x in row))
                if compressor is None:
                    waiting.append(raw)
                    held += len(raw)
                    if held < SAMPLE_BYTES:
                        continue
                    out, waiting = start(), []
                else:
                    out.append(compressor.compress(raw))
                size = size + len(out[-1]) if len(out) > 1 else sum(map(len, out))
                if size >= SEGMENT_BYTES:
                    yield segment(out)
                    out, size, number = [], 0, number + 1
        if compressor is None and waiting:
            out = start()
        if out:
            yield segment(out)

    return map_arrow(decided(pages, least), run, ARCHIVE)


def frames(data: bytes) -> Iterator[bytes]:
    """The frames of a run of whole frames, from the skippable one on."""
    view, at = memoryview(data), 0
    while at < len(view):
        if struct.unpack_from("<I", view, at)[0] == SKIPPABLE:
            end = at + 8 + struct.unpack_from("<I", view, at + 4)[0]
        else:
            end = at + _frame_length(view[at:])
        yield bytes(view[at:end])
        at = end


def _frame_length(view: memoryview) -> int:
    """The length of a Zstandard frame, from its header and the headers of its blocks."""
    flags = view[4]
    single, content = flags >> 5 & 1, flags >> 6
    at = 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[content]
    while True:
        head = int.from_bytes(view[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * (flags >> 2 & 1)


def read(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Each record is decompressed with the dictionary of its archive's first frame and parsed;
    the payload of a response is checked against its digest.
    """
    ordered = archives.repartition("archive").sortWithinPartitions("archive", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, decompressor = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                found = []
                archive = batch.column(0)[i].as_py()
                if archive != current:
                    current, decompressor = archive, None
                for frame in frames(batch.column(2)[i].as_py()):
                    if frame[:4] == struct.pack("<I", SKIPPABLE):
                        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(frame[8:]))
                    else:
                        found.append(parsed(decompressor.decompress(frame)))
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    records = map_arrow(ordered, run, RECORD)
    null = F.lit(NULL_ID)
    return records.withColumns({"page_id": F.nullif("page_id", null), "refers_to": F.nullif("refers_to", null)})
