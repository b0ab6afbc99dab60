"""Lines that stand in many documents, dropped everywhere, as compressed keep bitmaps.

Every line becomes two 64-bit hashes of its key. The hashes are dealt into ranges and each range
is sorted by hash, document and position, so one pass over it meets the first occurrence of a
line in a document, and in the table, before the others and counts documents by those first
occurrences. Texts stay where they are: only the positions of dropped lines come back, and a
document's bitmap is kept as the ends of its runs of kept and dropped lines, in turn.

A key that holds a large share of all lines is cut into ranges of documents. Which keys are cut
is read from a sample and decides only where a line is counted; the counts of the cut keys, at
most ``1 / HOT_SHARE`` of them, are added up over their ranges. All of it is DataFrame functions.

Defined cases: a null text is one empty line. Rows with the same doc_id and text are one document
that stands more than once; rows that share a doc_id but not the text, or have none, are
different documents. An empty key is never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.functions.text import let
from sortlane.llm.tables import doc_key, stored

# What a key loses at both ends, and the letters that are lowered.
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LEAST_DOCUMENTS = 10
HOT_SHARE = 0.002
HOT_SAMPLE = 0.02
LEAST_SAMPLED = 50
SLOTS = 256


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lowered; all other letters stay."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, CAPITALS, CAPITALS.lower()))


def _identified(documents: DataFrame) -> DataFrame:
    """(doc, part, doc_id, text), the first two naming a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        doc_key().alias("_doc"), F.xxhash64(text).alias("_part"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashed_lines(texts: DataFrame) -> DataFrame:
    """(h, g, doc, part, pos) of every line whose key isn't empty."""
    keys = F.transform(lines_of(F.col("text")), line_key)
    rows = texts.select("_doc", "_part", F.posexplode(keys).alias("_pos", "_key")).filter(F.col("_key") != "")
    return rows.select(F.xxhash64("_key").alias("_h"), F.xxhash64(F.lit(1), "_key").alias("_g"), "_doc", "_part", "_pos")


def _hot(documents: DataFrame) -> list[int]:
    """First hashes of keys with a large share of the sampled lines, at most ``1 / HOT_SHARE``."""
    rows = _hashed_lines(_identified(documents.select("doc_id", "text").sample(HOT_SAMPLE, seed=11)))
    counts = rows.groupBy("_h").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n") * F.lit(HOT_SHARE)).first()[0] or 0
    return [r["_h"] for r in counts.filter(F.col("n") >= max(float(total), LEAST_SAMPLED)).select("_h").collect()]


def _streamed(documents: DataFrame, least: int, hot: list[int]) -> DataFrame:
    """Lines that may be dropped, with the documents that their key has in the range.

    The range is the partition of the window: dealing by (hash, slot) is what it asks for, so
    the sort inside a partition is the only other step.
    """
    slot = F.lit(-1)
    if hot:
        slot = F.when(F.col("_h").isin(hot), F.pmod(F.xxhash64("_doc", "_part"), F.lit(SLOTS)).cast("int")).otherwise(slot)
    dealt = _hashed_lines(_identified(documents)).withColumn("_slot", slot)
    ranged = dealt.repartitionByRange("_h", "_slot")
    key = Window.partitionBy("_h", "_slot", "_g")
    stream = key.orderBy("_doc", "_part", "_pos")
    same = (F.lag("_doc").over(stream) == F.col("_doc")) & (F.lag("_part").over(stream) == F.col("_part"))
    flagged = ranged.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    whole = key.orderBy("_doc", "_part", "_pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = flagged.withColumns({"_docs": F.sum("_new").over(whole), "_rank": F.row_number().over(stream)})
    return counted.filter((F.col("_docs") >= least) | (F.col("_slot") >= 0))


def dropped_lines(documents: DataFrame, least: int = LEAST_DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """(doc, part, pos) of the lines that go, from keys found in at least ``least`` documents.

    With ``keep_first`` the first line of a key, by document and position, stays.
    """
    rows = stored(_streamed(documents, least, _hot(documents)), "line-dedup-lines")
    cut = rows.filter(F.col("_slot") >= 0)
    place = F.struct("_doc", "_part", "_pos")
    # One row for each range of a cut key first, then one for each of those few keys.
    ranges = cut.filter(F.col("_rank") == 1).select("_h", "_g", "_docs", place.alias("_first"))
    totals = ranges.groupBy("_h", "_g").agg(F.sum("_docs").alias("_all"), F.min("_first").alias("_first"))
    whole = rows.filter(F.col("_slot") < 0)
    if keep_first:
        whole = whole.filter(F.col("_rank") > 1)
    # At most 1 / HOT_SHARE keys are cut, but for keys that share a first hash.
    met = cut.join(F.broadcast(totals.filter(F.col("_all") >= least)), ["_h", "_g"])
    if keep_first:
        met = met.filter(place != F.col("_first"))
    names = ["_doc", "_part", "_pos"]
    return whole.select(*names).unionByName(met.select(*names))


def _run_ends(n: Column, dropped: Column) -> Column:
    """Where the runs of a bitmap of ``n`` lines end, from the sorted dropped positions.

    Kept and dropped runs alternate, starting with the kept lines before the first dropped one.
    """
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1))
    return F.concat(F.flatten(F.zip_with(starts, ends, lambda s, e: F.array(s, e + 1))), F.array(n))


def kept_text(text: Column, keep: Column) -> Column:
    """The kept lines, joined by line breaks, read from the run ends."""

    def kept(lines: Column, ends: Column) -> Column:
        start = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
        pieces = F.transform(ends, lambda end, i: F.when(i % 2 == 0, F.slice(lines, start(i) + 1, end - start(i))))
        return F.array_join(F.flatten(F.filter(pieces, lambda piece: piece.isNotNull())), "\n")

    # Both bound once: inside the function they would be computed for every piece.
    return let(lines_of(text), lambda lines: let(keep, lambda ends: kept(lines, ends)))


def bitmaps(documents: DataFrame, least: int = LEAST_DOCUMENTS, keep_first: bool = False, with_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep) of every row: ``keep`` are the run ends of its bitmap.

    ``with_text`` adds the text, for readers that need both; one shuffle brings them together.
    """
    gone = dropped_lines(documents, least, keep_first).groupBy("_doc", "_part")
    gone = gone.agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    texts = _identified(documents).withColumn("_n", F.size(lines_of(F.col("text"))))
    if not with_text:
        texts = texts.drop("text")
    rows = texts.join(gone, ["_doc", "_part"], "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    return rows.select(
        "doc_id",
        F.col("_n").cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_dropped"),
        _run_ends(F.col("_n"), F.col("_gone")).alias("keep"),
        *(["text"] if with_text else []),
    )


def deduplicated(documents: DataFrame, least: int = LEAST_DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept), the last being the text without the dropped lines."""
    rows = bitmaps(documents, least, keep_first, with_text=True)
    kept = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(kept_text(F.col("text"), F.col("keep")))
    return rows.select("doc_id", "n_lines", "n_dropped", kept.alias("kept"))
