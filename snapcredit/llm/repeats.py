"""Which segments of a corpus may hold a repeated window: the pre-filter of both repeat finders.

Pass 1 sends each partition's sketch, a count of the cells of its segments' strings, to a merged count-min
sketch. Its 2 ** 48 cells are held sparsely, as a table of those met, so it does not fill up as the corpus
grows; a cell still only overestimates. Cells met twice or more become a bitmap of a size that follows
their number (`bitmaps`). Pass 2 keeps the segments whose cell is in it and writes them once. No repeated
window is lost; a full bitmap keeps more segments, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.bitmaps import MOST_BITS, bitmap_of
from snapcredit.llm.common import map_arrow, stored, text_chunks
from snapcredit.llm.rolling import BYTE_CODES, PrefixHash, halves, word_codes

#: Bits of a cell of the sketch, and of the largest bitmap that is broadcast.
CELL_BITS = 48
SKETCH_BITS = MOST_BITS


def chunk_codes(raw: np.ndarray, lengths: np.ndarray, unit: str):
    """Symbol codes of a chunk, and the first symbol and number of symbols of each text."""
    if unit == "bytes":
        return BYTE_CODES[raw], np.cumsum(lengths) - lengths, lengths
    # A blank between texts keeps their words apart.
    ends = np.cumsum(lengths)
    codes, at = word_codes(np.insert(raw, ends[:-1], 0x20) if len(lengths) > 1 else raw)
    owner = np.searchsorted(ends + np.arange(len(ends)), at, "right")
    counts = np.bincount(owner, minlength=len(lengths))[: len(lengths)]
    return codes, np.cumsum(counts) - counts, counts


def segment_rows(batches, unit: str, window: int, gram: int) -> Iterator[tuple]:
    """For each chunk: its rows, first symbols, hashes of stretches, and its segments: first window, number of
    windows, start of the common string, text, and hash of the common string."""
    for batch, raw, lengths in text_chunks(batches):
        codes, starts, counts = chunk_codes(raw, lengths, unit)
        first, n, at, owner, size = halves(codes, starts, counts, window, gram)
        if len(first):
            hashes = PrefixHash(codes)
            yield batch, starts, hashes, (first, n, at, owner, hashes.of(at, np.full(len(at), size)))


def cells_of(anchor: np.ndarray) -> np.ndarray:
    return (anchor >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def repeated_cells(cells: DataFrame) -> DataFrame:
    """Merge of partition sketches (cell, n): the cells met at least twice."""
    return cells.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")


def repeated_segments(
    texts: DataFrame, unit: str, window: int, gram: int, bits: int = SKETCH_BITS
) -> DataFrame:
    """Segments that may hold a repeated window, as a stored table.

    texts: of `keyed_texts`. Returns doc_id, text_hash, anchor and content (hashes of the common string and of
    the whole segment), start (symbol), n (windows) and at (start of the common string in the segment).
    """

    def count(batches):
        for *_, (_, _, _, _, anchor) in segment_rows(batches, unit, window, gram):
            cell, n = np.unique(cells_of(anchor), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int32))], ["cell", "n"])

    counts = map_arrow(texts.select("text"), count, "cell long, n int")
    twice = stored(repeated_cells(counts), "cells")
    sketch = texts.sparkSession.sparkContext.broadcast(bitmap_of(twice, "cell", CELL_BITS, bits))

    def look_up(batches):
        for batch, starts, hashes, found in segment_rows(batches, unit, window, gram):
            keep = sketch.value.holds(cells_of(found[-1]))
            if not keep.any():
                continue
            first, n, at, owner, anchor = (x[keep] for x in found)
            content = hashes.of(first, n + window - 1)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(anchor.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array((first - starts[owner]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array((at - first).astype(np.int32)),
                ],
                ["doc_id", "text_hash", "anchor", "content", "start", "n", "at"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash int, anchor long, content long, start int, n int, at int"
    return stored(map_arrow(texts, look_up, schema), "found")


def with_copies(found: DataFrame, wanted: str) -> DataFrame:
    """Each segment with `copies`, the segments equal to it, itself included, whether it is the `first` of
    them, the one with the smallest (doc_id, start), null first, and `rivals`, the different segments of
    its anchor. Segments alone in their anchor are left out. Kept as a table of the `wanted` rows: all
    that follows reads it instead of the texts. `anchor` stays where single windows are compared."""
    grouped = found.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "start")).alias("place")
    )
    # Also kept: it is needed whole and by anchor, and would be grouped once for each.
    contents = stored(grouped, "contents")
    rivals = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("rivals"))
    contents = contents.join(rivals, "anchor").where("copies > 1 or rivals > 1")
    first = F.col("doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("start") == F.col("place.start"))
    joined = found.join(contents, ["anchor", "content"]).withColumn("first", first)
    compared = F.col("first") & (F.col("rivals") > 1)
    rows = joined.where(wanted).withColumn("anchor", F.when(compared, F.col("anchor")))
    return stored(rows.drop("place", "content"), "segments")


def by_document(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of a document as one list without repeats, at most as long as the document."""
    return rows.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(*columns)).alias("rows"))


def with_rows(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts with their list of `by_document`. A list meets every equal row of its key."""
    lists = lists.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "rows")
    match = texts["doc_id"].eqNullSafe(lists["_id"]) & (texts["text_hash"] == lists["_hash"])
    return texts.join(lists, match, how).drop("_id", "_hash")
