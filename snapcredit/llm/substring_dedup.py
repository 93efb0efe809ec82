"""Substring dedup: words of windows that also start earlier go; a count-min sketch picks the windows to group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import keyed_texts, map_arrow, packed, text_chunks, unpacked
from snapcredit.llm.repeats import (
    SKETCH_BITS,
    by_document,
    chunk_codes,
    repeated_segments,
    with_copies,
    with_rows,
)
from snapcredit.llm.rolling import BASE_A, BASE_B, mix, window_hashes

WINDOW = 20
#: Words of the anchor that a window is counted under. A longer anchor repeats less by chance, a shorter
#: one makes fewer segments.
ANCHOR = 6


def _listed_windows(batch: pa.RecordBatch, raw: np.ndarray, lengths: np.ndarray, window: int):
    """Text, place and hash pair of each window in the listed segments of some texts."""
    codes, starts, _ = chunk_codes(raw, lengths, "words")
    low, high = window_hashes(codes, window, BASE_A), window_hashes(mix(codes), window, BASE_B)
    lists = batch.column("rows")
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    start, n = (lists.flatten().field(c).to_numpy().astype(np.int64) for c in ("start", "n"))
    # A segment's windows: its start and the n - 1 places after it.
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
    owner = np.repeat(owner, n)
    at = place + starts[owner]
    return owner, place, low[at], high[at]


def listed_windows(texts: DataFrame, lists: DataFrame, window: int) -> DataFrame:
    """One row per window of listed segments: its document, start and hash pair."""

    def expand(batches):
        for chunk in text_chunks(unpacked(batches)):
            owner, place, low, high = _listed_windows(*chunk, window)
            row = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk[0].column("doc_id").take(row),
                    chunk[0].column("text_hash").take(row),
                    pa.array(place.astype(np.int32)),
                    pa.array(low.view(np.int64)),
                    pa.array((high >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                ],
                ["doc_id", "text_hash", "start", "low", "high"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash int, start int, low long, high int"
    return map_arrow(with_rows(texts, lists, "inner"), expand, schema)


def _remove(window: int, schema: str, keep: Sequence[str]):
    def apply(batches):
        for batch in unpacked(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            lists = batch.column("rows").to_pylist()
            n_words, n_removed, kept = [], [], []
            for text, rows in zip(texts, lists, strict=True):
                words = text.split()
                total = len(words)
                if rows:
                    gone = np.zeros(total + 1, np.int32)
                    np.add.at(gone, [r["start"] for r in rows], 1)
                    np.add.at(gone, [r["start"] + r["n"] + window - 1 for r in rows], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                n_words.append(total)
                n_removed.append(total - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(batch.column(c) for c in keep),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", *keep, "n_words", "n_removed", "kept_text"],
            )

    return apply, schema


def drop_repeated_windows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """Texts without the words of any window that also starts earlier.

    A window is `window` consecutive words of one text, a word a run of other bytes than blanks and
    ASCII control blanks. Earlier means a smaller doc_id, or the same one and an earlier start; a null
    doc_id is smaller than any. Windows are judged on the input. Rows that share doc_id and start tie,
    so an exactly repeated row loses nothing to its copy.

    Every window is counted, under a string of 13 words that it holds, in a merged count-min sketch, which
    overestimates; of the segments it leaves, equal ones are grouped whole, so a hot passage is aggregated before any of its
    windows is shuffled. The windows of segments that only share their string are grouped exactly, by
    96-bit hashes of their words.

    Returns doc_id, n_words, n_removed and kept_text (words joined by one space) for each row; null
    and empty texts have no words. Other columns are not carried.
    """
    texts = keyed_texts(docs, doc_id, text)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = with_copies(
        repeated_segments(texts, "words", window, anchor, sketch_bits), "not first or rivals > 1"
    )
    small = packed(texts)

    # Copies of a segment after the first one repeat all its windows.
    copies = found.where("not first")

    # Windows of segments that differ but share their anchor are grouped one by one.
    lists = by_document(found.where("first and rivals > 1"), "start", "n")
    windows = listed_windows(small, lists, window)
    place = F.struct("doc_id", "start")
    earliest = (
        windows.groupBy("low", "high")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    later = windows.join(earliest, ["low", "high"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("start") == F.col("first.start")))
    )

    spans = copies.select("doc_id", "text_hash", "start", "n").unionByName(
        later.select("doc_id", "text_hash", "start", F.lit(1).alias("n"))
    )
    apply, schema = _remove(
        window, f"doc_id {id_type}, n_words long, n_removed long, kept_text string", ()
    )
    return map_arrow(with_rows(small, by_document(spans, "start", "n"), "left"), apply, schema)
