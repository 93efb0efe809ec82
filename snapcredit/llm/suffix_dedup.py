"""Suffix-array dedup: bytes covered by a string that also starts elsewhere go."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import as_struct, keyed_columns, keyed_texts, map_arrow, merge_spans, packed, stored, text_chunks, unpacked
from snapcredit.llm.repeats import (
    SKETCH_BITS,
    by_document,
    repeated_segments,
    with_copies,
    with_rows,
)
from snapcredit.llm.rolling import BASE_A, BASE_B, BYTE_CODES, mix, window_hashes

LENGTH = 200
#: Bytes of the anchor string.
ANCHOR = 64
#: Leading bytes of the suffix at the anchor, by which buckets are cut.
LEAD = 16
#: Contents of one anchor that a bucket sorts; the suffixes of a larger group are dealt out one by one.
GROUP = 1_000
#: Bytes of segments in a bucket, about, and of those that it sorts at once.
BUCKET_BYTES, SORT_BYTES = 1 << 23, 1 << 20


def equal_suffixes(data: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """Whether `data[s:s + length]` equals that of another suffix s.

    Multikey quicksort with eight bytes as one key: a part that shares its keys so far is sorted by the
    next eight bytes. A suffix that is alone in its part has no equal and drops out; a part of two is
    compared to its end instead of sorted.
    """
    repeated = np.zeros(len(suffix), bool)
    keys = np.zeros(max(len(data) - 7, 0), np.uint64)
    for j in range(8):
        keys = (keys << np.uint64(8)) | data[j : len(keys) + j]
    # The last key overlaps the one before, so that no byte after the suffix is read.
    depths = [*range(0, length - 8, 8), length - 8]
    alive, part = np.arange(len(suffix)), None
    for at, depth in enumerate(depths):
        key = keys[suffix[alive] + depth]
        order = np.argsort(key) if part is None else np.lexsort((key, part))
        alive, key = alive[order], key[order]
        fresh = np.ones(len(alive), bool)
        fresh[1:] = key[1:] != key[:-1]
        if part is not None:
            part = part[order]
            fresh[1:] |= part[1:] != part[:-1]
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(alive)))
        one, two = alive[first[size == 2]], alive[first[size == 2] + 1]
        for rest in depths[at + 1 :]:
            same = keys[suffix[one] + rest] == keys[suffix[two] + rest]
            one, two = one[same], two[same]
        repeated[one] = repeated[two] = True
        large = size > 2
        keep = np.repeat(large, size)
        alive, part = alive[keep], np.repeat(np.arange(large.sum()), size[large])
        if not len(alive):
            break
    repeated[alive] = True
    return repeated


def _cut(length: int, doc_type: str):
    """The bytes of listed segments, with the leading bytes of the suffix at their common string."""

    def cut(batches):
        for batch, raw, lengths in text_chunks(unpacked(batches)):
            base = np.cumsum(lengths) - lengths
            lists = batch.column("rows")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            start, n, ahead = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "n", "at"))
            begin = base[owner] + start
            data = raw.tobytes()
            pieces = [data[b : b + c + length - 1] for b, c in zip(begin, n, strict=True)]
            leads = [data[at : at + LEAD] for at in begin + ahead]
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    flat.field("start"),
                    flat.field("anchor"),
                    flat.field("copies"),
                    flat.field("rivals"),
                    pa.array(leads, pa.binary()),
                    pa.array(pieces, pa.binary()),
                ],
                ["doc_id", "text_hash", "start", "anchor", "copies", "rivals", "lead", "piece"],
            )

    return cut, (
        f"doc_id {doc_type}, text_hash int, start int, anchor long, copies long, rivals long, "
        "lead binary, piece binary"
    )


def _flatten_pieces(table: pa.Table, length: int):
    """Bytes of all pieces end to end, and the row, place and offset of each suffix of `length` in them."""
    pieces = table.column("piece").combine_chunks().cast(pa.large_binary())
    sizes = np.array([len(p) for p in pieces.to_pylist()], np.int64)
    data = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
    n = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return data, row, (np.cumsum(sizes) - sizes)[row] + offset, offset


def _sort_bucket(length: int, doc_type: str):
    """Repeated suffixes of a bucket that comes in the order of its anchors."""

    def runs(table: pa.Table) -> pa.RecordBatch:
        data, row, suffix, offset = _flatten_pieces(table, length)
        alone = table.column("copies").to_numpy() == 1  # a copied segment is known to repeat
        hit = equal_suffixes(data, suffix, length) & alone[row]
        row, offset = row[hit], offset[hit]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
        first = np.flatnonzero(fresh)
        count = np.diff(np.append(first, len(row)))
        rows = pa.array(row[first])
        start = table.column("start").to_numpy()[row[first]] + offset[first]
        return pa.RecordBatch.from_arrays(
            [
                table.column("doc_id").combine_chunks().take(rows),
                table.column("text_hash").combine_chunks().take(rows),
                pa.array(start.astype(np.int32)),
                pa.array(count.astype(np.int32)),
            ],
            ["doc_id", "text_hash", "start", "n"],
        )

    def sort(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            first = 0
            # Cut between anchors whenever enough is held.
            edges = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            if held and len(anchors) and held[-1].column("anchor")[-1].as_py() != anchors[0]:
                edges = np.insert(edges, 0, 0)
            for edge in edges:
                if size + batch.slice(first, edge - first).nbytes < SORT_BYTES:
                    continue
                held.append(batch.slice(first, edge - first))
                yield runs(pa.Table.from_batches(held))
                held, size, first = [], 0, edge
            held.append(batch.slice(first))
            size += held[-1].nbytes
        if sum(b.num_rows for b in held):
            yield runs(pa.Table.from_batches(held))

    return sort, f"doc_id {doc_type}, text_hash int, start int, n int"


def _hash_suffixes(length: int, doc_type: str):
    """One row per suffix, as a pair of hashes."""

    def expand(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 4_000):
                table = pa.Table.from_batches([batch.slice(first, 4_000)])
                data, row, suffix, offset = _flatten_pieces(table, length)
                low = window_hashes(BYTE_CODES[data], length, BASE_A)
                high = window_hashes(mix(BYTE_CODES[data]), length, BASE_B)
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        table.column("doc_id").combine_chunks().take(rows),
                        table.column("text_hash").combine_chunks().take(rows),
                        pa.array((table.column("start").to_numpy()[row] + offset).astype(np.int32)),
                        table.column("copies").combine_chunks().take(rows),
                        pa.array(low[suffix].view(np.int64)),
                        pa.array(high[suffix].view(np.int64)),
                    ],
                    ["doc_id", "text_hash", "start", "copies", "low", "high"],
                )

    return expand, f"doc_id {doc_type}, text_hash int, start int, copies long, low long, high long"


def _remove(length: int, schema: str, keep: Sequence[str]):
    def apply(batches):
        for batch in unpacked(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            lists = batch.column("rows")
            kept, spans = [], []
            for i, text in enumerate(texts):
                rows = lists[i].values
                if rows is None or not len(rows):
                    kept.append(text)
                    spans.append([])
                    continue
                start = rows.field("start").to_numpy().astype(np.int64)
                first, last = merge_spans(start, start + rows.field("n").to_numpy() + length - 1)
                edges = [0, *np.column_stack([first, last]).ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in zip(edges[1::2], edges[2::2], strict=False)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(batch.column(c) for c in keep),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", *keep, "n_bytes", "spans", "kept"],
            )

    return apply, schema


def drop_repeated_strings(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    keep: Sequence[str] = (),
    sketch_bits: int = SKETCH_BITS,
    group: int = GROUP,
) -> DataFrame:
    """Texts without any byte covered by a `length`-byte string that also starts anywhere else.

    Strings are read from the UTF-8 bytes of one text, overlapping and in the same document included,
    and judged on the input. Null texts are empty. An exactly repeated row is a copy like any other.

    The suffixes that can repeat are those of segments whose common string was met twice (`repeats`).
    Equal segments repeat whole and are grouped. Suffixes of the other segments are range-partitioned by
    the leading bytes of the suffix at that string, with Spark's sampled splitters, and sorted in the
    bucket by multikey quicksort; equal suffixes have equal strings, and equal range keys never fall on
    both sides of a splitter, so each is next to its equals in one bucket. A string with more than
    `group` different segments has its suffixes dealt out singly, by a pair of hashes, and counted with
    partial aggregation, so no bucket grows with a hot passage.

    Returns doc_id, the `keep` columns (none with a name of the result), n_bytes, spans (start and end of each maximal removed run) and
    kept (bytes; a cut may fall inside a character).
    """
    texts = keyed_texts(docs, doc_id, text)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = with_copies(
        repeated_segments(texts, "bytes", length, anchor, sketch_bits), "copies > 1 or rivals > 1"
    )
    if clash := {"doc_id", "n_bytes", "spans", "kept"} & set(keep):
        raise ValueError(f"names of the result cannot be kept: {sorted(clash)}")
    carried = [as_struct(docs, keep).alias("carried")] if keep else []
    small = packed(docs.select(*carried, *keyed_columns(doc_id, text)))
    whole = found.where("copies > 1")

    cut, schema = _cut(length, id_type)
    compared = found.where("first and rivals > 1")
    lists = by_document(compared, "start", "n", "at", "anchor", "copies", "rivals")
    pieces = stored(map_arrow(with_rows(small, lists, "inner"), cut, schema), "suffixes")
    sized = compared.agg(F.sum(F.col("n") + length - 1)).first()[0] or 0
    parts = -(-sized // BUCKET_BYTES) or 1
    sort, schema = _sort_bucket(length, id_type)
    buckets = pieces.where(F.col("rivals") <= group).repartitionByRange(parts, "lead", "anchor")
    bucketed = map_arrow(buckets.sortWithinPartitions("lead", "anchor"), sort, schema)

    expand, schema = _hash_suffixes(length, id_type)
    single = map_arrow(pieces.where(F.col("rivals") > group), expand, schema)
    twice = single.groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    large = single.where("copies = 1").join(twice, ["low", "high"], "left_semi")

    spans = (
        whole.select("doc_id", "text_hash", "start", "n")
        .unionByName(bucketed)
        .unionByName(large.select("doc_id", "text_hash", "start", F.lit(1).alias("n")))
    )
    names = [c for c in small.columns if c == "carried"]
    kinds = "".join(f", {c} {small.schema[c].dataType.simpleString()}" for c in names)
    apply, schema = _remove(
        length, f"doc_id {id_type}{kinds}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary", names
    )
    done = map_arrow(with_rows(small, by_document(spans, "start", "n"), "left"), apply, schema)
    return done.select("doc_id", *[f"{c}.*" for c in names], "n_bytes", "spans", "kept")
