"""Best-fit packing of documents into bins of fixed size, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import let, map_arrow

CAPACITY = 2_048
#: Items that are packed together; more of them would fill bins hardly better.
SHARD = 8_192
#: Bins of a shard get consecutive numbers from shard * STRIDE.
STRIDE = 1 << 24


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each item, and what is left in each bin; larger items first.

    Bins stand ordered by what is left in them, each with a bitmap of the sources and one of the
    duplicate clusters it holds. The search starts at the first bin that is large enough and goes on to
    the next larger one until neither bitmap has the item's bit: the tightest compatible bin. A negative
    source or cluster conflicts with nothing.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    free: list[tuple[int, int]] = []
    has_source: list[int] = []
    has_cluster: list[int] = []
    bins = [0] * len(sizes)
    for i in order:
        source = 1 << sources[i] if sources[i] >= 0 else 0
        cluster = 1 << clusters[i] if clusters[i] >= 0 else 0
        at = bisect_left(free, (sizes[i], -1))
        while at < len(free):
            b = free[at][1]
            if not (has_source[b] & source or has_cluster[b] & cluster):
                break
            at += 1
        if at < len(free):
            left, b = free.pop(at)
            has_source[b] |= source
            has_cluster[b] |= cluster
        else:
            left, b = capacity, len(has_source)
            has_source.append(source)
            has_cluster.append(cluster)
        insort(free, (left - sizes[i], b))
        bins[i] = b
    room = [0] * len(has_source)
    for left, b in free:
        room[b] = left
    return bins, room


def _numbered(values: list, shared_only: bool) -> list[int]:
    """A small number for each value, -1 for null and, if asked, for values met once."""
    counts = Counter(v for v in values if v is not None)
    names = {v: i for i, v in enumerate(v for v, n in counts.items() if n > shared_only)}
    return [names.get(v, -1) for v in values]


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    capacity: int = CAPACITY,
    shard: int = SHARD,
) -> DataFrame:
    """Every document placed in bins of `capacity` words, no bin with two documents of one source or of one
    cluster of copies.

    Copies are texts with the same lower-cased words. A document longer than a bin is cut: its leading
    pieces of `capacity` words fill bins of their own, the rest is packed like a document. Rows are dealt
    evenly into shards of about `shard` rows, whatever their keys, and each shard is packed on its own by
    decreasing size, so a hot source or a large group of copies is spread and no task grows with it.

    Returns one row per piece: bin_id, doc_id, piece (from 0), first_word, n_words and bin_words (words
    of its bin). Null and empty texts are pieces of no words; null sources and ids conflict with nothing.
    Other columns are not carried.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    items = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(source)).alias("named"),
        F.col(source).isNotNull().alias("has_source"),
        let(words, lambda w: F.struct(F.size(w).alias("size"), F.xxhash64(w).alias("cluster"))).alias("body"),
    ).select("doc_id", F.when(F.col("has_source"), F.col("named")).alias("source"), "body.*")
    parts = max(1, -(-docs.count() // shard))

    def place(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        size = table.column("size").to_numpy().astype(np.int64)
        tail = np.where((size % capacity == 0) & (size > 0), capacity, size % capacity)
        full = (size - tail) // capacity
        clusters = [c if s else None for c, s in zip(table.column("cluster").to_pylist(), size, strict=True)]
        bins, room = best_fit(
            tail.tolist(),
            _numbered(table.column("source").to_pylist(), False),
            _numbered(clusters, True),
            capacity,
        )
        base = TaskContext.get().partitionId() * STRIDE
        row = np.concatenate([np.arange(len(size)), np.repeat(np.arange(len(size)), full)])
        piece = np.concatenate([full, np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)])
        bin_of = np.concatenate([np.array(bins, np.int64), len(room) + np.arange(full.sum())])
        count = np.concatenate([tail, np.full(full.sum(), capacity)])
        used = np.concatenate([capacity - np.array(room, np.int64), np.full(full.sum(), capacity)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(base + bin_of),
                table.column("doc_id").combine_chunks().take(pa.array(row)),
                pa.array(piece.astype(np.int32)),
                pa.array(piece * capacity),
                pa.array(count),
                pa.array(used[bin_of]),
            ],
            ["bin_id", "doc_id", "piece", "first_word", "n_words", "bin_words"],
        )

    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"bin_id long, doc_id {id_type}, piece int, first_word long, n_words long, bin_words long"
    return map_arrow(items.repartition(parts), place, schema)
