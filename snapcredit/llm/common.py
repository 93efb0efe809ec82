"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.session import scratch_path, ship

#: Bytes of text that a Python task works on at once; a longer document is worked on alone.
CHUNK_BYTES = 1 << 17


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value computed once per row: a name bound in a lambda is not evaluated again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_struct(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Columns as one struct, so that their names meet no other ones until `.*` takes them out again."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])


def keyed_columns(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """The columns of `keyed_texts`."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.col(doc_id).alias("doc_id"), body.alias("text"), F.hash(body).alias("text_hash")]


def keyed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and a hash of the text: rows that share a doc_id but not their text
    are told apart by it, and equal rows behave alike."""
    return docs.select(*keyed_columns(doc_id, text))


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows whose texts fill about `limit` bytes, with the bytes end to end and the bytes of each text."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield (
                batch.slice(first, last - first),
                raw[offsets[first] : offsets[last]],
                np.diff(offsets[first : last + 1]),
            )
            first = last


def packed(texts: DataFrame) -> DataFrame:
    """The frame with column text compressed, for a shuffle; `unpacked` undoes it inside a task."""

    names = texts.columns
    at = names.index("text")

    def pack(batches):
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = [compress(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            columns = [*batch.columns[:at], pa.array(small, pa.binary()), *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(
        f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in texts.schema
    )
    return map_arrow(texts, pack, schema)


def unpacked(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about `limit` bytes with their texts as bytes again."""
    restore = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        at, first, size, held = batch.schema.names.index("text"), 0, 0, []
        for row, small in enumerate(batch.column("text").to_pylist()):
            held.append(restore(small))
            size += len(held[-1])
            if size >= limit or row == batch.num_rows - 1:
                part = batch.slice(first, len(held))
                columns = [*part.columns[:at], pa.array(held, pa.large_binary()), *part.columns[at + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)
                first, size, held = row + 1, 0, []


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans; touching spans join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.flatnonzero(np.concatenate([fresh[1:], [True]]))
    return starts[fresh], reach[last]


#: Shuffle files go when the query that wrote them ends, not when the driver next collects its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept where every executor can read it; the shuffles it took leave no files.

    The folder is the session's `spark.checkpoint.dir`; only a local master may do without.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoints"))
    held = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a frame follows the setting it was made under
    finally:
        spark.conf.unset(FILE_CLEANUP) if held is None else spark.conf.set(FILE_CLEANUP, held)


def map_arrow(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """`df.mapInArrow`, with the library sent along."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def group_arrow(left: DataFrame, right: DataFrame, key: Sequence[str], task: Callable, schema: str) -> DataFrame:
    """The groups of both frames with equal keys, as Arrow tables, with the library sent along."""
    ship(left.sparkSession)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(task, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once as a table in the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
