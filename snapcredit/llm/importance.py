"""Importance resampling of documents towards a target distribution of hashed word runs.

Words are the maximal runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z is lower-cased; a feature is a
run of `low` to `high` consecutive words joined by one space, and its bucket the CRC-32 of its bytes.

CRC-32 is linear over GF(2): the checksum of a feature is the XOR of one table entry per byte, chosen by
the byte and by its distance from the end of the feature, and of a constant of the length. So all
features of a chunk of texts are checksummed by one table look-up and one `bitwise_xor.reduceat`. The
table covers distances below BLOCK; a longer feature is cut into blocks from its end, whose values are
moved on by whole blocks of zero bytes (a linear map too, by powers of two) and folded together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcredit.llm.common import map_arrow, stored, text_chunks
from snapcredit.llm.word_runs import LOWER, byte_set, joined, runs, spread, with_breaks

CHUNK = 1 << 20
#: Distances from the end that the table holds.
BLOCK = 64
#: The reversed polynomial of CRC-32 (IEEE 802.3), a fixed value.
POLYNOMIAL = np.uint32(0xEDB88320)
ONES = np.uint32(0xFFFFFFFF)
WORD = ~byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
ROWS_PER_RANGE = 250_000


def byte_table() -> np.ndarray:
    """Register after each byte value, from a zero register."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = (register >> np.uint32(1)) ^ np.where(register & np.uint32(1), POLYNOMIAL, np.uint32(0))
    return register


BYTES = byte_table()


def after_zero(register: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return (register >> np.uint32(8)) ^ BYTES[register & np.uint32(0xFF)]


def position_table() -> np.ndarray:
    """[distance, byte]: what a byte adds to the register at the end, that many bytes later."""
    rows = [BYTES]
    while len(rows) < BLOCK:
        rows.append(after_zero(rows[-1]))
    return np.stack(rows)


TABLE = position_table()


def block_steps(count: int = 40) -> list[np.ndarray]:
    """The linear maps of BLOCK * 2 ** k zero bytes, each as four tables, one per byte of the register."""
    lanes = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for _ in range(BLOCK):
        lanes = after_zero(lanes)
    steps = [lanes]
    while len(steps) < count:
        steps.append(moved(steps[-1], steps[-1]))
    return steps


def moved(register: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The register after the zero bytes of a step."""
    low = np.uint32(0xFF)
    return (
        step[0][register & low]
        ^ step[1][register >> np.uint32(8) & low]
        ^ step[2][register >> np.uint32(16) & low]
        ^ step[3][register >> np.uint32(24)]
    )


STEPS = block_steps()


def moved_blocks(register: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Each register after its number of blocks of zero bytes."""
    register, k = register.copy(), 0
    while (left := blocks >> k).any():
        some = np.flatnonzero(left & 1)
        register[some] = moved(register[some], STEPS[k])
        k += 1
    return register


def length_constants() -> np.ndarray:
    """Register after 0 .. BLOCK - 1 zero bytes from all ones."""
    rows = [np.array([ONES])]
    while len(rows) < BLOCK:
        rows.append(after_zero(rows[-1]))
    return np.concatenate(rows)


LENGTHS = length_constants()


def span_crcs(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch `raw[start : start + length]`; stretches hold a byte at least and may overlap."""
    out = np.empty(len(start), np.uint32)
    short = length <= BLOCK
    for some, folded in ((np.flatnonzero(short), False), (np.flatnonzero(~short), True)):
        if not len(some):
            continue
        size = length[some]
        ends = np.cumsum(size)
        from_end = np.repeat(ends, size) - 1 - np.arange(ends[-1])
        entries = TABLE.ravel()[(from_end % BLOCK << 8) + raw[spread(start[some], size)]]
        first = ends - size
        if folded:
            blocks = from_end // BLOCK
            fresh = np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (from_end[1:] > from_end[:-1])])
            piece = np.flatnonzero(fresh)
            entries = moved_blocks(np.bitwise_xor.reduceat(entries, piece), blocks[piece])
            first = np.searchsorted(piece, first)
        constant = LENGTHS[size % BLOCK]
        if folded:
            constant = moved_blocks(constant, size // BLOCK)
        elif (full := size == BLOCK).any():
            constant = np.where(full, moved(constant, STEPS[0]), constant)
        out[some] = np.bitwise_xor.reduceat(entries, first) ^ constant ^ ONES
    return out


def chunk_features(raw: np.ndarray, lengths: np.ndarray, low: int, high: int, buckets: int):
    """Of a chunk of texts: words of each text, and bucket and text of each feature."""
    raw, ends = with_breaks(raw, lengths, 0x20)
    raw = LOWER[raw]
    inside = WORD[raw]
    at, size = runs(inside)
    owner = np.searchsorted(ends, at, "right")
    words, start = joined(raw, inside, size)
    stop = start + size
    found, whose = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in range(low, high + 1):
        last = np.arange(n - 1, len(start))
        if not len(last):
            continue
        first = last - (n - 1)
        same = owner[first] == owner[last]
        first, last = first[same], last[same]
        found.append((span_crcs(words, start[first], stop[last] - start[first]) % np.uint32(buckets)).astype(np.int64))
        whose.append(owner[first])
    return np.bincount(owner, minlength=len(lengths)), np.concatenate(found), np.concatenate(whose)


def bucket_counts(texts: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """(bucket, n): occurrences of the features of the column `text`. A task sends a row per bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for _, raw, lengths in text_chunks(batches, limit=CHUNK):
            total += np.bincount(chunk_features(raw, lengths, low, high, buckets)[1], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    counted = map_arrow(texts.select("text"), count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, low: int, high: int, buckets: int) -> np.ndarray:
    """Gain of every bucket; one row per bucket reaches the driver, whatever the tables."""
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    ours = bucket_counts(docs, low, high, buckets).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, low, high, buckets).withColumnRenamed("n", "t")
    both = every.join(ours, "bucket", "left").join(theirs, "bucket", "left").na.fill(0, ["s", "t"])
    rows = both.collect()
    sums = {"S": sum(r["s"] for r in rows), "T": sum(r["t"] for r in rows)}
    values = docs.sparkSession.createDataFrame([(r["bucket"], r["s"], r["t"]) for r in rows], "bucket long, s long, t long")
    ratio = ((F.col("t") + 1.0) * F.lit(float(sums["S"] + buckets))) / ((F.col("s") + 1.0) * F.lit(float(sums["T"] + buckets)))
    gains = np.zeros(buckets, np.int64)
    for r in values.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain")).collect():
        gains[r["bucket"]] = r["gain"]
    return gains


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the seed and the doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: Sequence[Column], n_rows: int) -> DataFrame:
    """Add `rank`, 1, 2, 3... over all rows in `order`: ranges sorted by themselves, moved up by the sizes of earlier ones."""
    parts = -(-n_rows // ROWS_PER_RANGE) or 1
    ranged = rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    inner = Window.partitionBy("part").orderBy(*order)
    # Kept: the ranges come from a sample and must be the same for the sizes and the rows.
    placed = stored(ranged.withColumn("rank", F.row_number().over(inner).cast("long")), "ranges")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    return placed.join(sizes, "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    low: int = 1,
    high: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Draw documents whose hashed word runs look like those of `target`, without replacement (Gumbel top-k).

    With s of S features of `docs` in a bucket and t of T of `target`, its gain is
    floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))); a document's `weight` is the sum over its features,
    its `score` the weight and Gumbel noise in thousandths made from `seed` and doc_id. Of the N documents with
    `min_words` words at least the floor(percent * N / 100) highest scores are drawn.

    Returns a row per row of `docs`: doc_id, n_words, n_features, weight, score, rank (1, 2, 3...; null: not
    drawn) and, if `keep` names columns, a struct `kept` of them; other columns of the input, whatever their
    names, play no part. A null text is empty; empty texts weigh 0 and are not drawn. A null doc_id counts as
    an empty string in the noise and comes last among ties. Ties go to the smaller doc_id, then to fewer
    features and the smaller hash of the text; equal rows are rows of their own with ranks in any order. An
    empty `docs` gives no rows; an empty `target` gives every bucket a gain by s alone.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), *kept)
    aim = target.select(F.coalesce(F.col(target_text).cast("string"), F.lit("")).alias("text"))
    gains = docs.sparkSession.sparkContext.broadcast(bucket_gains(texts, aim, low, high, buckets))

    def weigh(batches):
        for batch, raw, lengths in text_chunks(batches, limit=CHUNK):
            words, found, owner = chunk_features(raw, lengths, low, high, buckets)
            weight = np.zeros(len(lengths), np.int64)
            # bincount sums doubles; features are in order of their text, so whole sums stay exact integers.
            order = np.argsort(owner, kind="stable")
            sums = np.concatenate([[0], np.cumsum(gains.value[found[order]])])
            n = np.bincount(owner, minlength=len(lengths))
            upto = np.cumsum(n)
            weight = sums[upto] - sums[upto - n]
            carried = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                [*names, "n_words", "n_features", "weight"],
            )

    texts = texts.withColumn("tie", F.xxhash64("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    weighed = map_arrow(texts, weigh, f"{schema}, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")
    eligible = scored.where(F.col("n_words") >= min_words)
    n = eligible.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("tie")]
    placed = ranked(eligible, order, n)
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank", *(["kept"] if keep else [])]
    return drawn.select(names).unionByName(rest.select(names))
