"""Collocations per language: phrases whose words follow each other more often than their parts meet others.

Counting goes through a prefix-free parse. Texts are split at delimiters into pieces, and a piece is cut
into *chunks* wherever a window of `longest - 1` words has a hash divisible by `modulus`: a chunk ends with
such a window and the next one begins with it, so neighbours overlap by one word less than the longest
phrase and every phrase lies whole inside a chunk. Content alone decides the cuts, so repeated text gives
repeated chunks: the corpus becomes a dictionary of distinct chunks and their frequencies, and phrases are
counted once per distinct chunk, weighted. A phrase that starts inside the trailing window of a chunk is
left to the next one, so the overlap counts once.

Counting is exact and level by level. Words come first. Pairs of frequent words are counted under a 64-bit
hash, which can only count too much; phrases all of whose pairs reach `least` are then counted under their
text. What is known of the level before is a bitmap of a size that follows its number of entries, up to
MOST_BITS; a fuller bitmap lets more through to the exact count and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcredit.llm.common import map_arrow, stored, text_chunks
from snapcredit.llm.rolling import BASE_A, BYTE_CODES, PrefixHash, mix, window_hashes
from snapcredit.llm.word_runs import LOWER, byte_set, joined, runs, texts_of, with_breaks

CHUNK = 1 << 20
#: Bytes of dictionary that a task works on at once.
PART = 1 << 21
DELIMITER = byte_set((0x0A, 0x0D)) | np.isin(np.arange(256), list(b".,;:!?"))
BLANK = byte_set((0x20, 0x20), (0x09, 0x09))
#: Bits of a bitmap per entry, and its smallest and largest size as powers of two (128 KB and 128 MB).
PER_ENTRY, LEAST_BITS, MOST_BITS = 16, 20, 30
#: Cells of one bitmap of Spark's bitmap functions.
BITMAP = 32_768


def parse(raw: np.ndarray, lengths: np.ndarray, longest: int, modulus: int):
    """Chunks of texts laid end to end: their bytes, first byte, length, text and whether they end a piece."""
    raw, ends = with_breaks(raw, lengths, 0x0A)
    raw = LOWER[raw]
    parted = DELIMITER[raw]
    inside = ~(parted | BLANK[raw])
    at, size = runs(inside)
    if not len(at):
        none = np.empty(0, np.int64)
        return raw, none, none, none, np.empty(0, bool)
    piece = np.cumsum(parted)[at]
    words, start = joined(raw, inside, size)
    stop = start + size
    fresh = np.concatenate([[True], piece[1:] != piece[:-1]])
    cut, lap = fresh.copy(), longest - 1
    if len(at) >= lap:
        window = window_hashes(PrefixHash(BYTE_CODES[raw]).of(at, size), lap)
        whole = piece[: len(window)] == piece[lap - 1 :]
        cut[: len(window)] |= whole & (window % np.uint64(modulus) == 0)
    first = np.flatnonzero(cut)
    following = np.append(first[1:], len(at))
    last = np.append(fresh[first[1:]], True)
    final = np.where(last, following, following + lap) - 1
    owner = np.searchsorted(ends, at[first], "right")
    return words, start[first], stop[final] - start[first], owner, last


def chunk_table(docs: DataFrame, longest: int, modulus: int) -> DataFrame:
    """The dictionary of the parse: (lang, chunk, last, n), n the frequency. docs: lang and text."""

    def cut(batches):
        for batch, raw, lengths in text_chunks(batches, limit=CHUNK):
            words, start, length, owner, last = parse(raw, lengths, longest, modulus)
            if len(start):
                langs = batch.column("lang").take(pa.array(owner))
                chunks = texts_of(words, start, length)
                yield pa.RecordBatch.from_arrays([langs, chunks.cast(pa.large_string()), pa.array(last)], ["lang", "chunk", "last"])

    found = map_arrow(docs, cut, "lang string, chunk string, last boolean")
    return stored(found.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("n")), "chunks")


class Part:
    """Words of some rows of the dictionary: ids and hashes of (lang, word), weights, and which may start a phrase."""

    def __init__(self, table: pa.Table, lap: int):
        chunks = pa.chunked_array(table.column("chunk")).cast(pa.large_string()).combine_chunks()
        offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
        data = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        self.raw, ends = with_breaks(data, np.diff(offsets), 0x20)
        self.at, self.size = runs(self.raw != 0x20)
        self.owner = np.searchsorted(ends, self.at, "right")
        self.langs = table.column("lang").combine_chunks().dictionary_encode()
        lang = self.langs.indices.to_numpy()[self.owner]
        self.words = texts_of(self.raw, self.at, self.size).dictionary_encode()
        self.ids = paired(self.words.indices.to_numpy(), lang)
        codes = np.array([hash_of(x) for x in self.langs.dictionary.to_pylist()], np.uint64)
        with np.errstate(over="ignore"):
            self.hashes = mix(PrefixHash(BYTE_CODES[self.raw]).of(self.at, self.size) + codes[lang])
        counts = np.bincount(self.owner, minlength=table.num_rows)
        self.left = np.cumsum(counts)[self.owner] - np.arange(len(self.at))  # words up to the end of the chunk
        self.owned = table.column("last").to_numpy()[self.owner] | (self.left > lap)
        self.weight = table.column("n").to_numpy()[self.owner]

    def lang_of(self, places: np.ndarray) -> pa.Array:
        return self.langs.dictionary.take(pa.array(self.langs.indices.to_numpy()[self.owner[places]]))

    def text_of(self, places: np.ndarray, n: int) -> pa.Array:
        end = places + n - 1
        return texts_of(self.raw, self.at[places], self.at[end] + self.size[end] - self.at[places]).cast(pa.large_string())

    def pair_hashes(self) -> np.ndarray:
        """Hash of each word and the next."""
        with np.errstate(over="ignore"):
            return mix(self.hashes[:-1] * BASE_A + self.hashes[1:])

    def sums(self, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equal keys at some places: one of the places, and the sum of the weights."""
        _, first, which = np.unique(keys[places], return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, which, self.weight[places])
        return places[first], total


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where both a and b are."""
    _, ids = np.unique(a.astype(np.int64) * (int(b.max()) + 1) + b, return_inverse=True)
    return ids


def hash_of(name: str) -> int:
    raw = np.frombuffer(name.encode() + b"\0", np.uint8)
    return int(PrefixHash(BYTE_CODES[raw]).of(np.array([0]), np.array([len(raw)]))[0])


def part_rows(batches: Iterator[pa.RecordBatch], lap: int) -> Iterator[Part]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PART:
            yield Part(pa.Table.from_batches(held), lap)
            held, size = [], 0
    if held:
        yield Part(pa.Table.from_batches(held), lap)


def cell_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def bitmap_of(hashes: DataFrame) -> tuple[bytes, int]:
    """A bit set for each value of the column `hash`, and the power of two of its size."""
    wanted = max(1, hashes.count() * PER_ENTRY)
    bits = min(max(LEAST_BITS, (wanted - 1).bit_length()), MOST_BITS)
    cell = F.shiftrightunsigned("hash", 64 - bits) + 1  # Spark's bitmap functions number values from 1
    maps = (
        hashes.select(cell.alias("cell"))
        .groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    )
    merged = bytearray((1 << bits) // 8 + BITMAP // 8)
    for row in maps.collect():
        merged[(row["bucket"] - 1) * BITMAP // 8 : row["bucket"] * BITMAP // 8] = row["bits"]
    return bytes(merged), bits


def among(known: tuple[bytes, int], hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    cell = cell_of(hashes, known[1])
    return (np.frombuffer(known[0], np.uint8)[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def word_counts(chunks: DataFrame, lap: int) -> DataFrame:
    """(lang, phrase, hash, a) of all words."""

    def count(batches):
        for part in part_rows(batches, lap):
            place, total = part.sums(part.ids, np.flatnonzero(part.owned))
            yield pa.RecordBatch.from_arrays(
                [part.lang_of(place), part.text_of(place, 1), pa.array(part.hashes[place].view(np.int64)), pa.array(total)],
                ["lang", "phrase", "hash", "a"],
            )

    counted = map_arrow(chunks, count, "lang string, phrase string, hash long, a long")
    return stored(counted.groupBy("lang", "phrase", "hash").agg(F.sum("a").alias("a")), "words")


def frequent_pairs(chunks: DataFrame, words: tuple[bytes, int], lap: int, least: int) -> DataFrame:
    """Hashes of the pairs of known words that may occur `least` times."""
    known = chunks.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        for part in part_rows(batches, lap):
            met = among(known.value, part.hashes)
            places = np.flatnonzero(part.owned[:-1] & (part.left[:-1] > 1) & met[:-1] & met[1:])
            if len(places):
                hashes = part.pair_hashes()
                place, total = part.sums(paired(part.ids[:-1], part.ids[1:]), places)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[place].view(np.int64)), pa.array(total)], ["hash", "n"])

    counted = map_arrow(chunks, count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least).select("hash"), "pairs")


def phrase_counts(chunks: DataFrame, pairs: tuple[bytes, int], longest: int, least: int) -> DataFrame:
    """(lang, phrase, size, a) of the phrases of 2 to `longest` words that occur `least` times or more."""
    known = chunks.sparkSession.sparkContext.broadcast(pairs)

    def count(batches):
        for part in part_rows(batches, longest - 1):
            if len(part.at) < 2:
                continue
            met = among(known.value, part.pair_hashes())
            keys, whole = part.ids, np.ones(len(part.at), bool)
            for n in range(2, longest + 1):
                room = len(part.at) - n + 1
                if room < 1:
                    break
                # A run of n words is known by its first n - 1 and its last.
                whole = whole[:room] & met[n - 2 : n - 2 + room]
                keys = paired(keys[:room], part.ids[n - 1 :])
                places = np.flatnonzero(whole & part.owned[:room] & (part.left[:room] >= n))
                if not len(places):
                    continue
                place, total = part.sums(keys, places)
                yield pa.RecordBatch.from_arrays(
                    [part.lang_of(place), part.text_of(place, n), pa.array(np.full(len(place), n, np.int32)), pa.array(total)],
                    ["lang", "phrase", "size", "a"],
                )

    counted = map_arrow(chunks, count, "lang string, phrase string, size int, a long")
    total = counted.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))
    return stored(total.where(F.col("a") >= least), "phrases")


def wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = 4,
    least: int = 30,
    top: int = 2_000,
    scale: int = 2_000_000,
    cover: int = 80,
    modulus: int = 12,
) -> DataFrame:
    """The `top` phrases of each language by the association of their parts.

    A-Z is lower-cased, texts are split at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words `[^\\x20\\x09]+`.
    Candidates are runs of 2 to `longest` words of a piece that occur a >= `least` times, overlaps included.
    Cut after its first k words, a candidate has l and r, the occurrences of the parts, and the score
    floor(scale * a / (l + r)); the lowest score counts, then the smallest k. Candidates whose words lie inside
    a longer candidate that occurs in at least `cover` percent as often go, whether that one stays or not.

    Returns lang, rank, phrase, a, l, r, n (all words of the language), score, by score and a descending, then
    by the bytes of the phrase. A null lang is `und`; a null or empty text has no words; other columns play no
    part. Repeated rows count as often as they stand there. Empty tables, and languages without a candidate,
    give no rows. A word of any length is whole; products are decimals of 38 digits.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tongue = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    chunks = chunk_table(docs.select(tongue.alias("lang"), body.alias("text")), longest, modulus)
    words = word_counts(chunks, longest - 1)
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    common = words.where(F.col("a") >= least)
    pairs = frequent_pairs(chunks, bitmap_of(common.select("hash")), longest - 1, least)
    phrases = phrase_counts(chunks, bitmap_of(pairs), longest, least)

    known = common.select("lang", "phrase", "a").unionByName(phrases.select("lang", "phrase", "a"))
    split = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    split = split.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    split = split.withColumn("tail", F.expr("substring(phrase, char_length(head) + 2)"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    split = split.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    split = split.withColumn("both", wide(F.col("l")) + wide(F.col("r")))
    split = split.withColumn("share", wide(F.col("a")) * F.lit(scale).cast("decimal(10,0)"))
    cuts = split.withColumn("score", F.expr("share div both"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.*")

    word = F.split("phrase", " ")
    places = F.expr(
        f"flatten(transform(sequence(2, {longest - 1}), m -> "
        "transform(sequence(1, greatest(1, size - m + 1)), i -> array_join(slice(words, i, m), ' '))))"
    )
    within = phrases.where("size > 2").withColumn("words", word).withColumn("inner", F.explode(places))
    longer = within.where("inner <> phrase").groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("a").alias("most"))
    covered = wide(F.col("most")) * 100 >= wide(F.col("a")) * cover
    left = scored.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
