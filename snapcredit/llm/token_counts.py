"""Token counts of the sections of documents, from one encoding of each whole document."""

from __future__ import annotations

import struct
from array import array
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.bpe import BYTE_PATTERN, CACHE, Cache, LoadVocabulary, PrefixEncoder, Vocabulary
from snapcredit.llm.common import map_arrow, text_chunks
from snapcredit.llm.word_runs import spread

#: How a token that crosses a boundary is allocated.
RULES = ("majority", "first", "last")


class PieceTable(dict):
    """Numbers of pieces, given on demand, and tables by number: characters, tokens, place of the first token;
    and by place: first character and that after the last of a token."""

    def __init__(self, pieces: Cache):
        super().__init__()
        self.pieces = pieces
        self.columns = tuple(array("i") for _ in range(5))

    def __missing__(self, piece: str) -> int:
        size, start, end = self.pieces[piece]
        sizes, counts, firsts, starts, ends = self.columns
        firsts.append(len(starts))
        sizes.append(size)
        counts.append(len(start) // 4)
        starts.frombytes(start)
        ends.frombytes(end)
        self[piece] = number = len(sizes) - 1
        return number


class OffsetTokenizer:
    """Byte-level encoding of whole texts, with the characters each token covers."""

    def __init__(self, vocabulary: Vocabulary):
        self.encoder = PrefixEncoder(vocabulary)
        self.split = regex.compile(BYTE_PATTERN).findall
        self.pieces = Cache(self._piece)
        self.table = PieceTable(self.pieces)
        self.sizes = {i: len(s) for i, s in self.encoder.spelled.items()}

    def _piece(self, piece: str) -> tuple[int, bytes, bytes]:
        """Characters of a piece, and the first character and that after the last of each token."""
        data = piece.encode()
        sizes = [self.sizes[i] for i in self.encoder.encode(data)]
        if len(data) == len(piece):  # a byte is a character
            ends = list(accumulate(sizes))
            form = f"<{len(ends)}i"
            return len(piece), struct.pack(form, 0, *ends[:-1]), struct.pack(form, *ends)
        sizes = np.array(sizes)
        ends = np.cumsum(sizes)
        # A token may begin or end inside a character: it covers each character it has a byte of.
        char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        return len(piece), char[ends - sizes].astype("<i4").tobytes(), (char[ends - 1] + 1).astype("<i4").tobytes()

    def chunk_offsets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts laid end to end: each piece is looked up once, tokens are taken from tables."""
        if len(self.table) >= CACHE:
            self.table = PieceTable(self.pieces)
        table, split = self.table, self.split
        found = [piece for text in texts for piece in split(text)]
        ids = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
        sizes, counts, firsts, starts, ends = (np.frombuffer(x, np.int32) for x in table.columns)
        sizes, counts = sizes[ids], counts[ids]
        base = np.repeat(np.cumsum(sizes, dtype=np.int64) - sizes, counts)
        at = spread(firsts[ids].astype(np.int64), counts)
        return base + starts[at], base + ends[at]

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and that after the last of each token of a text."""
        found = [self.pieces[piece] for piece in self.split(text)]
        sizes = np.array([f[0] for f in found], np.int64)
        counts = np.array([len(f[1]) // 4 for f in found], np.int64)
        base = np.repeat(np.cumsum(sizes) - sizes, counts)
        start, end = (np.frombuffer(b"".join(f[k] for f in found), "<i4") for k in (1, 2))
        return base + start, base + end


def allocate(start: np.ndarray, end: np.ndarray, cuts: np.ndarray, rule: str) -> np.ndarray:
    """Section of each token: sections are the stretches between neighbouring cuts, which cover the text.

    A token inside a section is its own. One that crosses a boundary goes, by `rule`, to the section with
    the majority of its characters, of equal ones the first, or to the section of its first or last
    character.
    """
    first = np.searchsorted(cuts, start, "right") - 1
    last = np.searchsorted(cuts, end - 1, "right") - 1
    if rule == "first":
        return first
    if rule == "last":
        return last
    out = first.copy()
    two = np.flatnonzero(last == first + 1)
    edge = cuts[last[two]]
    out[two] += end[two] - edge > edge - start[two]
    for i in np.flatnonzero(last > first + 1):
        edges = np.concatenate([[start[i]], cuts[first[i] + 1 : last[i] + 1], [end[i]]])
        out[i] = first[i] + int(np.argmax(np.diff(edges)))
    return out


@lru_cache(maxsize=2)
def _tokenizer(key: str, load: LoadVocabulary) -> OffsetTokenizer:
    return OffsetTokenizer(load())


def section_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    separator: str = "\n",
    rule: str = "majority",
) -> DataFrame:
    """Tokens of each section of each text under a byte-level vocabulary.

    A section ends behind each separator and at the end of the text, so sections cover the text. The
    whole text is encoded once; each token is joined to the sections its characters lie in and counts in
    one of them (`allocate`), so the counts of a text add up to its tokens.

    Returns doc_id, section (from 0), first_char, n_chars, n_tokens and n_crossing (tokens counted in
    the section that cross one of its boundaries). Null and empty texts have one empty section without
    tokens; repeated rows are counted again; other columns are not carried.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(vocabulary_path))
    load = LoadVocabulary(sent)

    def count(batches):
        tokenizer = _tokenizer(vocabulary_path, load)
        for batch, _, _ in text_chunks(batches):
            bodies = batch.column("text").to_pylist()
            lists = [[len(s) + len(separator) for s in body.split(separator)] for body in bodies]
            for sizes in lists:
                sizes[-1] -= len(separator)
                if len(sizes) > 1 and not sizes[-1]:  # nothing behind the last separator
                    sizes.pop()
            n = np.array([len(sizes) for sizes in lists])
            sizes = np.fromiter((x for own in lists for x in own), np.int64, n.sum())
            cuts = np.cumsum(sizes) - sizes  # in the texts laid end to end
            start, end = tokenizer.chunk_offsets(bodies)
            section = allocate(start, end, cuts, rule)
            over = (start < cuts[section]) | (end > (cuts + sizes)[section])
            counts = (np.bincount(x, minlength=len(cuts)) for x in (section, section[over]))
            head = np.repeat(np.cumsum(n) - n, n)  # the first section of each text
            number = np.arange(len(cuts)) - head
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))),
                    *(pa.array(c, pa.int64()) for c in (number, cuts - cuts[head], sizes, *counts)),
                ],
                ["doc_id", "section", "first_char", "n_chars", "n_tokens", "n_crossing"],
            )

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, section long, first_char long, n_chars long, n_tokens long, n_crossing long"
    return map_arrow(texts, count, schema)
