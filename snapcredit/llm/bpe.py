"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import map_arrow, text_chunks

#: Entries of a generation of a task's caches; a full one costs time, never results.
CACHE = 250_000
#: Offset of the symbol of a byte that ends a word.
LAST = 256

#: The split patterns of the two kinds of vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def printable_bytes() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones as they are, the
    others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs of a tokenizer file: ids of tokens, merges in order, word suffix, added tokens."""

    tokens: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    added: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(model["vocab"], merges, model.get("end_of_word_suffix") or "", added)


class PrefixEncoder:
    """Ids of a word, found by the last token of each of its prefixes.

    The encoding of a prefix ends in one token only, and two neighbours stand in an encoding exactly if
    they stay apart when encoded together. So the last token of a prefix is the one vocabulary entry that
    ends there and is compatible with the last token of what is before it; an automaton over the
    vocabulary lists the entries that end at each place. Back-pointers then give the ids.
    """

    def __init__(self, vocabulary: Vocabulary):
        byte = printable_bytes()
        self.suffix = vocabulary.suffix

        def symbols(token: str) -> str | None:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            if not body or any(c not in byte for c in body):
                return None
            out = "".join(chr(byte[c]) for c in body)
            return out[:-1] + chr(ord(out[-1]) + LAST) if ends else out

        #: For each token its symbols, the rank of the merge that makes it (-1: a symbol) and its halves.
        self.spelled = {i: s for t, i in vocabulary.tokens.items() if (s := symbols(t)) is not None}
        self.written = {i: t for t, i in vocabulary.tokens.items()} | {i: t for t, i in vocabulary.added.items()}
        self.rank = {i: -1 for i in self.spelled}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[int, int] = {}
        for rank, (a, b) in enumerate(vocabulary.merges):
            whole = vocabulary.tokens[a + b] if not self._suffixed(a) else None
            if whole is None or whole in self.halves:
                raise ValueError("the vocabulary makes one token in two ways")
            pair = vocabulary.tokens[a], vocabulary.tokens[b]
            self.rank[whole], self.halves[whole], self.joined[pair[0] << 20 | pair[1]] = rank, pair, rank
        self.known: dict[int, bool] = {}
        automaton = ahocorasick.Automaton()
        usable: set[int] = set()
        for token in sorted(self.spelled, key=self.rank.get):
            # A token that its own symbols are not encoded as never appears.
            if token not in self.halves:
                fine = len(self.spelled[token]) == 1
            else:
                a, b = self.halves[token]
                fine = a in usable and b in usable and self._stay_apart(a, b)
            if fine:
                usable.add(token)
                automaton.add_word(self.spelled[token], (token, len(self.spelled[token])))
        automaton.make_automaton()
        self.matches = automaton.iter

    def _suffixed(self, token: str) -> bool:
        return bool(self.suffix) and token.endswith(self.suffix)

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary of a and b, apart from one of a and b themselves."""
        # Undo the merges of both sides from the last one back. What stands at the boundary then is a part
        # of each side, alive until its side's next merge; a merge of two parts alive together would have
        # crossed. Equal merges go from left to right: that of the left side before the crossing one, and
        # the crossing one before that of the right side.
        rank, halves, joined = self.rank, self.halves, self.joined
        a_until = b_until = len(joined)
        while True:
            if rank[a] > rank[b]:
                a_until, a = rank[a], halves[a][1]
            elif b in halves:
                b_until, b = rank[b], halves[b][0]
            else:
                return True
            made = joined.get(a << 20 | b)
            if made is not None and made < a_until and made <= b_until:
                return False

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.known.get(key)
        if known is None:
            if len(self.known) > 4 * CACHE:
                self.known.clear()
            known = self.known[key] = key not in self.joined and self._stay_apart(a, b)
        return known

    def encode(self, word: bytes) -> list[int]:
        """Ids of the bytes of one piece of the split."""
        text = word.decode("latin-1")
        if self.suffix:
            text = text[:-1] + chr(word[-1] + LAST)
        last = [-1] * len(text)
        size = [0] * len(text)
        known, compatible = self.known.get, self.compatible
        for end, (token, length) in self.matches(text):
            if last[end] < 0:
                before = end - length
                if before >= 0:
                    left = last[before]
                    if left < 0:
                        continue
                    fine = known(left << 20 | token)
                    if fine is None:
                        fine = compatible(left, token)
                    if not fine:
                        continue
                last[end], size[end] = token, length
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids


class Cache(dict):
    """Results by key, made on demand. When full, only what was asked for since the last time it was full
    is kept at hand: the rest is made again if it comes up."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make
        self.older: dict = {}

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordTokenizer:
    """Encoding of whole texts with a word vocabulary: NFC, lower case, blanks dropped."""

    def __init__(self, vocabulary: Vocabulary):
        self.encoder = PrefixEncoder(vocabulary)
        self.split = regex.compile(WORD_PATTERN).findall
        self.pieces = Cache(lambda piece: self._render(self.encoder.encode(piece.encode())))
        self.words = Cache(self._word)
        self.added = {t: self._render([i]) for t, i in vocabulary.added.items()}
        names = "|".join(re.escape(t) for t in sorted(vocabulary.added, key=len, reverse=True))
        self.special = re.compile(f"({names})") if names else None
        self.blanks = regex.compile(r"\p{White_Space}+").split

    def _render(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Ids as little-endian unsigned 32-bit integers, and their tokens with a blank between."""
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed, " ".join(map(self.encoder.written.__getitem__, ids)).encode()

    def _word(self, word: str) -> tuple[bytes, bytes]:
        if word.isascii():
            plain = word.lower()
            if plain.isalpha():
                return self.pieces[plain]
        else:
            # Lower case goes by single characters, so the sigma at the end of a word is like any other.
            plain = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        found = [self.pieces[piece] for piece in self.split(plain)]
        return found[0] if len(found) == 1 else (b"".join(x[0] for x in found), b" ".join(x[1] for x in found))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Packed ids and decoded text."""
        found: list[tuple[bytes, bytes]] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                found.append(self.added[part])
                continue
            # str.split also takes the separators U+001C to U+001F for blanks.
            separators = any(c in part for c in "\x1c\x1d\x1e\x1f")
            found += map(self.words.__getitem__, self.blanks(part) if separators else part.split())
        return b"".join(x[0] for x in found), b" ".join(x[1] for x in found if x[0])


class LoadVocabulary:
    """Reads the broadcast vocabulary; all loads count as one for the cache of a worker."""

    def __init__(self, sent):
        self.sent = sent

    def __call__(self) -> Vocabulary:
        return self.sent.value

    def __hash__(self) -> int:
        return 0

    def __eq__(self, other) -> bool:
        return isinstance(other, LoadVocabulary)


@lru_cache(maxsize=2)
def _tokenizer(key: str, load: LoadVocabulary) -> WordTokenizer:
    return WordTokenizer(load())


def encode_decode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text under a word vocabulary, and the text they decode to.

    The file is read on the driver and sent to the executors: its size is that of one vocabulary,
    whatever the documents. Added tokens in a text are encoded as themselves; ids are decoded to their
    tokens with a blank between, added ones included.

    Returns doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded (UTF-8) for each
    row. Null and empty texts have no ids; repeated rows are encoded alike; other columns are not carried.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(vocabulary_path))

    def encode(batches):
        tokenizer = _tokenizer(vocabulary_path, LoadVocabulary(sent))
        for batch, _, _ in text_chunks(batches):
            done = [tokenizer.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) // 4 for ids, _ in done], pa.int64()),
                    pa.array([ids for ids, _ in done], pa.binary()),
                    pa.array([text for _, text in done], pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts, encode, f"doc_id {id_type}, n_tokens long, ids binary, decoded binary")
