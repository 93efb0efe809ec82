"""Vectorised hashes of sliding windows, and the content-chosen anchors that cut a sequence into segments.

Both repeat finders of this package rest on one fact: if every window of `window` symbols picks its
anchor by content alone (the leftmost smallest hash of the `gram`-symbol strings inside it), two equal
windows pick equal anchors at equal offsets. Neighbouring windows mostly share an anchor; a maximal run
of windows with one anchor is a *segment*. Equal windows therefore lie in segments with equal anchors,
so strings only have to be compared inside groups of segments with one anchor, and there is one
segment per (window - gram) / 2 symbols instead of one record per symbol.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
# Odd multipliers of the polynomial hashes, and the constants of the 64-bit finaliser (public splitmix64).
BASE_A = U64(0x9E3779B97F4A7C15)
BASE_B = U64(0xD1342543DE82EF95)
HIGH, LOW = U64(0xFFFFFFFF00000000), U64(0xFFFFFFFF)
MIX_1 = U64(0xBF58476D1CE4E5B9)
MIX_2 = U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over the whole word."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def symbol_codes(seed: int) -> np.ndarray:
    """A 64-bit code for each byte value."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U64) * BASE_A + U64(seed))


BYTE_CODES = symbol_codes(7)


def window_hashes(codes: np.ndarray, length: int, base: np.uint64 = BASE_A) -> np.ndarray:
    """Hash of `codes[i:i + length]` for each i, by doubling: log2(length) passes."""
    if len(codes) < length:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        power, span, step = codes, 1, base  # power: hashes of `span` symbols; step: base ** span
        out, done = None, 0
        rest = length
        while rest:
            if rest & 1:
                if out is None:
                    out, done, factor = power, span, step
                else:
                    size = len(codes) - done - span + 1
                    out = out[:size] + power[done : done + size] * factor
                    done, factor = done + span, factor * step
            rest >>= 1
            if rest:
                size = len(power) - span
                power = power[:size] + power[span : span + size] * step
                span, step = span * 2, step * step
        return mix(out)


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost value in `values[i:i + width]` with the smallest high half, for each i."""
    # The index stands in the low half, so a plain minimum finds the value and, of equal ones, the first.
    best = (values & HIGH) | np.arange(len(values), dtype=U64)
    count, span = len(values) - width + 1, 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    shift = width - span
    best = np.minimum(best[:count], best[shift : shift + count])
    return (best & LOW).astype(np.int64)


def segments(
    codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of the sequences laid end to end in `codes`.

    Returns the first window of each segment (an index into `codes`), its number of windows, the hash of
    its anchor and the index of its sequence. Sequences shorter than a window have none.
    """
    first, n, place, grams, owner = _anchored(codes, starts, lengths, window, gram)
    return first, n, grams[place], owner


def _anchored(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int, gram: int):
    """First window and number of windows of each segment, the place of its anchor, all hashes of anchors, its sequence."""
    none = np.empty(0, np.int64)
    if len(codes) < window:
        return none, none, none, np.empty(0, U64), none
    grams = window_hashes(codes, gram)
    anchor = leftmost_minimum(grams, window - gram + 1)
    owner = np.repeat(np.arange(len(starts)), lengths)
    inside = owner[: len(anchor)] == owner[window - 1 : window - 1 + len(anchor)]
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1])
    first = np.flatnonzero(fresh & inside)
    # A run ends at the next fresh window or at the first window that leaves its sequence.
    ends = np.flatnonzero(fresh | ~inside)
    following = np.searchsorted(ends, first, "right")
    stop = np.append(ends, len(anchor))[following]
    return first, stop - first, anchor[first], grams, owner[first]


def halves(
    codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Segments in two parts, each with a longer string that all its windows hold.

    A window reaches at least half of `window - gram` symbols, rounded up, beyond its anchor on one side.
    Windows that do so to the left hold the anchor with that many symbols before it, the others with as
    many after it. Equal windows fall on the same side, so a repeated window has a repeated string of
    that length, which by chance repeats far more seldom than the anchor.

    Returns the first window and number of windows of each part, the start of its string, its sequence,
    and the length of the strings.
    """
    first, n, place, _, owner = _anchored(codes, starts, lengths, window, gram)
    reach = (window - gram + 1) // 2
    stop, middle = first + n, place - reach + 1  # windows from `middle` on reach to the right
    left = np.clip(middle, first, stop)
    parts = [(first, left - first, place - reach), (left, stop - left, place)]
    begin, count, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    some = np.flatnonzero(count > 0)
    some = some[np.argsort(begin[some], kind="stable")]
    return begin[some], count[some], at[some], np.concatenate([owner, owner])[some], gram + reach


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), kept and grown by doubling."""
    table = _TABLES.get(base)
    if table is None or len(table) < count:
        size = max(1 << 16, 1 << count.bit_length())
        with np.errstate(over="ignore"):
            table = np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, base, U64)]), dtype=U64)
        _TABLES[base] = table
    return table[:count]


class PrefixHash:
    """Hash of any stretch of `codes`, wherever it lies, in constant time."""

    def __init__(self, codes: np.ndarray, base: np.uint64 = BASE_B):
        self.inverse = _powers(pow(int(base), -1, 1 << 64), len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(codes * _powers(int(base), len(codes)), dtype=U64, out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            inner = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
            return mix(inner + length.astype(U64) * BASE_A)


# Blank bytes of the word pattern [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length, in bytes, of each word of a UTF-8 buffer."""
    edge = np.diff(np.concatenate([[True], BLANK[raw], [True]]).astype(np.int8))
    start = np.flatnonzero(edge == -1)
    return start, np.flatnonzero(edge == 1) - start


def word_codes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for each word of a UTF-8 buffer, and its first byte."""
    start, length = word_spans(raw)
    return PrefixHash(BYTE_CODES[raw]).of(start, length), start
