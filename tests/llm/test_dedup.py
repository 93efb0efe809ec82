"""Suffix-array, substring and SimHash dedup against brute force."""

import hashlib

import brute
import numpy as np
import pytest

from snapcredit.llm import queries, simhash
from snapcredit.llm.rolling import leftmost_minimum, segments, symbol_codes, window_hashes
from snapcredit.llm.substring_dedup import drop_repeated_windows
from snapcredit.llm.suffix_dedup import drop_repeated_strings, equal_suffixes


def sha(text):
    return hashlib.sha256(bytes(text) if not isinstance(text, str) else text.encode()).hexdigest()


def strings_of(df):
    return sorted(
        (str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), sha(r.kept)) for r in df.collect()
    )


@pytest.mark.parametrize("group", [1_000, 1])
@pytest.mark.parametrize(("length", "anchor"), [(200, 64), (40, 16)])
def test_repeated_strings(hostile, hostile_rows, group, length, anchor):
    """Group 1 deals out the suffixes of every anchor singly."""
    done = drop_repeated_strings(hostile, length=length, anchor=anchor, group=group, sketch_bits=20)
    expected = brute.repeated_strings(hostile_rows, length)
    assert strings_of(done) == sorted((str(d), *e) for (d, _), e in zip(hostile_rows, expected, strict=True))


@pytest.mark.parametrize("bits", [20, 6])
def test_repeated_windows(hostile, hostile_rows, bits):
    """A full sketch keeps more windows for the exact grouping and changes nothing."""
    done = drop_repeated_windows(hostile, sketch_bits=bits)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, sha(r.kept_text)) for r in done.collect())
    expected = brute.repeated_windows(hostile_rows)
    assert got == sorted((str(d), *e) for (d, _), e in zip(hostile_rows, expected, strict=True))


def test_components(hostile, hostile_rows):
    got = sorted((str(r.doc_id), f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(hostile).collect())
    expected = brute.components(hostile_rows)
    assert got == sorted((str(d), *e) for (d, _), e in zip(hostile_rows, expected, strict=True))


def test_keep_one(hostile, hostile_rows):
    kept = simhash.keep_one(hostile).collect()
    labels = {}
    for (doc, text), (print_, component) in zip(hostile_rows, brute.components(hostile_rows), strict=True):
        group = (component, print_ if component is None else None)
        labels.setdefault(group, []).append((doc is None, doc or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(min(v) for v in labels.values())
    assert kept[0].asDict().keys() == dict(hostile.dtypes).keys()


def test_empty_tables(no_rows):
    assert drop_repeated_strings(no_rows, sketch_bits=16).count() == 0
    assert drop_repeated_windows(no_rows, sketch_bits=16).count() == 0
    assert simhash.near_duplicates(no_rows).count() == 0
    assert simhash.keep_one(no_rows).count() == 0


def test_queries(spark, sf_dir, documents):
    rows = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op6_suffix_array_dedup"](spark, sf_dir).collect()}
    assert [rows[d] for d, _ in documents] == brute.repeated_strings(documents)
    rows = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op9_substring_dedup"](spark, sf_dir).collect()}
    assert [rows[d] for d, _ in documents] == brute.repeated_windows(documents)
    rows = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op10_simhash"](spark, sf_dir).collect()}
    assert [rows[d] for d, _ in documents] == brute.components(documents)


def test_equal_windows_lie_in_equal_segments():
    rng = np.random.default_rng(3)
    codes = symbol_codes(1)[rng.integers(0, 3, 4_000)]
    first, n, anchor, _ = segments(codes, np.array([0]), np.array([len(codes)]), 12, 5)
    assert n.sum() == len(codes) - 11 and (np.diff(first) == n[:-1]).all()
    of = np.repeat(anchor, n)
    whole = window_hashes(codes, 12)
    for value in np.unique(whole):
        assert len(set(of[whole == value])) == 1


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 9, 300).astype(np.uint64) << np.uint64(32)
    for width in (1, 2, 5, 8, 13):
        expected = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert leftmost_minimum(values, width).tolist() == expected


def test_multikey_sort():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    at = rng.permutation(len(data) - 20)[:400]
    keys = [bytes(data[i : i + 20]) for i in at]
    assert equal_suffixes(data, at, 20).tolist() == [keys.count(k) > 1 for k in keys]


@pytest.mark.parametrize("split", [False, True])
def test_trie_walk(split):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 30).astype(np.uint64)
    flips = [v ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, k))) for v in base for k in range(8)]
    value = np.unique(np.array(flips, np.uint64))
    part = (np.arange(len(value)) % 2 if split else np.zeros(len(value))).astype(int)
    order = np.lexsort((value, part))
    value, part = value[order], part[order]
    i, j = simhash.trie_pairs(np.zeros(len(value), int), part, value, 4)
    got = {frozenset(p) for p in zip(i.tolist(), j.tolist(), strict=True)}
    expected = {
        frozenset((a, b))
        for a in range(len(value))
        for b in range(a)
        if (int(value[a]) ^ int(value[b])).bit_count() <= 4 and (not split or part[a] != part[b])
    }
    assert got == expected and len(i) == len(expected)


def test_large_subtrees_are_split(spark):
    rng = np.random.default_rng(7)
    values = {int(x) for x in rng.integers(0, 1 << 12, 500)} | {1 << 40 | int(x) for x in rng.integers(0, 1 << 9, 60)}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    from snapcredit.llm.components import connected_components

    small, large = (
        {tuple(r) for r in connected_components(simhash.fingerprint_links(fps, 4, s), "a", "b").collect()}
        for s in (16, 4_096)
    )
    assert small == large


def test_components_of_a_path_and_a_star(spark):
    from snapcredit.llm.components import connected_components

    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
