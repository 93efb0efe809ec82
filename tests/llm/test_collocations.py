"""Collocations against a plain count of all phrases, and the parse against its own rules."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from snapcredit.llm import collocations as module
from snapcredit.llm.collocations import bitmap_of, collocations, parse

SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def brute(rows, longest, least, top, cover):
    f = defaultdict(Counter)
    for lang, text in rows:
        for w in pieces_of(text):
            for n in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        size = sum(c for p, c in counts.items() if len(p) == 1)
        known = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in known.items():
            for m in range(2, len(p)):
                gone |= {q for i in range(len(p) - m + 1) if 100 * a >= cover * known[q := p[i : i + m]]}
        scored = []
        for p, a in known.items():
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), p, counts[p[:k]], counts[p[k:]]))
        left = sorted(x for x in scored if x[3] not in gone)[:top]
        out += [(lang, i, " ".join(x[3]), -x[1], x[4], x[5], size, -x[0]) for i, x in enumerate(left, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows(hostile_rows):
    more = [
        ("de", "New York City. new york city, New York; york new"),
        ("de", "a b a b a b a b\ta  b\na b. a"),
        (None, "new york " * 40),
        ("und", "new york! new york"),
        ("fr", "été été été été . Été ß\r日本 日本 日本"),
        ("fr", "été été été été . Été ß\r日本 日本 日本"),
        (None, None),
        ("fr", ""),
        ("fr", "... ,,, \n"),
    ]
    return [("en", t) for _, t in hostile_rows] + more


@pytest.mark.parametrize("modulus", [1, 3, 12, 10**9])
@pytest.mark.parametrize("longest, least, top, cover", [(4, 2, 50, 80), (4, 3, 2_000, 50), (3, 2, 2_000, 100), (2, 4, 7, 80)])
def test_collocations(spark, rows, modulus, longest, least, top, cover):
    wide = [(*r, 1, "x", 2, 3) for r in rows]
    docs = spark.createDataFrame(wide, "lang string, text string, rank int, phrase string, a int, n int").repartition(3)
    done = collocations(docs, longest=longest, least=least, top=top, cover=cover, modulus=modulus)
    assert sorted(map(tuple, done.collect())) == brute(rows, longest, least, top, cover)


def test_full_bitmap_and_small_parts(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(module, "LEAST_BITS", 4)
    monkeypatch.setattr(module, "MOST_BITS", 4)
    monkeypatch.setattr(module, "PART", 1)
    assert sorted(map(tuple, collocations(docs, least=2).collect())) == brute(rows, 4, 2, 2_000, 80)


def test_no_rows(spark, no_rows):
    assert collocations(no_rows).count() == 0
    assert collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts near 2 ** 62, as a corpus of many such texts would give them."""
    docs = spark.createDataFrame([("en", "big deal")], "lang string, text string")
    chunk_table = module.chunk_table
    many = 1 << 60
    monkeypatch.setattr(
        module, "chunk_table", lambda *args: chunk_table(*args).selectExpr("lang", "chunk", "last", f"n * {many} as n")
    )
    row = collocations(docs).collect()
    assert [tuple(r) for r in row] == [("en", 1, "big deal", many, many, many, 2 * many, 1_000_000)]


@pytest.mark.parametrize("modulus", [1, 2, 12])
def test_parse(modulus):
    texts = ["A b c d e f g h, i j k l m n o p q r s t u v w x y z" * 3, "", "one", "one two three four five\nsix"]
    raw = [t.encode() for t in texts]
    words, start, length, owner, last = parse(
        np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]), 4, modulus
    )
    chunks = [words[s : s + n].tobytes().decode().split(" ") for s, n in zip(start, length, strict=True)]
    rebuilt, piece = [], []
    for chunk, end in zip(chunks, last, strict=True):
        piece += chunk if end else chunk[:-3]
        if end:
            rebuilt.append(piece)
            piece = []
    assert rebuilt == [p for t in texts for p in pieces_of(t)]
    assert owner.tolist() == sorted(owner.tolist())


def test_long_text(spark):
    """Megabytes of one sentence, and one word of a megabyte."""
    text = "the cat sat on the mat " * 100_000 + "x" * 1_000_000
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    assert sorted(map(tuple, collocations(docs).collect())) == brute([("en", text)], 4, 30, 2_000, 80)


def test_bitmap_size(spark):
    assert bitmap_of(spark.range(1_000_000).selectExpr("xxhash64(id) as hash"))[1] == 24
