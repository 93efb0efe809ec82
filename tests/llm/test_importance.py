"""Importance resampling against a plain version, and its checksums against zlib."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from snapcredit.llm import importance
from snapcredit.llm.importance import chunk_features, resample, span_crcs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def features(text, low, high):
    words = WORD.findall((text or "").translate(SMALL))
    runs = [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def brute(docs, target, low, high, buckets, min_words, percent):
    found = [(d, *features(t, low, high)) for d, t in docs]
    s = Counter(c % buckets for _, _, f in found for c in f)
    t = Counter(c % buckets for x in target for c in features(x, low, high)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets))))
        for b in range(buckets)
    }
    rows = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % buckets] for c in f)
        rows.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    return rows, able[: percent * len(able) // 100]


def rows_of(df):
    return [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in df.collect()]


def same(a, b):
    return sorted(map(str, map(tuple, a))) == sorted(map(str, map(tuple, b)))


@pytest.mark.parametrize("low, high, buckets, percent", [(1, 1, 10_000, 10), (1, 2, 97, 60), (2, 3, 1_000, 100)])
def test_resample(spark, hostile, hostile_rows, low, high, buckets, percent):
    aim = ["alpha1 beta2 Gamma3 été", None, "", "x y x y", "été ß 日本"]
    target = spark.createDataFrame([(t, 1) for t in aim], "text string, score int")
    wide = hostile.selectExpr("*", "1 as rank", "2 as weight", "3 as tie", "4 as part", "5 as bucket", "6 as score")
    done = resample(wide, target, low=low, high=high, buckets=buckets, percent=percent, keep=["rank", "lang"]).cache()
    rows, drawn = brute(hostile_rows, aim, low, high, buckets, 20, percent)
    assert same(rows_of(done), rows)
    in_order = rows_of(done.where("rank is not null").orderBy("rank"))
    assert [r[4] for r in in_order] == [r[4] for r in drawn] and same(in_order, drawn)
    assert sorted(r.rank for r in done.where("rank is not null").collect()) == list(range(1, len(drawn) + 1))
    assert {tuple(r.kept) for r in done.collect()} == {(1, "en")}


def test_many_ranges(spark, hostile, monkeypatch):
    target = spark.createDataFrame([("alpha1",)], "text string")
    whole = rows_of(resample(hostile, target, percent=100).where("rank > 0").orderBy("rank"))
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 3)
    assert rows_of(resample(hostile, target, percent=100).where("rank > 0").orderBy("rank")) == whole


def test_no_rows(spark, hostile, no_rows):
    target = hostile.select("text")
    assert resample(no_rows, target).count() == 0
    assert resample(hostile, target.limit(0)).count() == hostile.count()


def test_checksums():
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 256, 300_000).astype(np.uint8)
    length = np.concatenate([rng.integers(1, 150, 400), [63, 64, 65, 127, 128, 129, 8_191, 250_000]])
    start = rng.integers(0, len(raw) - length)
    got = span_crcs(raw, start, length)
    assert [int(g) for g in got] == [zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(start, length, strict=True)]


def test_long_text():
    text = "Word é " * 400_000 + "z" * 3_000_000 + " end"
    raw = np.frombuffer(text.encode(), np.uint8)
    n, found, owner = chunk_features(raw, np.array([len(raw)]), 1, 1, 10_000)
    expected = [c % 10_000 for c in features(text, 1, 1)[1]]
    assert n.tolist() == [len(expected)] and found.tolist() == expected and not owner.any()
