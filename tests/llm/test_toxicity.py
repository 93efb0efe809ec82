"""The chain against sums over all labellings, the tagger on planted words, and accuracy on held-out rows."""

import itertools
import zlib

import numpy as np
import pytest

from snapcredit.llm import toxicity as module
from snapcredit.llm.chain import BLOCK, marginals
from snapcredit.llm.queries import QUERIES
from snapcredit.llm.toxicity import fit, tagged, toxicity


@pytest.mark.parametrize("seed", range(4))
def test_chain(seed):
    rng = np.random.default_rng(seed)
    sizes = [*rng.integers(1, 9, 12), 1, 10]
    starts = np.cumsum([0, *sizes[:-1]])
    e, trans, start = rng.normal(size=sum(sizes)) * 3, rng.normal(size=(2, 2)), 0.7
    first = np.zeros(len(e), bool)
    first[starts] = True
    got, pairs = marginals(e, first, start, trans)
    expected = np.zeros((2, 2))
    for s, n in zip(starts, sizes, strict=True):
        total, ones, seen = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            inner = sum(trans[a, b] for a, b in itertools.pairwise(y))
            weight = np.exp(start * y[0] + inner + np.dot(e[s : s + n], y))
            total, ones = total + weight, ones + weight * np.array(y)
            for a, b in itertools.pairwise(y):
                seen[a, b] += weight
        assert np.allclose(got[s : s + n], ones / total)
        expected += seen / total
    assert np.allclose(pairs, expected)


def test_chain_over_blocks():
    """One chain over many blocks, against a plain recursion."""
    rng = np.random.default_rng(5)
    n = 5 * BLOCK + 17
    e, trans = rng.normal(size=n) * 8, rng.normal(size=(2, 2)) * 2
    pair, weight = np.exp(trans), np.stack([np.ones(n), np.exp(e)], axis=1)
    forward, backward = np.empty((n, 2)), np.ones((n, 2))
    forward[0] = weight[0] * [1, np.exp(-1)]
    for t in range(1, n):
        forward[t] = forward[t - 1] @ pair * weight[t]
        forward[t] /= forward[t].sum()
    for t in range(n - 2, -1, -1):
        backward[t] = pair @ (weight[t + 1] * backward[t + 1])
        backward[t] /= backward[t].sum()
    both = forward * backward
    first = np.zeros(n, bool)
    first[0] = True
    assert np.allclose(marginals(e, first, -1.0, trans)[0], (both / both.sum(axis=1, keepdims=True))[:, 1])


def planted(n=400, seed=0):
    """(doc_id, text, toxic): toxic texts hold made-up words with one stem, also ones that are met once."""
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("abdefghiklmnoprstu"), 6)) for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(15, 60))))
        toxic = int(i % 4 == 0)
        for _ in range(2 * toxic):
            words.insert(int(rng.integers(len(words) + 1)), "zqörk" + "".join(rng.choice(list("abcdefgh"), 3)))
        rows.append((i, " ".join(words).capitalize() + ".", toxic))
    return rows


def test_planted_words(spark, hostile_rows):
    rows = planted()
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    extra = [(10_000 + i, t) for i, (_, t) in enumerate(hostile_rows)] + [(None, None), (None, "zqörkabc zqörkdef"), (5, "again")]
    docs = spark.createDataFrame([(*r, 0.5, "x", True) for r in [*((d, t) for d, t, _ in rows), *extra]],
                                 "doc_id long, text string, score double, spans string, toxic boolean").repartition(3)
    done = toxicity(docs, labels).collect()
    assert len(done) == len(rows) + len(extra)
    truth, by_id = {d: y for d, _, y in rows}, {}
    for r in done:
        by_id.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 3 == 1)
    held = [(truth[d], by_id[d][0].predicted) for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([y == p for y, p in held]) > 0.97
    for d, text, y in rows:
        if y and by_id[d][0].predicted:
            found = [text[s.start : s.end].lower() for s in by_id[d][0].spans]
            assert found and all("zqörk" in x for x in found)
    assert [r.predicted for r in sorted(by_id[None], key=lambda r: r.score)] == [0, 1]
    assert {r.predicted for d, x in by_id.items() if d and d >= 10_000 for r in x} == {0}


def test_labels_do_not_leak(spark):
    """Labels of held-out rows change nothing."""
    rows = planted(120)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y) for d, _, y in rows]
    both = [spark.createDataFrame(x, "doc_id long, toxic int") for x in ([(d, y) for d, _, y in rows], turned)]
    a, b = (sorted(map(str, toxicity(docs, x).collect())) for x in both)
    assert a == b


def test_labels_of_every_kind(spark, no_rows):
    docs = spark.createDataFrame([(0, "a"), (0, "a"), (2, None), (3, "")], "doc_id long, text string")
    for labels in ([], [(0, 0)], [(0, 1)], [(0, 0), (0, 1), (2, None), (3, 7), (None, 1)]):
        done = toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert {r.predicted for r in done} == {int(labels == [(0, 1)])} and len(done) == 4
    assert toxicity(no_rows, spark.createDataFrame([(0, 1)], "doc_id long, toxic int")).count() == 0


def test_sample_is_bounded(spark):
    rows = planted(400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    texts, toxic, share = module.training_sample(docs, labels, 8_000, 10_000)
    assert sum(map(len, texts)) < 24_000 and len(texts) < 150 and toxic.any() and share.min() > 1


def test_long_text():
    rows = planted(200)
    model = fit([t.encode() for _, t, _ in rows], np.array([y == 1 for _, _, y in rows]), np.ones(len(rows)))
    text = "quiet é words " * 300_000 + "Zqörkabc" + " and more" * 100_000
    raw = np.frombuffer(text.encode(), np.uint8)
    score, start, end, owner = tagged(model, raw, np.array([len(raw)]))
    assert [raw[s:e].tobytes().decode() for s, e in zip(start, end, strict=True)] == ["Zqörkabc"] and owner.tolist() == [0]
    assert 0 <= score[0] <= 1


def test_held_out_rows(spark):
    """At sf0.1: held-out precision and recall of the query (some labels there have no toxic word)."""
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op11_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.9 and hits / sum(r.toxic for r in rows) > 0.75
