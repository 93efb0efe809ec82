"""Cutting the trie below choices of several blocks: no link is lost, and copies stay few."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapcredit.llm.components import connected_components
from snapcredit.llm.simhash import agreed_blocks, dealt_out, fingerprint_links


@pytest.fixture(scope="module")
def values():
    """Random fingerprints, and neighbours of some of them in one to six bits, high and low ones among them."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64) | (rng.integers(0, 2, 60, dtype=np.uint64) << np.uint64(63))
    out = list(base)
    for i, v in enumerate(base[:40]):
        for k in range(1, 7):
            bits = rng.choice(64, k, replace=False)
            out.append(v ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)))
    return np.unique(np.array(out, np.uint64))


def components(values, budget):
    root = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    for i, j in zip(*np.nonzero(near), strict=True):
        if root[i] != root[j]:
            root[root == root[i]] = root[j]
    groups = {}
    for v, r in zip(values.view(np.int64).tolist(), root.tolist(), strict=True):
        groups.setdefault(r, set()).add(v)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("agreed", [1, 2, 3, 4])
@pytest.mark.parametrize("subtree", [1_024, 3])
def test_links(spark, values, agreed, subtree):
    fps = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "fp long")
    stars = connected_components(fingerprint_links(fps, 4, subtree, agreed), "a", "b").collect()
    groups = {v: {v} for v in values.view(np.int64).tolist()}
    for r in stars:
        groups[r.root].add(r.node)
        groups.pop(r.node)
    assert {frozenset(g) for g in groups.values()} == components(values, 4)


def test_copies(spark):
    """20,000 fingerprints in one subtree of 13 bits: parts of it take 20 copies each in that block alone."""
    fps = spark.range(20_000).select((F.xxhash64("id").bitwiseAND(F.lit(-(1 << 13))) + 7).alias("fp"))
    assert dealt_out(fps, 4, 1_024, 1).count() > 20 * 20_000
    assert dealt_out(fps, 4, 1_024, 2).count() < 16 * 20_000


def test_blocks_follow_the_number():
    assert [agreed_blocks(n, 4, 1_024) for n in (0, 10**6, 10**7, 10**9, 10**11, 10**14)] == [1, 1, 2, 2, 3, 4]
