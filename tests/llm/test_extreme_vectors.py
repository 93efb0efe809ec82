"""Nearest neighbours of vectors at the ends of the range of doubles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapcredit.llm.neighbours import nearest


def brute(rows, k):
    out = []
    for q, a in rows:
        measured = []
        for c, b in rows:
            if c != q:
                total = 0.0
                for x, y in zip(a, b, strict=True):
                    step = float(np.float64(x) - np.float64(y))
                    total += step * step if abs(step) < 1e300 or step == 0 else math.inf
                measured.append((math.sqrt(total), c))
        out += [(q, i, c, d) for i, (d, c) in enumerate(sorted(measured)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1e160, 1e307, 1e-160, 5e-324, 1.0])
def test_extreme_scales(spark, scale):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.rint(rng.normal(size=4) * 4) * scale]) for i in range(12)]
    rows = [(i, v) for i, v in rows if any(v) and all(map(math.isfinite, v))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with np.errstate(over="ignore"):
        expected = brute(rows, 3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(df, F.lit(True), k=3).collect())
    assert got == expected


def test_mixed_scales(spark):
    rows = [(0, [1e200, 0.0]), (1, [-1e200, 1.0]), (2, [1e-320, 0.0]), (3, [1.0, 2.0]), (4, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.lit(True), k=4).collect()
    assert len(got) == 20
    assert {(r.query_id, r.vec_id) for r in got if r.rank == 1 and r.query_id >= 2} == {(2, 3), (3, 4), (4, 3)}
