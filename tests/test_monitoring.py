import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapcredit.operators.drift import drift_report, ks_two_sample, population_moments, psi
from snapcredit.operators.evaluation import auc_exact, delayed_auc, gini_by_split
from snapcredit.operators.ranks import slice_cuts


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def numpy_psi(a, b, bins_a, bins_b):
    pa = np.histogram(a, bins_a)[0] / len(a)
    pb = np.histogram(b, bins_b)[0] / len(b)
    return float(np.sum((pa - pb) * np.log((pa + 1e-6) / (pb + 1e-6))))


def brute_ks(a, b):
    grid = sorted(set(a) | set(b))
    return max(abs(np.mean([v <= g for v in a]) - np.mean([v <= g for v in b])) for g in grid)


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(3)
    # a third of one side is a single value
    a = [round(rng.gauss(0, 1), 1) if i % 3 else 0.5 for i in range(400)]
    b = [round(rng.gauss(0.3, 1.5), 1) for _ in range(300)]
    return a, b


def test_psi_against_numpy(spark, samples):
    a, b = samples
    own = psi(column(spark, a), column(spark, b), ["x"], bins="own").first().psi
    assert own == pytest.approx(numpy_psi(a, b, 10, 10))
    edges = np.histogram(a, 10)[1].copy()
    edges[0], edges[-1] = -np.inf, np.inf
    reference = psi(column(spark, a), column(spark, b), ["x"]).first().psi
    assert reference == pytest.approx(numpy_psi(a, b, edges, edges))


def test_pure_shift_and_constants(spark):
    # continuous values: none lies on a bucket edge, where the shift could round it over
    rng = random.Random(4)
    a = [rng.gauss(0, 1) for _ in range(200)]
    shifted = column(spark, [v + 8 for v in a])
    same = column(spark, a)
    assert psi(same, shifted, ["x"], bins="own").first().psi == pytest.approx(0, abs=1e-9)
    assert psi(same, shifted, ["x"]).first().psi > 1
    constant = column(spark, [2.0] * 5)
    for bins in ("own", "reference"):
        assert psi(constant, constant, ["x"], bins=bins).first().psi == 0
    assert ks_two_sample(constant, constant, ["x"]).first().ks == 0
    assert psi(same, same, ["x"]).first().psi == 0
    with pytest.raises(ValueError):
        psi(same, same, ["x"], bins="quantile")


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_ks_against_brute_force(spark, samples, slices):
    a, b = samples
    found = ks_two_sample(column(spark, a + [None]), column(spark, b + [float("nan")]), ["x"], slices)
    assert found.first().ks == pytest.approx(brute_ks(a, b), abs=1e-12)
    same = ks_two_sample(column(spark, a), column(spark, a), ["x"], slices)
    assert same.first().ks == 0


@pytest.mark.parametrize("bins", ["own", "reference"])
def test_report_equals_its_parts(spark, samples, bins):
    a, b = samples
    both = lambda v: spark.createDataFrame(
        [(x, x * x, None if i % 4 else x, int(x > 1)) for i, x in enumerate(v)],
        "x double, y double, z double, prediction int",
    )
    ref, cur, features = both(a), both(b), ["x", "y", "z"]
    report = {r.feature: r for r in drift_report(ref, cur, features, bins=bins).collect()}
    assert list(report["x"].asDict()) == [
        "feature", "psi", "ks", "mean_train", "mean_curr", "std_train", "std_curr", "label_ratio",
    ]
    for r in psi(ref, cur, features, bins=bins).collect():
        assert report[r.feature].psi == pytest.approx(r.psi)
    for r in ks_two_sample(ref, cur, features).collect():
        assert report[r.feature].ks == pytest.approx(r.ks)
    for r in population_moments(ref, cur, features).collect():
        assert report[r.feature].mean_curr == pytest.approx(r.mean_curr)
        assert report[r.feature].std_train == pytest.approx(r.std_train)
    assert report["x"].std_train == pytest.approx(np.std(a))
    assert report["x"].label_ratio == pytest.approx(np.mean([v > 1 for v in b]))


def scores(spark, rows):
    return spark.createDataFrame(rows, "split string, score double, label int")


def brute_auc(rows):
    pos = [s for _, s, y in rows if y == 1]
    neg = [s for _, s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("slices", [1, 4, 40])
def test_auc_against_pairs(spark, slices):
    rng = random.Random(9)
    rows = [
        (rng.choice("ab"), 0.5 if i % 3 == 0 else round(rng.random(), 2), int(rng.random() < 0.3))
        for i in range(300)
    ]
    df = scores(spark, rows)
    assert auc_exact(df, "score", slices=slices).first().auc == pytest.approx(brute_auc(rows))
    by = {r.split: r.auc for r in auc_exact(df, "score", by=["split"], slices=slices).collect()}
    assert by == {s: pytest.approx(brute_auc([r for r in rows if r[0] == s])) for s in "ab"}
    flipped = scores(spark, [(s, -v, y) for s, v, y in rows])
    assert auc_exact(flipped, "score").first().auc == pytest.approx(1 - brute_auc(rows))


def test_auc_edge_cases(spark):
    one_class = scores(spark, [("a", 0.1, 1), ("a", 0.2, 1)])
    row = auc_exact(one_class, "score").first()
    assert (row.auc, row.n_pos, row.n_neg) == (None, 2, 0)
    empty = auc_exact(one_class.where("false"), "score").first()
    assert (empty.auc, empty.n_pos, empty.n_neg) == (None, 0, 0)
    perfect = scores(spark, [("a", 0.1, 0), ("a", 0.2, 1)])
    assert gini_by_split(perfect, "score").first().gini == 1.0


def test_delayed_auc(spark):
    d = dt.date
    predictions = spark.createDataFrame(
        [(c, m, s) for m in (d(2023, 1, 1), d(2023, 2, 1)) for c, s in (("a", 0.9), ("b", 0.1))],
        "Customer_ID string, snapshot_date date, score double",
    )
    labels = spark.createDataFrame(
        [("a", d(2023, 7, 1), 1), ("b", d(2023, 7, 1), 0)],
        "Customer_ID string, snapshot_date date, label int",
    )
    assert [tuple(r) for r in delayed_auc(predictions, labels, "score").collect()] == [
        (d(2023, 1, 1), 1.0, 1, 1)
    ]


def test_slices_grow_with_the_rows(spark):
    df = spark.range(20_000).selectExpr("cast(id % 5000 as double) as x")
    assert len(slice_cuts(df, ["x"], 20_000)["x"]) == 7
    cuts = slice_cuts(df, ["x"], 20_000, slices=10)["x"]
    assert len(cuts) == 9
    for i, cut in enumerate(cuts, 1):
        assert cut / 5000 == pytest.approx(i / 10, abs=0.03)
    # as for four billion rows: a sample, still balanced
    many = slice_cuts(df, ["x"], 4_000_000_000)["x"]
    assert many == [0.0] or len(many) <= 4_000


def test_many_slices(spark):
    df = spark.range(5_000).selectExpr("cast(id as double) as x", "cast(id % 3 = 0 as int) as label")
    few, many = (auc_exact(df, "x", slices=n).first().auc for n in (1, 2_000))
    assert few == pytest.approx(many)


def test_values_that_are_not_finite_are_left_out(spark):
    rng = random.Random(8)
    a, b = [rng.gauss(0, 1) for _ in range(100)], [rng.gauss(2, 1) for _ in range(100)]
    odd = [float("nan"), float("inf"), float("-inf"), None]
    for slices in (None, 5):
        plain = drift_report(column(spark, a), column(spark, b), ["x"], None, slices=slices).first()
        dirty = drift_report(column(spark, a + odd), column(spark, odd + b), ["x"], None, slices=slices).first()
        assert dirty.asDict() == pytest.approx(plain.asDict())
        assert plain.psi > 1
    assert psi(column(spark, a + odd), column(spark, b), ["x"]).first().psi == pytest.approx(plain.psi)


def test_a_side_without_values(spark):
    some, none = column(spark, [1.0, 2.0]), column(spark, [None, float("nan")])
    empty = some.limit(0)
    for side in (none, empty):
        report = drift_report(some, side, ["x"], None).first()
        assert report.psi is None and report.ks is None and report.mean_curr is None and report.mean_train == 1.5
    assert drift_report(none, none, ["x"], None).first().psi is None
    ratio = drift_report(some.withColumn("prediction", F.lit(1)), empty.withColumn("prediction", F.lit(1)), ["x"]).first()
    assert ratio.label_ratio == 0
