"""Reports from value-count profiles, blocked correlations and append-only dictionaries."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapcredit.operators.aggregates import corr_matrix
from snapcredit.operators import correlations
from snapcredit.operators.correlations import corr_matrix_blocked
from snapcredit.operators.drift import drift_report
from snapcredit.operators.encoders import extend_dictionary, versioned_index
from snapcredit.operators.profiles import drift_of_profiles, value_profile
from snapcredit.sources.sinks import write_snapshots

D = dt.date
MONTHS = [D(2023, m, 1) for m in range(1, 7)]
SCHEMA = "snapshot_date date, a double, b int, c double, empty double, prediction int"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)

    def one(i):
        month = rng.choice(MONTHS)
        a = rng.choice([rng.gauss(0, 1), float("nan"), float("inf"), None, 1.0, 1.0])
        c = 4.0 if month.month < 4 else rng.random()
        return month, a, rng.choice([None, *range(6)]), c, None, rng.choice([0, 1, None])

    return spark.createDataFrame([one(i) for i in range(3_000)], SCHEMA).cache()


FEATURES = ["a", "b", "c", "empty"]


def close(x, y):
    return (x is None and y is None) or (x is not None and y is not None and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12))


@pytest.mark.parametrize("bins", ["reference", "own"])
@pytest.mark.parametrize("slices", [None, 3])
def test_report_of_profiles(spark, rows, tmp_path, bins, slices):
    path = str(tmp_path / "profiles")
    write_snapshots(value_profile(rows, FEATURES, prediction="prediction"), path)
    profiles = spark.read.parquet(path)
    for first, second in ((F.col("snapshot_date") < "2023-04-01", F.col("snapshot_date") >= "2023-05-01"),
                          (F.col("snapshot_date") == "2023-02-01", F.col("snapshot_date") == "2023-06-01"),
                          (F.col("snapshot_date") == "2023-02-01", F.col("snapshot_date") == "2030-01-01")):
        expected = {r.feature: r for r in drift_report(rows.where(first), rows.where(second), FEATURES, bins=bins).collect()}
        found = drift_of_profiles(profiles.where(first), profiles.where(second), FEATURES, bins=bins, slices=slices)
        got = {r.feature: r for r in found.collect()}
        assert set(got) == set(expected) == set(FEATURES)
        for f in FEATURES:
            assert all(close(got[f][k], v) for k, v in expected[f].asDict().items() if k != "feature"), (f, got[f], expected[f])


def test_profiles_add_up(rows):
    whole = value_profile(rows, FEATURES, by=())
    parts = value_profile(rows, FEATURES).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.select("feature", "value", "n").collect())) == sorted(map(tuple, parts.collect()))


def test_profiles_are_read_and_nothing_else(spark, rows, tmp_path):
    path = str(tmp_path / "profiles")
    write_snapshots(value_profile(rows, FEATURES), path)
    profiles = spark.read.parquet(path)
    report = drift_of_profiles(profiles.where("snapshot_date = '2023-02-01'"), profiles.where("snapshot_date = '2023-06-01'"), ["a"], False)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("profiles" in s and "PartitionFilters: [isnotnull(snapshot_date" in s for s in scans)
    assert "InMemoryTableScan" not in plan


def test_200_columns(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 20))
    wide = np.concatenate([base @ rng.normal(size=(20, 178)) + rng.normal(size=(400, 178)) + 1e6, base], axis=1)
    frame = pd.DataFrame(wide, columns=[f"x.{i}" for i in range(198)])
    frame[rng.random(frame.shape) < 0.1] = np.nan
    frame["constant"], frame["nothing"] = 7.0, np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`{c}` double" for c in frame.columns))
    expected = frame.corr(min_periods=2)
    got = {(r.x, r.y): r["corr"] for r in corr_matrix_blocked(df, list(frame.columns), block=90).collect()}
    assert len(got) == 40_000
    for (x, y), value in got.items():
        other = expected.at[x, y]
        assert (value is None and np.isnan(other)) or value == pytest.approx(other, abs=1e-8), (x, y)


def test_same_as_the_single_aggregation(rows):
    columns = ["b", "c", "empty"]
    expected = {(r.x, r.y): r["corr"] for r in corr_matrix(rows, columns).collect()}
    got = {(r.x, r.y): r["corr"] for r in corr_matrix_blocked(rows, columns, block=2).collect()}
    assert set(got) == set(expected) and all(close(got[k], expected[k]) for k in got if "empty" not in k)


LOADS = [
    [("2023-01-05", "b"), ("2023-01-09", "b"), ("2023-01-02", "a"), ("2023-01-02", None)],
    [("2023-03-01", "z"), ("2023-02-01", "y"), ("2023-02-01", "x"), ("2023-02-07", "x"), ("2023-02-01", "a")],
    [("2023-01-01", "early"), ("2023-04-01", "b"), (None, "undated")],
]


def test_dictionary(spark, tmp_path):
    path = str(tmp_path / "d")
    frames = [spark.createDataFrame(x, "t string, v string").withColumn("t", F.col("t").cast("date")) for x in LOADS]
    seen = {}
    for load, (frame, n) in enumerate(zip(frames, (2, 3, 1), strict=True)):
        assert extend_dictionary(spark, path, frame, "v", "t") == n
        now = {r.category: r.id for r in spark.read.parquet(path).collect()}
        assert seen.items() <= now.items() and sorted(now.values()) == list(range(len(now)))
        seen = now
        assert extend_dictionary(spark, path, frame, "v", "t") == 0
    assert seen == {"b": 0, "a": 1, "x": 2, "y": 3, "z": 4, "early": 5}
    months = {r.category: r.first_seen for r in spark.read.parquet(path).collect()}
    assert months["x"] == D(2023, 2, 1) and months["z"] == D(2023, 3, 1) and months["early"] == D(2023, 1, 1)
    indexed = versioned_index(frames[2], "v", spark.read.parquet(path)).collect()
    assert {r.v: r.v_index for r in indexed} == {"early": 5, "b": 0, "undated": None}


def test_empty_dictionary(spark, tmp_path):
    empty = spark.createDataFrame([], "snapshot_date date, v string")
    assert extend_dictionary(spark, str(tmp_path / "d"), empty, "v") == 0
    one = spark.createDataFrame([(D(2023, 1, 1), 5)], "snapshot_date date, v int")
    assert extend_dictionary(spark, str(tmp_path / "d"), one, "v") == 1


def test_blocks_take_no_pass_of_their_own(spark, monkeypatch):
    passes, gram = [], correlations._gram
    monkeypatch.setattr(correlations, "_gram", lambda df, means, columns: passes.append(columns) or gram(df, means, columns))
    df = spark.range(50).selectExpr(*[f"cast(id * id % {k} as double) as x{k}" for k in (3, 5, 7, 11, 13)])
    got = {(r.x, r.y): r["corr"] for r in corr_matrix_blocked(df, df.columns, block=2).collect()}
    assert len(passes) == 3
    expected = {(r.x, r.y): r["corr"] for r in corr_matrix(df, df.columns).collect()}
    assert set(got) == set(expected) and all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in got)
