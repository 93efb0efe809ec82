import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from snapcredit.functions.dates import shift_months
from snapcredit.operators import splits


def months(spark, n, per_month=1):
    spine = [(shift_months(dt.date(2023, 1, 1), i), j) for i in range(n) for j in range(per_month)]
    return spark.createDataFrame(spine, "snapshot_date date, id int")


def counts(df, column="split"):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


def test_out_of_time(spark):
    df = months(spark, 8)
    found = splits.oot_split(df, 3)
    by_date = {r.snapshot_date: r.split for r in found.collect()}
    assert by_date[dt.date(2023, 8, 1)] == "oot_3"
    assert by_date[dt.date(2023, 6, 1)] == "oot_1"
    assert counts(found) == {"rest": 5, "oot_1": 1, "oot_2": 1, "oot_3": 1}
    assert counts(splits.oot_split(df, 0)) == {"rest": 8}
    assert splits.oot_split(df.where("id > 5"), 3).count() == 0


def test_out_of_time_gap(spark):
    df = months(spark, 8).where(F.col("snapshot_date") != dt.date(2023, 7, 1))
    assert counts(splits.oot_split(df, 3)) == {"rest": 5, "oot_1": 1, "oot_3": 1}


def test_sets_are_disjoint_and_complete(spark):
    df = months(spark, 15, 100)
    one = splits.training_sets(df, ["id", "snapshot_date"])
    assert one.count() == df.count()
    two = splits.training_sets(df.repartition(13), ["id", "snapshot_date"])
    assert one.exceptAll(two).count() == 0
    found = counts(one)
    assert found["oot_1"] == found["oot_2"] == found["oot_3"] == 100
    assert 0.6 < found["training"] / 1200 < 0.8
    with pytest.raises(ValueError):
        splits.hash_split(df, ["id"], {"a": 50})


@pytest.mark.parametrize("share", [0.2, 0.5, 0.0, 1.0])
def test_stratified_quota(spark, share):
    df = spark.range(3_000).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 == 0, "b").otherwise("c").alias("label")
    )
    found = splits.stratified_split(df, ["id"], test_share=share)
    assert found.count() == 3_000
    sizes = {r.label: (r.n, r.test) for r in found.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("test")).collect()}
    assert all(test == math.ceil(round(n * share, 6)) for n, test in sizes.values())
    again = splits.stratified_split(df.repartition(5), ["id"], test_share=share)
    assert found.exceptAll(again).count() == 0


def test_windows(spark):
    windows = splits.training_windows("2024-09-01")
    assert windows["oot"] == (dt.date(2024, 7, 1), dt.date(2024, 8, 31))
    assert windows["train_test"] == (dt.date(2023, 7, 1), dt.date(2024, 6, 30))
    found = splits.date_window_split(months(spark, 30), "2024-09-01")
    assert counts(found) == {"train_test": 12, "oot": 2}


def test_minimum_history():
    splits.require_history(15, 3)
    with pytest.raises(ValueError, match="at least 12"):
        splits.require_history(14, 3)


def test_month_arithmetic():
    assert shift_months(dt.date(2023, 3, 31), -1) == dt.date(2023, 2, 28)
    assert shift_months(dt.date(2023, 12, 1), 1) == dt.date(2024, 1, 1)
    assert shift_months(dt.date(2024, 1, 15), -13) == dt.date(2022, 12, 15)
