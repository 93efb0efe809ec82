"""The folded feature store against the one that is built of everything."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from snapcredit.plans import credit_tables as tables
from snapcredit.plans import feature_state, medallion
from snapcredit.plans.catalog import QUERIES
from snapcredit.sources.sinks import write_snapshots

MONTHS = [dt.date(2023, m, 1) for m in range(1, 9)]


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Attributes, financials, clicks and loans of some customers; some start loans late, twice or never."""
    root = tmp_path_factory.mktemp("silver")
    grid = spark.createDataFrame([(f"c{c}", d, c, d.month) for c in range(12) for d in MONTHS],
                                 "Customer_ID string, snapshot_date date, c int, m int")
    attributes = grid.select("Customer_ID", "snapshot_date", (F.col("c") + 20).alias("Age"), F.lit("Lawyer").alias("Occupation"))
    financials = grid.where("(c + m) % 5 > 0").select(
        "Customer_ID", "snapshot_date", (F.col("m") * 2).alias("Num_of_Loan"), F.lit("Good").alias("Credit_Mix"),
        F.lit("Unknown").alias("Payment_Behaviour"), F.lit("Auto Loan").alias("Type_of_Loan"),
    )
    clicks = grid.where("(c * m) % 7 > 0").select(
        "Customer_ID", "snapshot_date", *[(F.col("c") * i + F.col("m")).alias(x) for i, x in enumerate(tables.CLICK_MEASURES)]
    )
    loans = grid.where("c % 4 > 0").select(
        "Customer_ID", "snapshot_date", F.when((F.col("m") - 2 * F.col("c")) % 6 == 0, 0).otherwise(F.col("m")).alias("mob")
    )
    out = []
    for name, df in zip(("attributes", "financials", "clicks", "loans"), (attributes, financials, clicks, loans), strict=True):
        write_snapshots(df, str(root / name))
        out.append(spark.read.parquet(str(root / name)))
    return out


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("spans", [
    [(0, 7)],
    [(k, k) for k in range(8)],
    [(0, 2), (3, 6), (7, 7), (4, 4)],
    [(4, 7), (0, 3)],
])
def test_any_order_of_folds(spark, silver, tmp_path, spans):
    root = str(tmp_path / "state")
    for a, b in spans:
        feature_state.fold(spark, root, MONTHS[a], MONTHS[b], *silver)
    assert rows(feature_state.read_features(spark, root)) == rows(medallion.gold_features(*silver))


def test_state_of_an_earlier_month(spark, silver, tmp_path):
    root = str(tmp_path / "state")
    for month in MONTHS:
        feature_state.fold(spark, root, month, month, *silver)
    early = [df.where(F.col("snapshot_date") <= MONTHS[4]) for df in silver]
    assert rows(feature_state.read_features(spark, root, as_of="2023-05-15")) == rows(medallion.gold_features(*early))
    with pytest.raises(ValueError, match="no state"):
        feature_state.read_features(spark, root, as_of="2022-12-01")


def test_corrected_month(spark, silver, tmp_path):
    """A month folded again with other loans changes the states after it, too."""
    root = str(tmp_path / "state")
    for month in MONTHS:
        feature_state.fold(spark, root, month, month, *silver)
    *others, loans = silver
    changed = loans.withColumn("mob", F.when(F.col("snapshot_date") == MONTHS[3], 1 - F.sign("mob").cast("int")).otherwise(F.col("mob")))
    feature_state.fold(spark, root, MONTHS[3], MONTHS[3], *others, changed)
    assert rows(feature_state.read_features(spark, root)) == rows(medallion.gold_features(*others, changed))


def test_a_new_month_reads_one_month(spark, silver, tmp_path, monkeypatch):
    root, read = str(tmp_path / "state"), []
    feature_state.fold(spark, root, MONTHS[0], MONTHS[6], *silver)
    write = feature_state.write_snapshots

    def spied(df, path, **options):
        read.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, **options)

    monkeypatch.setattr(feature_state, "write_snapshots", spied)
    feature_state.fold(spark, root, MONTHS[7], MONTHS[7], *silver)
    assert len(read) == 4
    for plan in read:
        scans = re.findall(r"FileScan.*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
        assert scans and all(("snapshot_date" in s and "2023-08-01" in s) or "as_of" in s for s in scans), plan


def test_without_loans_or_clicks(spark, silver, tmp_path):
    attributes, financials, clicks, loans = silver
    for i, frames in enumerate(([attributes, financials, clicks.limit(0), loans], [attributes, financials, clicks, loans.limit(0)])):
        root = str(tmp_path / str(i))
        for month in MONTHS[:2]:
            feature_state.fold(spark, root, month, month, *frames)
        early = [df.where(F.col("snapshot_date") <= MONTHS[1]) for df in frames]
        assert rows(feature_state.read_features(spark, root)) == rows(medallion.gold_features(*early))


def test_asof_store_cleans_the_clicks_once(spark, sf_dir):
    files = QUERIES["feature_store_asof"](spark, sf_dir).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
