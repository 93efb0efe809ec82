"""Change detection of source months."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapcredit.sources.changes import backfill_changed, changed_snapshots, fingerprint_path, fingerprints
from snapcredit.sources.sinks import write_snapshots

D = dt.date
SPAN = ("2023-01-01", "2023-12-01")


def table(spark, rows):
    return spark.createDataFrame(rows, "snapshot_date date, a long, b string")


ROWS = [(D(2023, 1 + i % 4, 1), i if i % 5 else None, f"r{i}") for i in range(40)]


def prints(df):
    return {tuple(r) for r in fingerprints(df).collect()}


def test_order_files_and_columns_do_not_matter(spark):
    base = prints(table(spark, ROWS))
    assert prints(table(spark, ROWS[::-1]).repartition(7)) == base
    assert prints(table(spark, ROWS).select("b", "a", "snapshot_date")) == base


@pytest.mark.parametrize("change", [
    lambda r: r[:-1],
    lambda r: [*r, r[0]],
    lambda r: [*r, r[0], r[0]],
    lambda r: [(r[0][0], r[0][2] and 7, r[0][2]), *r[1:]],
    lambda r: [(r[1][0], None, r[1][2]), r[0], *r[2:]],
    lambda r: [(r[1][0], r[1][1], None), r[0], *r[2:]],
])
def test_any_change_is_seen(spark, change):
    assert prints(table(spark, change(ROWS))) != prints(table(spark, ROWS))


def test_nulls_in_different_columns_differ(spark):
    one = spark.createDataFrame([(D(2023, 1, 1), None, "x")], "snapshot_date date, a string, b string")
    other = spark.createDataFrame([(D(2023, 1, 1), "x", None)], "snapshot_date date, a string, b string")
    assert prints(one) != prints(other)
    assert prints(one) != prints(one.withColumn("c", F.lit(None).cast("string")))


def test_backfill(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def build(rows, keep="true", **options):
        write_snapshots(table(spark, rows), source, whole_table=True)
        read = []

        def transform(df):
            read.extend(sorted({r.snapshot_date.month for r in df.select("snapshot_date").collect()}))
            return df.where(keep).withColumn("c", F.length("b"))

        done = backfill_changed(spark.read.parquet(source), transform, sink, *SPAN, **options)
        assert read == [d.month for d in done]
        found = [tuple(r) for r in spark.read.parquet(sink).select("snapshot_date", "a", "b").collect()]
        kept = table(spark, rows).where(keep).collect() if rows else []
        assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in kept)
        return [d.month for d in done]

    assert build(ROWS) == [1, 2, 3, 4]
    assert build(ROWS[::-1]) == []
    changed = [(d, 99 if b == "r1" else a, b) for d, a, b in ROWS]
    assert build(changed) == [2]
    assert build(changed) == []
    assert build([r for r in changed if r[0].month != 3] + [(D(2023, 7, 1), 1, "new")]) == [7]
    assert build(ROWS) == [2, 3]  # month 7 goes, 2 is as at first, 3 is back
    assert build(ROWS, version="2") == [1, 2, 3, 4]
    assert build(ROWS, version="2") == []


def test_month_that_loses_all_rows_in_the_transform(spark, tmp_path):
    sink = str(tmp_path / "out")
    df = table(spark, ROWS)
    assert len(backfill_changed(df, lambda x: x.where("month(snapshot_date) <> 2"), sink, *SPAN)) == 4
    assert spark.read.parquet(sink).select("snapshot_date").distinct().count() == 3
    assert backfill_changed(df, lambda x: x, sink, *SPAN) == []
    more = table(spark, [*ROWS, (D(2023, 1, 1), 1, "x")])
    assert backfill_changed(more, lambda x: x.where("false"), sink, *SPAN) == [D(2023, 1, 1)]
    assert spark.read.parquet(sink).where("month(snapshot_date) = 1").count() == 0


def test_interrupted_build_is_repeated(spark, tmp_path):
    sink = str(tmp_path / "out")
    df = table(spark, ROWS)

    def breaks(x):
        return x.withColumn("c", F.raise_error(F.lit("broken")).cast("string"))

    with pytest.raises(Exception, match="broken"):
        backfill_changed(df, breaks, sink, *SPAN)
    assert len(backfill_changed(df, lambda x: x, sink, *SPAN)) == 4
    assert spark.read.parquet(fingerprint_path(sink)).count() == 4


def test_detection_is_one_aggregation(spark, tmp_path):
    """The source is scanned once, and one row per month and task is shuffled."""
    source = str(tmp_path / "in")
    write_snapshots(table(spark, ROWS), source)
    _, _, now = changed_snapshots(spark.read.parquet(source), str(tmp_path / "out"), *SPAN)
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_bit_xor" in plan and "PartitionFilters: [isnotnull" in plan
