import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapcredit.session import scratch_path
from snapcredit.sources import scans, sinks, snapshots

D = dt.date
SCHEMA = "snapshot_date date, v long"


def table(spark, months=4, per_month=3):
    month = F.add_months(F.lit(D(2023, 1, 1)), (F.col("id") % months).cast("int"))
    return spark.range(months * per_month).select(month.alias("snapshot_date"), F.col("id").alias("v"))


def rows(df):
    return sorted((r.snapshot_date, r.v) for r in df.collect())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_partitioned_round_trip(spark, tmp_path, fmt):
    path, df = str(tmp_path / "t"), table(spark)
    sinks.write_snapshots(df, path, fmt)
    assert scans.detect_format(spark, path) == fmt
    assert rows(scans.load_all(spark, path, schema=SCHEMA)) == rows(df)
    one = scans.load_snapshot(spark, path, "2023-02-01", schema=SCHEMA)
    assert rows(one) == [(D(2023, 2, 1), v) for v in (1, 5, 9)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_several_paths(spark, tmp_path):
    paths = [str(tmp_path / name) for name in "ab"]
    for path in paths:
        table(spark).write.parquet(path)
    assert scans.load_all(spark, paths).count() == 24


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_several_partitioned_paths(spark, tmp_path, fmt):
    paths = [str(tmp_path / name) for name in "ab"]
    sinks.write_snapshots(table(spark), paths[0], fmt)
    sinks.write_snapshots(table(spark).withColumn("more", F.lit(1)), paths[1], fmt)
    found = scans.load_all(spark, paths)
    assert found.count() == 24 and found.where("more is null").count() == 12
    assert rows(found) == sorted(2 * rows(table(spark)))


def test_overwrite_replaces_only_its_snapshots(spark, tmp_path):
    path, df = str(tmp_path / "t"), table(spark)
    sinks.write_snapshots(df, path)
    for _ in range(2):
        sinks.write_snapshots(df.where("month(snapshot_date) = 2").withColumn("v", F.col("v") + 100), path)
    found = rows(spark.read.parquet(path))
    assert len(found) == 12
    assert [v for d, v in found if d == D(2023, 2, 1)] == [101, 105, 109]


def test_formats_are_checked(spark, tmp_path):
    table(spark).write.parquet(str(tmp_path / "m" / "a"))
    table(spark).write.csv(str(tmp_path / "m" / "b"))
    with pytest.raises(ValueError, match="csv or parquet"):
        scans.detect_format(spark, str(tmp_path / "m"))
    table(spark).write.json(str(tmp_path / "j"))
    with pytest.raises(ValueError, match="json"):
        scans.load_all(spark, str(tmp_path / "j"))
    with pytest.raises(ValueError, match="unsupported"):
        scans.load_all(spark, str(tmp_path / "j"), "json")


def test_datasets(spark, tmp_path):
    split = table(spark).withColumn("split", F.when(F.col("v") < 4, "training").otherwise("test"))
    split.write.partitionBy("split").parquet(str(tmp_path / "one"))
    for name in ("training", "oot_1"):
        table(spark).write.parquet(str(tmp_path / "many" / f"{name}.parquet"))
    table(spark).write.csv(str(tmp_path / "many" / "notes"))
    sizes = {n: df.count() for n, df in scans.load_datasets(spark, str(tmp_path / "one")).items()}
    assert sizes == {"training": 4, "test": 8}
    many = scans.load_datasets(spark, str(tmp_path / "many"))
    assert {n: df.count() for n, df in many.items()} == {"training": 12, "oot_1": 12}


def test_spine_and_gaps(spark):
    spine = snapshots.month_spine(spark, "2023-01-15", "2023-04-01")
    assert [r[0] for r in spine.collect()] == [D(2023, m, 1) for m in (1, 2, 3, 4)]
    gap = table(spark).where("month(snapshot_date) <> 3")
    assert [r[0] for r in snapshots.missing_snapshots(gap, spine).collect()] == [D(2023, 3, 1)]
    assert not snapshots.snapshots_available(gap, "2023-01-01", "2023-04-01")
    assert snapshots.snapshots_available(gap, "2023-01-01", "2023-02-01")
    with pytest.raises(ValueError, match="2023-03-01"):
        snapshots.require_snapshots(gap, "2023-01-01", "2023-04-01")
    assert snapshots.month_spine_of(gap).count() == 4
    assert snapshots.month_spine_of(gap.where("false")).count() == 0


def test_backfill(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "sink")
    sinks.write_snapshots(table(spark), source)
    seen = []

    def double(df):
        seen.append(sorted(r[0] for r in df.select("snapshot_date").distinct().collect()))
        return df.withColumn("v", F.col("v") * 2)

    read = lambda: spark.read.parquet(source)
    assert snapshots.backfill(read(), double, path, "2023-01-01", "2023-02-01") == [D(2023, 1, 1), D(2023, 2, 1)]
    assert snapshots.backfill(read(), double, path, "2023-01-01", "2023-04-01") == [D(2023, 3, 1), D(2023, 4, 1)]
    assert snapshots.backfill(read(), double, path, "2023-01-01", "2023-04-01") == []
    assert seen == [[D(2023, 1, 1), D(2023, 2, 1)], [D(2023, 3, 1), D(2023, 4, 1)]]
    assert [v for _, v in rows(spark.read.parquet(path))] == sorted(
        (2 * v for v in range(12)), key=lambda v: (v // 2 % 4, v)
    )


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "snapshot_date date, feature string, psi double, auc double"
    log = table(spark, 2, 1).select("snapshot_date", F.lit("x").alias("feature"), F.col("v").cast("double").alias("psi"), F.lit(None).cast("double").alias("auc"))
    sinks.write_snapshots(log, path, "json")
    evaluation = spark.createDataFrame([(D(2023, 2, 1), 0.7)], "snapshot_date date, auc double")
    for _ in range(2):
        sinks.merge_metrics_log(spark, path, schema, evaluation)
    nothing = evaluation.where("false")
    sinks.merge_metrics_log(spark, path, schema, nothing)
    found = {r.snapshot_date: r.auc for r in sinks.read_metrics_log(spark, path, schema).collect()}
    assert found == {D(2023, 1, 1): None, D(2023, 2, 1): 0.7}


def test_scratch_is_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert one.startswith(root) and one != two


def test_snapshots_are_listed_without_opening_a_file(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(dt.date(2023, m, 1), m) for m in (1, 2, 4)]
    sinks.write_snapshots(spark.createDataFrame(rows, "snapshot_date date, v int"), path)
    for file in (tmp_path / "table").rglob("*.parquet"):
        if "2023-02" in str(file):
            file.write_bytes(b"not parquet")
    table = spark.read.schema("v int, snapshot_date date").parquet(path)
    spine = snapshots.month_spine(spark, "2023-01-01", "2023-04-01")
    assert [r[0] for r in snapshots.missing_snapshots(table, spine).collect()] == [dt.date(2023, 3, 1)]
    assert not snapshots.snapshots_available(table, "2023-01-01", "2023-04-01")


def test_more_datasets_than_a_thousand(spark, tmp_path):
    rows = [(f"s{i:04}", i) for i in range(1_050)]
    frame = spark.createDataFrame(rows, "split string, v int").coalesce(1)
    frame.write.partitionBy("split").parquet(str(tmp_path / "sets"))
    assert len(scans.load_datasets(spark, str(tmp_path / "sets"))) == 1_050


def test_formats_of_several_paths(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "v int")
    one.write.parquet(str(tmp_path / "p"))
    one.write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "c"))
    assert scans.detect_format(spark, str(tmp_path / "c")) == "csv"
    with pytest.raises(ValueError, match="csv or parquet"):
        scans.detect_format(spark, [str(tmp_path / "p"), str(tmp_path / "c")])


def test_csv_months_with_other_headers(spark, tmp_path):
    for name, frame in (
        ("a", spark.createDataFrame([("1", "x")], "v string, w string")),
        ("b", spark.createDataFrame([("y", "2", "z")], "w string, v string, u string")),
    ):
        frame.write.option("header", True).csv(str(tmp_path / name))
    found = scans.read_csv_by_name(spark, [str(tmp_path / n) for n in "ab"])
    assert sorted((r.v, r.w, r.u) for r in found.collect()) == [("1", "x", None), ("2", "y", "z")]
