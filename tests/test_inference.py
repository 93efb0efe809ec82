"""Types of text columns by one pass of bits, and stores that join where they lie."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapcredit.operators.joins import delayed_label_join, label_join
from snapcredit.operators.quality import dedup_latest
from snapcredit.session import scratch_path
from snapcredit.sources.inference import inferred_types, month_kinds, type_evolution, with_inferred_types
from snapcredit.sources.scans import read_csv
from snapcredit.sources.stores import bucket_count, drop_store, write_bucketed

D = dt.date


def typed(spark, values):
    df = spark.createDataFrame([(D(2023, 1, 1), v) for v in values], "snapshot_date date, v string")
    return inferred_types(month_kinds(df, ["v"]))["v"]


@pytest.mark.parametrize("values, expected", [
    (["1", "-2", "+3", None, "", "  "], "int"),
    (["1", "3000000000"], "bigint"),
    (["1", "99999999999999999999"], "decimal(38,0)"),
    (["1", "2.5"], "double"),
    (["3000000000", "1e3"], "double"),
    (["NaN", "1"], "double"),
    (["2023-01-31", "2023-2-1"], "date"),
    (["2023-01-31", "2023-01-31 10:00:00"], "timestamp"),
    (["2023-02-30"], "string"),
    (["true", "FALSE"], "boolean"),
    (["true", "1"], "string"),
    (["1", "2023-01-31"], "string"),
    (["1_", "1"], "string"),
    ([None, ""], "string"),
    (["1 2"], "string"),
])
def test_types(spark, values, expected):
    assert typed(spark, values) == expected


def test_same_as_the_reader(spark, tmp_path):
    """Plain columns get the types that Spark infers by a second scan."""
    rows = [(str(i), f"{i}.5", "2023-01-02", f"w{i}", "true" if i % 2 else "false", str(i + 3_000_000_000)) for i in range(50)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").write.option("header", True).csv(path)
    text = read_csv(spark, path, infer=False).withColumn("snapshot_date", F.lit(D(2023, 1, 1)))
    assert dict(read_csv(spark, path).dtypes) == inferred_types(month_kinds(text, list("abcdef")))


def test_months_widen(spark):
    rows = [(D(2023, 1, 1), "1", "x"), (D(2023, 2, 1), "5000000000", ""), (D(2023, 3, 1), "2.5", "7"), (D(2023, 4, 1), "3", None)]
    df = spark.createDataFrame(rows, "snapshot_date date, v string, `w.x` string")
    kinds = month_kinds(df, ["v", "w.x"])
    found = {(r.snapshot_date.month, r.column): (r.type, r.upto, r.widened) for r in type_evolution(kinds).collect()}
    assert [found[m, "v"] for m in range(1, 5)] == [
        ("int", "int", False), ("bigint", "bigint", True), ("double", "double", True), ("int", "double", False),
    ]
    assert [found[m, "w.x"][:2] for m in range(1, 5)] == [("string", "string"), ("string", "string"), ("int", "string"), ("string", "string")]
    cast = with_inferred_types(df, ["v", "w.x"])
    assert dict(cast.dtypes) == {"snapshot_date": "date", "v": "double", "w.x": "string"}
    assert sorted(r.v for r in cast.collect()) == [1.0, 2.5, 3.0, 5e9]


def test_one_pass(spark):
    df = spark.createDataFrame([(D(2023, 1, 1), "1")], "snapshot_date date, v string")
    plan = month_kinds(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_or" in plan


@pytest.fixture(scope="module")
def stores(spark):
    grid = spark.range(4_000).select(
        F.concat(F.lit("c"), F.col("id") % 100).alias("Customer_ID"),
        F.add_months(F.lit(D(2023, 1, 1)), (F.col("id") % 20).cast("int")).alias("snapshot_date"),
        F.col("id").alias("v"),
    )
    labels = grid.where("v % 3 = 0").select("Customer_ID", "snapshot_date", (F.col("v") % 2).alias("label"))
    found = {}
    for name, df in (("features", grid), ("others", grid.withColumnRenamed("v", "w")), ("labels", labels)):
        found[name] = write_bucketed(df, f"store_{name}", scratch_path(spark, name), 8, order=["snapshot_date"]), df
    yield found
    for name in found:
        drop_store(spark, f"store_{name}")


def test_no_shuffle_below_joins_and_top_one(spark, stores):
    f, o, y = (stores[n][0] for n in ("features", "others", "labels"))
    keys = ["Customer_ID", "snapshot_date"]
    plans = {
        "inner": f.join(o, keys), "left": f.join(o, keys, "left"), "label": label_join(f, y),
        "delayed": delayed_label_join(f, y), "latest": dedup_latest(f, ["Customer_ID"], ["snapshot_date", "v"]),
        "sums": f.groupBy("Customer_ID").agg(F.sum("v")),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in plans.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, (name, plan)
            assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_same_rows_as_without_buckets(stores):
    keys = ["Customer_ID", "snapshot_date"]
    (f, f0), (y, y0) = stores["features"], stores["labels"]
    got, expected = (a.join(b, keys, "left").select(*keys, "v", "label").collect() for a, b in ((f, y), (f0, y0)))
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_bucket_count():
    assert [bucket_count(n, 10) for n in (0, 10, 11, 40, 41)] == [1, 1, 2, 4, 8]
    assert bucket_count(10**15) == 65_536
