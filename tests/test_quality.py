import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapcredit.functions.casts import pattern_gated_cast, schema_enforce
from snapcredit.functions.text import column_suffix, duration_months, token_counts
from snapcredit.operators import quality as q


def column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def frame(spark, values, dtype="string"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, v {dtype}")


def test_dirty_integers(spark):
    df = frame(spark, ["7", "5_", "-3", "5.0", "", None, "99999999999"])
    assert column(pattern_gated_cast(df, {"v": "int"}), "v") == [7, None, None, None, None, None, None]
    assert column(schema_enforce(df, {"v": "int"}), "v") == [7, None, -3, None, None, None, None]


def test_decimals(spark):
    df = frame(spark, ["12.345", "1.23456789E7", "-1.5", "."])
    assert column(pattern_gated_cast(df, {"v": "decimal(18,2)"}), "v") == [
        Decimal("12.35"), None, None, None,
    ]
    narrow = pattern_gated_cast(frame(spark, ["99.994", "99.995", "100.5"]), {"v": "decimal(4,2)"})
    assert column(narrow, "v") == [Decimal("99.99"), None, None]
    valid = q.range_validate(narrow, {"v": q.Bounds(0, 100)})
    assert column(valid, "v") == [Decimal("99.99"), 0, 0]
    assert valid.schema["v"].dataType.simpleString() == "decimal(4,2)"


def test_booleans(spark):
    df = frame(spark, ["Yes", "No", "NM", "true", "1", None])
    assert column(schema_enforce(df, {"v": "boolean"}), "v") == [True, False, None, True, True, None]
    gated = pattern_gated_cast(df, {"v": "boolean"})
    assert column(gated, "v") == [None, None, None, True, True, None]
    assert column(q.bool_default(gated, ["v"]), "v") == [False, False, False, True, True, False]
    wide = pattern_gated_cast(df, {"v": "boolean"}, patterns={"v": "(?i)^(yes|no|true)$"})
    assert column(wide, "v") == [True, False, None, True, None, None]


def test_text_and_dates(spark):
    assert column(pattern_gated_cast(frame(spark, ["a\nb"]), {"v": "string"}), "v") == ["a\nb"]
    dates = pattern_gated_cast(frame(spark, ["2023-02-01", "2023-02-30", "01/02/2023"]), {"v": "date"})
    assert column(dates, "v") == [dt.date(2023, 2, 1), None, None]


def test_declared_columns_only(spark):
    df = frame(spark, ["1"])
    assert schema_enforce(df, "v int").schema.simpleString() == "struct<id:int,v:int>"
    with pytest.raises(ValueError, match="other"):
        pattern_gated_cast(df, {"other": "int"})
    with pytest.raises(ValueError, match="no pattern"):
        pattern_gated_cast(df, {"v": "timestamp"})


def test_durations(spark):
    texts = ["22 Years and 1 Months", "3 Years", "7 Months", "1 Year and 1 Month", "NA", None]
    df = frame(spark, texts).withColumn("v", duration_months("v"))
    assert column(df, "v") == [265, 36, 7, 13, 0, 0]


def test_phrases(spark):
    df = frame(spark, ["Auto Loan, Credit-Builder Loan, and Auto Loan", None, "", "aaaa é é"])
    counted = token_counts(df, "v", ["Auto Loan", "Credit-Builder Loan", "aa", "é", "."], prefix="n_")
    assert counted.columns == [
        "id", "n_Auto_Loan_Count", "n_Credit_Builder_Loan_Count", "n_aa_Count", "n_é_Count",
        "n_phrase_4_Count",
    ]
    assert [tuple(r)[1:] for r in counted.orderBy("id").collect()] == [
        (2, 1, 0, 0, 0), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0), (0, 0, 2, 2, 0),
    ]
    assert column_suffix(" !a  b! ", "x") == "a_b"


def test_range_bounds(spark):
    values = [0, 100, 101, -1, None, 50]
    df = frame(spark, values, "int")
    assert column(q.range_validate(df, {"v": q.Bounds(0, 100, closed=True)}), "v") == [0, 100, 0, 0, 0, 50]
    assert column(q.range_validate(df, {"v": q.Bounds(0, 100)}), "v") == [0, 0, 0, 0, 0, 50]
    assert column(q.range_validate(df, {"v": q.Bounds(low=0)}), "v") == [0, 100, 101, 0, 0, 50]
    with pytest.raises(ValueError):
        q.Bounds().holds(F.col("v"))


def test_domains(spark):
    df = frame(spark, ["a", "b", None, "z"])
    assert column(q.domain_validate(df, {"v": (["a", "b"], "other")}), "v") == ["a", "b", "other", "other"]


def test_missing_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert q.drop_null_keys(df, ["a", "b"]).count() == 1
    assert q.drop_null_keys(df, ["a", "b"], "all").count() == 2


def test_fill(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a int, b double, c string, d boolean")
    assert tuple(q.fill_zero(df).first()) == (0, 0.0, None, None)
    assert tuple(q.fill_zero(df, exclude=["a"]).first()) == (None, 0.0, None, None)
    assert tuple(q.fill_zero(df, ["a"]).first()) == (0, None, None, None)


def test_dedup_is_repeatable(spark):
    rows = [(i % 5, i % 3, (i * 7) % 11, f"p{(i * 13) % 17}") for i in range(200)]
    schema = "k int, t int, a int, b string"
    one = q.dedup_latest(spark.createDataFrame(rows, schema), ["k"], ["t"])
    two = q.dedup_latest(spark.createDataFrame(rows[::-1], schema).repartition(7), ["k"], ["t"])
    assert sorted(one.collect()) == sorted(two.collect())
    expected = {k: max((r for r in rows if r[0] == k), key=lambda r: r[1:]) for k in range(5)}
    assert {r.k: tuple(r) for r in one.collect()} == expected
    only_keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in q.dedup_latest(only_keys, ["k"]).collect()) == [1, 2]


def test_counters_and_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "k string, v double")
    counted = q.quality_counters(df, {"missing": F.col("v").isNull()}).first()
    assert (counted.n_rows, counted.missing) == (3, 1)
    profile = {r.column_name: (r.n_rows, r.non_null, r.data_type) for r in q.nonnull_profile(df).collect()}
    assert profile == {"k": (3, 3, "string"), "v": (3, 2, "double")}
    distinct = {r.column_name: r.n_distinct for r in q.distinct_profile(df, ["k", "v"]).collect()}
    assert distinct == {"k": 2, "v": 2}
    described = q.describe_profile(df).first()
    assert (described.n, described["mean"], described.min_value, described.max_value) == (2, 2.0, 1.0, 3.0)
    kept = df.where(F.col("v").isNotNull())
    removed = {r.k: r.rows_removed for r in q.row_reconcile(df, kept, ["k"]).collect()}
    assert removed == {"a": 1, "b": 0}
