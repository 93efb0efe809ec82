import pytest
from pyspark.sql import functions as F

from snapcredit.operators.aggregates import arg_max, columns_like, corr_matrix, label_ratio, top_k
from snapcredit.operators.encoders import categories_of, category_index, one_hot, string_index
from snapcredit.operators.scaling import apply_scaler, fit_scaler


def letters(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, k string")


def test_one_hot(spark):
    df = letters(spark, ["A", "Other", "B", "C", None])
    found = one_hot(df, "k", drop_label="Other")
    assert found.columns == ["id", "k_A", "k_B", "k_C"]
    assert [tuple(r)[1:] for r in found.orderBy("id").collect()] == [
        (1, 0, 0), (0, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0),
    ]
    declared = one_hot(df, "k", ["Z", "!!"], keep_source=True)
    assert declared.columns == ["id", "k", "k_Z", "k_category_1"]
    named = one_hot(df, "k", ["Other", "!!"], drop_label="Other", fallback="phrase")
    assert named.columns == ["id", "k_phrase_0"]
    assert categories_of(df, "k") == ["A", "B", "C", "Other"]


def test_category_index(spark):
    df = letters(spark, list("bbbaaccd") + [None])
    index = {r.category: (r.frequency, r["index"]) for r in category_index(df, "k").collect()}
    assert index == {"b": (3, 0.0), "a": (2, 1.0), "c": (2, 2.0), "d": (1, 3.0)}


def test_many_categories_are_numbered_in_order(spark):
    df = spark.range(3_000).select(F.concat(F.lit("c"), (F.col("id") % 1_100).cast("string")).alias("k"))
    found = category_index(df, "k").collect()
    expected = sorted(found, key=lambda r: (-r.frequency, r.category))
    assert [r["index"] for r in expected] == [float(i) for i in range(1_100)]


def test_string_index_skips_nulls(spark):
    found = string_index(letters(spark, ["x", "y", "y", None]), "k")
    assert {(r.id, r.k_index) for r in found.collect()} == {(0, 1.0), (1, 0.0), (2, 0.0)}


def test_scaler(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    other = spark.createDataFrame([(5.0, 6.0), (None, None)], "a double, b double")
    scaled = apply_scaler(other, fit_scaler(train, ["a", "b"]), ["a", "b"])
    assert [tuple(r) for r in scaled.collect()] == [(3.0, 1.0), (None, None)]


def test_correlations(spark):
    df = spark.createDataFrame([(1, 2, 3), (2, 4, 1), (3, 6, 2)], "x int, y int, z int")
    found = {(r.x, r.y): r["corr"] for r in corr_matrix(df, ["x", "y", "z"]).collect()}
    assert len(found) == 9
    assert found["x", "y"] == pytest.approx(1.0) and found["z", "x"] == pytest.approx(-0.5)


def test_small_aggregates(spark):
    df = spark.createDataFrame([("a", -3.0), ("b", 2.0), ("c", 1.0)], "feature string, score double")
    assert [r.feature for r in top_k(df, "score", 2).collect()] == ["b", "c"]
    assert [r.feature for r in top_k(df, "score", 2, by_abs=True).collect()] == ["a", "b"]
    assert arg_max(df, "score").first().feature == "b"
    assert columns_like(df, prefix="sc") == ["score"]
    empty = spark.createDataFrame([], "label int")
    assert tuple(label_ratio(empty).first()) == (0, 0.0)
