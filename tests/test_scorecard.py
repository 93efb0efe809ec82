import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from snapcredit.functions.dates import shift_months
from snapcredit.models.training import CV_GBT_SPACE, feature_scores
from snapcredit.operators.scaling import apply_scaler, fit_scaler
from snapcredit.plans import scorecard


def test_scaler_stage_equals_operator(spark):
    df = spark.createDataFrame([(1.0, 1e-9), (2.0, 3e-9), (6.0, None)], "a double, b double")
    scaler = fit_scaler(df, ["a", "b"])
    staged = scaler.stage().transform(df).collect()
    applied = apply_scaler(df, scaler, ["a", "b"], "_scaled").collect()
    assert [tuple(r) for r in staged] == [tuple(r) for r in applied]


def test_scorecard(spark, tmp_path):
    rows = [
        (f"c{c}", shift_months(dt.date(2023, 1, 1), m), (c * 7 + m * 3) % 11, (c * 5 + m) % 7)
        for c in range(40)
        for m in range(16)
    ]
    features = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, fe_1 int, fe_2 int")
    labels = features.select(
        "Customer_ID", "snapshot_date", (F.col("fe_1") + F.col("fe_2") > 8).cast("int").alias("label")
    )
    sets = scorecard.window_sets(labels, features, "2024-04-01", str(tmp_path / "sets"), ["Customer_ID", "snapshot_date"])
    sizes = {r.split: r["count"] for r in sets.groupBy("split").count().collect()}
    assert sizes["oot"] == 80 and sizes["train"] + sizes["test"] == 480
    assert sizes["test"] == pytest.approx(96, abs=2)
    space = CV_GBT_SPACE | {"maxIter": [3]}
    found = scorecard.train_scorecard(sets, ["fe_1", "fe_2"], n_trials=2, space=space)
    assert found.features == ["fe_1_scaled", "fe_2_scaled"]
    assert {r.feature for r in feature_scores(found.model, sets).collect()} == set(found.features)
    found.model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    card = {r.split: r for r in scorecard.model_card(loaded, sets, "m").collect()}
    assert set(card) == {"train", "test", "oot"}
    assert card["oot"].auc > 0.8 and card["oot"].gini == pytest.approx(2 * card["oot"].auc - 1, abs=1e-3)
    scores = scorecard.score_snapshot(loaded, features, "2024-03-01", "m")
    assert scores.count() == 40
    assert scores.columns == ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]
    scorecard.write_card(found, sets, "m", str(tmp_path / "cards"), "2024-04-01")
    stored = spark.read.json(str(tmp_path / "cards")).first()
    assert stored.model_name == "m" and stored.oot["first"] == "2024-02-01" and len(stored.sets) == 3
    assert "maxDepth" in stored.params and "cv_auc" in stored.metrics
    scorecard.write_scores(loaded, features, ["2024-02-01", "2024-03-01"], "m", str(tmp_path / "scores"))
    assert spark.read.parquet(str(tmp_path / "scores" / "m")).groupBy("snapshot_date").count().count() == 2
