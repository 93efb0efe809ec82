"""A model trained on a window of months before a date, with a scaler, and its monthly scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.models.scoring import narrow_scores, positive_probability
from snapcredit.models.training import CV_GBT_SPACE, SearchResult, cv_search, gbt, sample_space, split_stats
from snapcredit.operators.evaluation import auc_exact
from snapcredit.operators.features import KEYS
from snapcredit.operators.scaling import fit_scaler
from snapcredit.operators.splits import date_window_split, stratified_split, training_windows
from snapcredit.sources.sinks import write_snapshots


def window_sets(
    labels: DataFrame,
    features: DataFrame,
    train_date: str | dt.date,
    path: str,
    row_keys: Sequence[str],
    test_share: float = 0.2,
    seed: str = "88",
) -> DataFrame:
    """Labels with the features of their key and snapshot as ``train``, ``test`` and ``oot``.

    Training and test are a stratified split of the months before the out-of-time window. The sets are
    stored below ``path`` so that fitting only scans them; ``row_keys`` identify a label: with the key of
    its loan among them, as customer and month alone do not.
    """
    joined = date_window_split(labels.join(features, list(KEYS), "left"), train_date)
    inside = joined.where(F.col("split") == "train_test")
    split = stratified_split(inside, row_keys, test_share=test_share, seed=seed)
    sets = split.unionByName(joined.where(F.col("split") == "oot"))
    sets.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(path)
    return sets.sparkSession.read.parquet(path)


def train_scorecard(
    sets: DataFrame,
    columns: Sequence[str],
    n_trials: int = 100,
    seed: int = 42,
    space: Mapping[str, Sequence[Any]] = CV_GBT_SPACE,
    parallelism: int | None = None,
) -> SearchResult:
    """Scale by the training set, search with cross-validation on it; the scaler stays with the model."""
    train = sets.where(F.col("split") == "train")
    scaler = fit_scaler(train, columns)
    scaled = [f"{c}_scaled" for c in columns]
    grid = sample_space(space, n_trials, seed, distinct=True)
    return cv_search(
        gbt(seed=88), grid, train, scaled, seed=seed, parallelism=parallelism, prepare=[scaler.stage()]
    )


def model_card(model: PipelineModel, sets: DataFrame, name: str) -> DataFrame:
    """Rows, mean label, date range, exact AUC and Gini of each set."""
    scored = model.transform(sets).withColumn("score", positive_probability())
    quality = auc_exact(scored, "score", by=["split"]).select(
        "split", "auc", F.round(2 * F.col("auc") - 1, 3).alias("gini")
    )
    return split_stats(sets).join(quality, "split").withColumn("model_name", F.lit(name))


def write_card(
    found: SearchResult,
    sets: DataFrame,
    name: str,
    path: str,
    train_date: str | dt.date,
    train_months: int = 12,
    oot_months: int = 2,
) -> None:
    """The card as one JSON row per model: windows, parameters, metrics, and rows and quality per set."""
    windows = training_windows(train_date, train_months, oot_months)
    card = model_card(found.model, sets, name)
    sized = [c for c in card.columns if c != "model_name"]
    row = card.groupBy("model_name").agg(F.sort_array(F.collect_list(F.struct(*sized))).alias("sets"))
    row.select(
        "model_name",
        F.lit(str(as_date(train_date))).alias("train_date"),
        *[
            F.struct(F.lit(str(a)).alias("first"), F.lit(str(b)).alias("last")).alias(window)
            for window, (a, b) in windows.items()
        ],
        F.to_json(F.create_map(*[F.lit(str(x)) for p in found.params.items() for x in p])).alias("params"),
        F.to_json(F.create_map(*[F.lit(str(x)) for p in found.metrics.items() for x in p])).alias("metrics"),
        "sets",
    ).write.mode("append").json(path)


def write_scores(
    model: PipelineModel, features: DataFrame, snapshots: Sequence[str | dt.date], name: str, path: str
) -> None:
    """Scores of several snapshots in one job, a folder per model and in it one per snapshot."""
    wanted = features.where(F.col("snapshot_date").isin([as_date(s) for s in snapshots]))
    write_snapshots(narrow_scores(model.transform(wanted), name).drop("model_name"), f"{path.rstrip('/')}/{name}")


def score_snapshot(
    model: PipelineModel, features: DataFrame, snapshot: str | dt.date, name: str
) -> DataFrame:
    """``(Customer_ID, snapshot_date, model_name, model_predictions)`` of one snapshot."""
    wanted = features.where(F.col("snapshot_date") == F.lit(snapshot).cast("date"))
    return narrow_scores(model.transform(wanted), name)
