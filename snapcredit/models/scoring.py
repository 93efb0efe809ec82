"""Batch scoring of snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.sources.sinks import write_snapshots


def batch_score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Inputs plus ``features``, ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(features)


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def narrow_scores(
    predictions: DataFrame, model_name: str, keys: Sequence[str] = ("Customer_ID", "snapshot_date")
) -> DataFrame:
    """``(keys, model_name, model_predictions)`` with the probability of the positive class."""
    return predictions.select(
        *keys,
        F.lit(model_name).alias("model_name"),
        positive_probability().alias("model_predictions"),
    )


def score_snapshots(
    model: PipelineModel,
    features: DataFrame,
    snapshots: Sequence[str | dt.date],
    path: str,
) -> None:
    """Score any number of snapshots in one job into the partitioned prediction table."""
    wanted = [as_date(s) for s in snapshots]
    write_snapshots(batch_score(model, features.where(F.col("snapshot_date").isin(wanted))), path)
