"""Model registry: a directory per model, one JSON table with a row per model."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snapcredit.models.training import SearchResult, top_features
from snapcredit.operators.aggregates import arg_max

METADATA_SCHEMA = (
    "saved_at timestamp, model_type string, model_name string, path string, params map<string,string>, "
    "metrics map<string,double>, top_features array<struct<feature:string,score:double>>"
)


def save_model(
    spark: SparkSession, result: SearchResult, root: str, model_type: str, model_name: str
) -> str:
    """Store the pipeline, then append its metadata row; returns the model path.

    A path that is used again has two rows, of which the registry reads the newer one.
    """
    root = root.rstrip("/")
    path = f"{root}/{model_type}/{model_name}"
    result.model.write().overwrite().save(path)
    best = top_features(result.model, spark.range(0)).collect()
    row = (
        dt.datetime.now(dt.timezone.utc),
        model_type,
        model_name,
        path,
        {k: str(v) for k, v in result.params.items()},
        {k: float(v) for k, v in result.metrics.items()},
        [(r.feature, r.score) for r in best],
    )
    spark.createDataFrame([row], METADATA_SCHEMA).write.mode("append").json(f"{root}/metadata")
    return path


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """One row per model path: that of its last training."""
    rows = spark.read.schema(METADATA_SCHEMA).json(f"{root.rstrip('/')}/metadata")
    newest = F.max_by(F.struct(*rows.columns), "saved_at").alias("row")
    return rows.groupBy(F.col("path").alias("_path")).agg(newest).select("row.*")


def champion(registry: DataFrame, criterion: str = "val_auc") -> DataFrame:
    """The registry row with the highest metric; a missing metric is 0 and 0 never wins."""
    scored = registry.withColumn("_score", F.coalesce(F.col("metrics")[criterion], F.lit(0.0)))
    scored = scored.where(F.col("_score") > 0)
    # maps cannot be compared, so equal scores are decided by the path
    best = F.max_by(F.struct(*registry.columns), F.struct("_score", "path")).alias("best")
    return scored.agg(best).where(F.col("best").isNotNull()).select("best.*")


def model_select(candidates: DataFrame, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The same choice over a flat table of candidates and scores."""
    return arg_max(candidates.fillna(0.0, subset=[score]).where(F.col(score) > 0), score, by)


def load_champion(spark: SparkSession, root: str, criterion: str = "val_auc") -> tuple[PipelineModel, Row]:
    """Choose by metadata, then load only the chosen model."""
    found = champion(read_registry(spark, root), criterion).first()
    if found is None:
        raise ValueError(f"no model in {root} has {criterion} > 0")
    return PipelineModel.load(found.path), found


def promote_champion(spark: SparkSession, root: str, criterion: str = "val_auc") -> str:
    """Save the champion as ``best_model`` next to its metadata; returns the model path."""
    root = root.rstrip("/")
    model, row = load_champion(spark, root, criterion)
    path = f"{root}/best_model/model"
    model.write().overwrite().save(path)
    metadata = spark.createDataFrame([row], METADATA_SCHEMA)
    metadata.write.mode("overwrite").json(f"{root}/best_model/metadata")
    return path
