"""Partitioned sinks and the metrics log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_snapshots(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition: str = "snapshot_date",
    whole_table: bool = False,
) -> None:
    """Write one directory per snapshot, replacing exactly the snapshots present in ``df``, or, with
    ``whole_table``, all that is there.

    A rerun gives the same table. REBALANCE brings the rows of a snapshot together so that each
    directory gets few files, and lets adaptive execution split a snapshot that is too large for one
    task.
    """
    writer = (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
        .partitionBy(partition)
    )
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_metrics_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The metrics log with a declared schema, so a log without evaluations yet reads the same way."""
    return spark.read.schema(schema).json(path)


def merge_metrics(log: DataFrame, evaluation: DataFrame, key: str = "snapshot_date") -> DataFrame:
    """Attach evaluation metrics to the log entries of the snapshots they belong to.

    ``log`` has one row per snapshot and feature, ``evaluation`` one row per snapshot. Entries without
    an evaluation keep what they had.
    """
    fresh = [c for c in evaluation.columns if c != key]
    renamed = evaluation.select(key, *[F.col(c).alias(f"_new_{c}") for c in fresh])
    merged = log.join(renamed, key, "left")
    return merged.select(
        *[F.col(c) for c in log.columns if c not in fresh],
        *[
            (F.coalesce(f"_new_{c}", c) if c in log.columns else F.col(f"_new_{c}")).alias(c)
            for c in fresh
        ],
    )


def merge_metrics_log(
    spark: SparkSession, path: str, schema: T.StructType | str, evaluation: DataFrame
) -> None:
    """Merge evaluation metrics into a stored log and rewrite only the snapshots they touch."""
    log = read_metrics_log(spark, path, schema)
    touched = log.join(evaluation.select("snapshot_date"), "snapshot_date", "left_semi")
    write_snapshots(merge_metrics(touched, evaluation), path, "json")
