"""The month spine, the availability gate and backfill."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.sources.sinks import write_snapshots


def month_spine(
    spark: SparkSession, start: str | dt.date, end: str | dt.date, name: str = "snapshot_date"
) -> DataFrame:
    """First-of-month dates from the month of ``start`` to ``end``, both included."""
    first = F.trunc(F.lit(as_date(start)), "month")
    months = F.sequence(first, F.lit(as_date(end)), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))


def month_spine_of(df: DataFrame, name: str = "snapshot_date") -> DataFrame:
    """The spine from the first to the last month of a date column, gaps included."""
    first, last = F.trunc(F.min(name), "month"), F.max(name)
    ends = df.agg(first.alias("first"), last.alias("last")).where(F.col("first").isNotNull())
    months = F.sequence(F.col("first"), F.col("last"), F.expr("interval 1 month"))
    return ends.select(F.explode(months).alias(name))


def present_snapshots(df: DataFrame, name: str = "snapshot_date") -> DataFrame:
    """Snapshots with data. Of a table partitioned by snapshot they are read off the paths of its files,
    and no file is opened."""
    paths = df.inputFiles()
    dates = {m[1] for p in paths if (m := re.search(rf"/{re.escape(name)}=(\d{{4}}-\d\d-\d\d)/", p))}
    if not dates or len(dates) < len({p.rsplit("/", 1)[0] for p in paths}):
        return df.select(name).distinct()
    rows = [(as_date(d),) for d in sorted(dates)]
    return df.sparkSession.createDataFrame(rows, f"`{name}` date")


def missing_snapshots(df: DataFrame, spine: DataFrame, name: str = "snapshot_date") -> DataFrame:
    """Months of the spine without a row in ``df``."""
    return spine.join(present_snapshots(df, name), name, "left_anti")


def snapshots_available(df: DataFrame, start: str | dt.date, end: str | dt.date) -> bool:
    """True if every month from ``start`` to ``end`` has rows."""
    return missing_snapshots(df, month_spine(df.sparkSession, start, end)).isEmpty()


def require_snapshots(df: DataFrame, start: str | dt.date, end: str | dt.date) -> None:
    """Raise, naming the first missing month, unless all are there."""
    first = (
        missing_snapshots(df, month_spine(df.sparkSession, start, end))
        .agg(F.min("snapshot_date"))
        .first()[0]
    )
    if first is not None:
        raise ValueError(f"snapshot {first} is missing between {start} and {end}")


def backfill(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    start: str | dt.date,
    end: str | dt.date,
    fmt: str = "parquet",
) -> list[dt.date]:
    """Build the snapshots the sink lacks, all in one job; returns their dates.

    The missing dates are at most the months of the range. They become literals, so on a partitioned
    source only the missing months are read.
    """
    spark = source.sparkSession
    spine = month_spine(spark, start, end)
    try:
        spine = missing_snapshots(spark.read.format(fmt).load(path), spine)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise  # without a sink, or with an empty one, every month is missing
    todo = sorted(r[0] for r in spine.collect())
    if todo:
        write_snapshots(transform(source.where(F.col("snapshot_date").isin(todo))), path, fmt)
    return todo
