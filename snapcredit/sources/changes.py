"""Change detection: snapshots whose source differs from the one they were built from are built again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.sources.sinks import write_snapshots
from snapcredit.sources.snapshots import month_spine, present_snapshots

FINGERPRINT = "snapshot_date date, n_rows long, bits long, total decimal(38,0), version string, empty boolean"


def fingerprints(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Fingerprint of each snapshot: rows, XOR and sum of the rows' hashes.

    It does not depend on the order of rows, of files or of columns, and is one row per map task and
    snapshot before the shuffle. The sum tells apart what cancels in the XOR, such as a row that stands
    there twice. Names count, and nulls are hashed as values of their own (a hash skips them).
    """
    names = sorted(c for c in df.columns if c != by)
    cells = [x for c in names for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    row = F.xxhash64(F.lit("|".join(names)), *cells)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor(row).alias("bits"),
        F.sum(row.cast("decimal(28,0)")).alias("total"),
    )


def _read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def _drop_snapshots(spark: SparkSession, path: str, dates: list[dt.date]) -> None:
    """Remove the folders of some snapshots."""
    for day in dates:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/snapshot_date={day}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _file_names(spark: SparkSession, path: str, dates: list[dt.date], fmt: str) -> dict[dt.date, set[str]]:
    """Names of the files of some snapshots; every write gives its files new ones."""
    files = _read_or_empty(spark, path, "snapshot_date date", fmt)
    if not files.inputFiles():
        return {}
    files = files.where(F.col("snapshot_date").isin(dates)).select("snapshot_date", F.col("_metadata.file_name").alias("f"))
    rows = files.distinct().groupBy("snapshot_date").agg(F.collect_set("f").alias("names")).collect()
    return {r.snapshot_date: set(r.names) for r in rows}


def changed_snapshots(
    source: DataFrame, path: str, start: str | dt.date, end: str | dt.date, fmt: str = "parquet", version: str = ""
) -> tuple[list[dt.date], list[dt.date], DataFrame]:
    """Months of the range to build, months to remove, and the fingerprints of the source.

    To build: months of the source that the sink lacks, or whose stored fingerprint or ``version`` is
    another. To remove: months of the sink without a row in the source any more.
    """
    spark = source.sparkSession
    window = F.col("snapshot_date").between(F.trunc(F.lit(as_date(start)), "month"), F.lit(as_date(end)))
    now = fingerprints(source.where(window)).withColumn("version", F.lit(version))
    now = month_spine(spark, start, end).join(now, "snapshot_date")
    then = _read_or_empty(spark, fingerprint_path(path), FINGERPRINT)
    built = present_snapshots(_read_or_empty(spark, path, "snapshot_date date", fmt).where(window))
    # A month of which the transform keeps nothing is done without being in the sink.
    same = now.join(then, now.columns).join(built.withColumn("there", F.lit(True)), "snapshot_date", "left")
    same = same.where(F.col("there") | F.col("empty")).select("snapshot_date")
    todo = now.select("snapshot_date").join(same, "snapshot_date", "left_anti")
    # One row per month of the range.
    spine = month_spine(spark, start, end)
    gone = built.join(spine, "snapshot_date", "left_semi").join(now, "snapshot_date", "left_anti")
    found = todo.withColumn("gone", F.lit(False)).unionByName(gone.select("snapshot_date", F.lit(True).alias("gone")))
    rows = sorted((r.snapshot_date, r.gone) for r in found.collect())
    return [d for d, g in rows if not g], [d for d, g in rows if g], now


def fingerprint_path(path: str) -> str:
    """Where the fingerprints of a sink are kept: beside it."""
    return f"{path.rstrip('/')}_fingerprints"


def backfill_changed(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    start: str | dt.date,
    end: str | dt.date,
    fmt: str = "parquet",
    version: str = "",
) -> list[dt.date]:
    """Build the snapshots that the sink lacks or whose source has changed, all in one job; returns their dates.

    Removes snapshots whose source rows are gone. The fingerprints are written after the snapshots, so
    whatever breaks off in between is built again. ``version`` names the transform: with another one all
    months are built anew. Detection scans the months of the range once; the build reads the changed ones.
    """
    spark = source.sparkSession
    todo, gone, now = changed_snapshots(source, path, start, end, fmt, version)
    if gone:
        _drop_snapshots(spark, path, gone)
        _drop_snapshots(spark, fingerprint_path(path), gone)
    if todo:
        wanted = F.col("snapshot_date").isin(todo)
        prints = now.where(wanted).cache()  # of the rows that are about to be read, not of later ones
        prints.count()
        cached = prints
        before = _file_names(spark, path, todo, fmt)
        write_snapshots(transform(source.where(wanted)), path, fmt)
        # A month may lose all its rows in the transform: its old files are still there, and go, too.
        after = _file_names(spark, path, todo, fmt)
        empty = [d for d in todo if after.get(d, set()) <= before.get(d, set())]
        _drop_snapshots(spark, path, empty)
        prints = prints.withColumn("empty", F.col("snapshot_date").isin(empty))
        write_snapshots(prints, fingerprint_path(path))
        cached.unpersist()
    return todo
