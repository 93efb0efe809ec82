"""Table scans. A snapshot is a partition, so reading one prunes the others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcredit.functions.dates import as_date

FORMATS = ("csv", "parquet")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = True,
) -> DataFrame:
    """CSV with a header.

    A declared schema is matched to the columns by position. Without one Spark reads the files once
    more to infer types, or, with ``infer=False``, takes the names from the header and all values as
    text.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", infer)).csv(path)


def read_csv_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV folders whose headers differ, such as months that gained or moved columns, united by column name.

    Each folder is read by its own header; a column that a folder lacks is null there. Values are text.
    """
    frames = [read_csv(spark, path, infer=False) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Paths of the data files below ``path``, listed by Spark; no file content is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    )


def detect_format(spark: SparkSession, path: str | list[str]) -> str:
    """``csv`` or ``parquet``, compressed or not; mixed or other formats are refused."""
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)(\.(gz|bz2|zst|lz4|snappy|deflate))?$", 1))
    found = sorted(r[0] for r in _files(spark, path).select(extension).distinct().limit(10).collect())
    if len(found) != 1 or found[0] not in FORMATS:
        raise ValueError(f"{path} must hold either csv or parquet files, found: {found}")
    return found[0]


def load_all(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All snapshots below one path, or below several, united by column name.

    Each path may be a partitioned table of its own; a column that one lacks is null there.
    """
    fmt = fmt or detect_format(spark, path)
    if not isinstance(path, str):
        frames = [load_all(spark, p, fmt, schema) for p in path]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    raise ValueError(f"unsupported format {fmt!r}; use one of {FORMATS}")


def load_snapshot(
    spark: SparkSession,
    path: str,
    snapshot: str | dt.date,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    date_column: str = "snapshot_date",
) -> DataFrame:
    """One snapshot. On a partitioned table the predicate becomes a partition filter."""
    return load_all(spark, path, fmt, schema).where(F.col(date_column) == F.lit(as_date(snapshot)))


def load_datasets(spark: SparkSession, path: str, split_column: str = "split") -> dict[str, DataFrame]:
    """Named datasets of a folder.

    Both layouts are read: one table partitioned by ``split_column``, and one ``<name>.parquet``
    directory per dataset. Other files are skipped.
    """
    partition = F.regexp_extract("path", rf"/{split_column}=([^/]+)/[^/]+\.parquet$", 1)
    directory = F.regexp_extract("path", r"/([^/]+)\.parquet/[^/]+\.parquet$", 1)
    found = (
        _files(spark, path)
        .select(partition.alias("partition"), directory.alias("directory"))
        .distinct()
        .collect()
    )
    splits = sorted({r.partition for r in found if r.partition})
    if splits:
        table = spark.read.parquet(path)
        return {s: table.where(F.col(split_column) == s).drop(split_column) for s in splits}
    names = sorted({r.directory for r in found if r.directory})
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet") for name in names}
