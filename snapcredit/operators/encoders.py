"""Categorical encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcredit.functions.text import column_suffix
from snapcredit.session import scratch_path


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``(category, frequency, index)`` by falling frequency, equal frequencies alphabetically.

    Only distinct categories are sorted, in parallel. They are numbered inside the sorted partitions,
    kept as a table so that the numbers stand, and moved up by the totals of the earlier partitions.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("category"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    return _numbered(counts.orderBy(F.col("frequency").desc(), F.col("category")))


def _numbered(ranked: DataFrame) -> DataFrame:
    """A sorted frame with ``index``, 0, 1, 2... in its order, as a double."""
    path = scratch_path(ranked.sparkSession, "categories")
    # the id has the number of the partition in its upper bits and that of the row in the lower 33
    ranked.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    numbered = ranked.sparkSession.read.parquet(path).select(
        *ranked.columns,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    # one row per partition: its order is the only thing sorted in one place
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return numbered.join(offsets, "_part").select(
        *ranked.columns, (F.col("_row") + F.col("_before")).cast("double").alias("index")
    )


DICTIONARY = "category string, first_seen date, id long"


def extend_dictionary(
    spark: SparkSession, path: str, df: DataFrame, column: str, snapshot: str = "snapshot_date"
) -> int:
    """Append the categories of ``df`` that the dictionary below ``path`` lacks; returns how many came.

    Ids that were given never move. New categories get the next ones, by the month in which they first
    appear, then by falling frequency in that month, then alphabetically. The dictionary is a table
    partitioned by ``first_seen``; a load adds files to it and rewrites none. Loading the same rows
    again adds nothing.
    """
    try:
        known = spark.read.schema(DICTIONARY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], DICTIONARY)
    month = F.trunc(F.col(snapshot), "month").alias("first_seen")
    counts = (
        df.where(F.col(column).isNotNull() & F.col(snapshot).isNotNull())
        .groupBy(F.col(column).cast("string").alias("category"), month)
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    first = counts.groupBy("category").agg(F.min(F.struct("first_seen", (-F.col("frequency")).alias("order"))).alias("at"))
    fresh = first.join(known, "category", "left_anti").select(
        "category", F.col("at.first_seen").alias("first_seen"), F.col("at.order").alias("order")
    )
    numbered = _numbered(fresh.orderBy("first_seen", "order", "category"))
    next_id = known.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    added = numbered.select("category", "first_seen", (F.col("index") + next_id).cast("long").alias("id")).persist()
    try:
        n = added.count()
        if n:
            added.hint("rebalance", "first_seen").write.mode("append").partitionBy("first_seen").parquet(path)
    finally:
        added.unpersist()
    return n


def versioned_index(df: DataFrame, column: str, dictionary: DataFrame, output: str | None = None) -> DataFrame:
    """Add ``<column>_index`` from a dictionary; categories that it lacks, and nulls, get null."""
    output = output or f"{column}_index"
    ids = dictionary.select(F.col("category").alias("_category"), F.col("id").alias(output))
    return df.join(ids, df[column].cast("string") == ids["_category"], "left").select(*[df[c] for c in df.columns], output)


def string_index(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add ``<column>_index``; rows with a null category are dropped."""
    output = output or f"{column}_index"
    index = category_index(df, column).select(
        F.col("category").alias(column), F.col("index").alias(output)
    )
    return df.join(index, column, "inner").select(*df.columns, output)


def categories_of(df: DataFrame, column: str) -> list[str]:
    """The categories present, sorted: as many as the columns that are made of them."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot(
    df: DataFrame,
    column: str,
    categories: Sequence[str] | None = None,
    drop_label: str | None = None,
    keep_source: bool = False,
    fallback: str = "category",
) -> DataFrame:
    """A 0/1 column ``<column>_<category>`` for each category but ``drop_label``; null is all 0.

    Declared categories give every snapshot the same schema and need no pass over the data. A category
    whose name leaves nothing of a column name is called ``<fallback>_<place>`` among those flagged.
    """
    found = categories if categories is not None else categories_of(df, column)
    found = [label for label in found if label != drop_label]
    flags = [
        F.coalesce((F.col(column) == label).cast("int"), F.lit(0)).alias(
            f"{column}_{column_suffix(label, f'{fallback}_{i}')}"
        )
        for i, label in enumerate(found)
    ]
    kept = [F.col(c) for c in df.columns if keep_source or c != column]
    return df.select(*kept, *flags)
