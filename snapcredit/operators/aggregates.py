"""Grouped averages, ratios, correlations, top-k and arg-max."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns_like(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Column names with the given start and end."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def multi_avg(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = "_avg"
) -> DataFrame:
    """``<column>_avg`` per key."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}{suffix}") for c in columns])


def label_ratio(
    df: DataFrame, column: str = "label", by: Sequence[str] = (), positive: int = 1
) -> DataFrame:
    """Rows and share of positives; an ungrouped empty input gives 0."""
    hit = F.when(F.col(column) == positive, 1).otherwise(0)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.avg(hit), F.lit(0.0)).alias("label_ratio")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form ``(x, y, corr)``, both triangles and the diagonal.

    Each pair uses the rows in which both values are present. The upper triangle is one aggregation.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i:]]
    row = values.agg(*[F.corr(x, y).alias(f"{x}|{y}") for x, y in pairs])
    cells = []
    for x, y in pairs:
        for a, b in {(x, y), (y, x)}:
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{x}|{y}`").alias("corr")))
    return row.select(F.inline(F.array(*cells)))


def top_k(
    df: DataFrame, score: str, k: int = 10, by_abs: bool = False, tie_break: str | None = None
) -> DataFrame:
    """The ``k`` rows with the highest score, signed or by absolute value."""
    value = F.abs(F.col(score)) if by_abs else F.col(score)
    ties = [F.col(tie_break)] if tie_break else []
    return df.orderBy(value.desc_nulls_last(), *ties).limit(k)


def arg_max(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest score, per group if asked; equal scores are decided by the whole row."""
    row = F.struct(*df.columns)
    best = F.max_by(row, F.struct(F.col(score), row)).alias("_best")
    return df.where(F.col(score).isNotNull()).groupBy(*by).agg(best).select("_best.*")
