"""Standard scaling with the population deviation, fitted on one set and applied to others."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Mean and deviation per column; two numbers each, so they can be kept with the model."""

    mean: dict[str, float]
    deviation: dict[str, float]

    def stage(self, suffix: str = "_scaled") -> SQLTransformer:
        """The fitted scaler as a pipeline stage, saved and loaded with the model that needs it."""
        scaled = [
            f"(`{c}` - {self.mean[c]!r}D) / {self.deviation[c]!r}D AS `{c}{suffix}`" for c in self.mean
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregation over the training set. A column without spread keeps its scale."""
    row = train.agg(
        *[F.avg(c).cast("double").alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"{c}__mean"] or 0.0 for c in columns},
        {c: row[f"{c}__std"] or 1.0 for c in columns},
    )


def apply_scaler(
    df: DataFrame, scaler: Scaler, columns: Sequence[str], suffix: str = ""
) -> DataFrame:
    """Replace each column by its scaled value, or add ``<column><suffix>``."""
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c) - scaler.mean[c]) / scaler.deviation[c] for c in columns}
    )
