"""Correlations of many columns from cross products that are summed block by block."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block. Two blocks give a matrix of at most (6 * 300) ** 2 numbers, 26 MB.
BLOCK = 300


def _gram(df: DataFrame, means: dict[str, float], columns: Sequence[str]) -> np.ndarray:
    """Cross products of [value, square, presence] of the columns, values less their mean and 0 where null.

    Rows are summed in the tasks and merged as a tree; only the matrix reaches the driver.
    """
    value = {c: F.col(c) - means[c] for c in columns}
    cells = [F.coalesce(value[c], F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)]
    cells += [F.coalesce(value[c] * value[c], F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(columns)]
    cells += [F.col(c).isNotNull().cast("double").alias(f"p{i}") for i, c in enumerate(columns)]
    rows = df.select(*cells)
    vectors = VectorAssembler(inputCols=rows.columns, outputCol="row").transform(rows).select("row")
    older = MLUtils.convertVectorColumnsFromML(vectors, "row")  # the kind of vector that RowMatrix takes
    return RowMatrix(older, 0, len(cells)).computeGramianMatrix().toArray()


def corr_matrix_blocked(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Pearson correlations in long form ``(x, y, corr)``, both triangles and the diagonal.

    Each pair uses the rows in which both values are present, as `corr_matrix` does; a pair without two
    such rows that differ in both columns is null. The plan does not grow with the pairs: one
    aggregation for the means, and one pass over the rows per pair of different blocks of columns. A NaN or
    infinite value takes the place of a null.
    """
    finite = [F.col(f"`{c}`").cast("double") for c in columns]
    names = [f"c{i}" for i in range(len(columns))]
    values = df.select(*[F.when(F.abs(x) < float("inf"), x).alias(n) for x, n in zip(finite, names, strict=True)])
    row = values.agg(*[F.avg(n).alias(n) for n in names]).first()
    means = {n: row[n] or 0.0 for n in names}
    blocks = [names[i : i + block] for i in range(0, len(names), block)]
    found = np.full((len(names), len(names)), np.nan)
    # Two blocks bring the pairs inside each of them, too; only a single block is taken alone.
    for both in [[*a, *b] for a, b in combinations(blocks, 2)] or blocks:
        size = len(both)
        gram = _gram(values, means, both)
        v, s, p = (slice(k * size, (k + 1) * size) for k in range(3))
        n, sums, squares, products = gram[p, p], gram[v, p], gram[s, p], gram[v, v]
        with np.errstate(invalid="ignore", divide="ignore"):
            spread = squares - sums * sums / n
            # What is left of a constant by rounding is none.
            spread = np.where(spread > 1e-12 * squares, spread, np.nan)
            corr = (products - sums * sums.T / n) / np.sqrt(spread * spread.T)
        at = [names.index(c) for c in both]
        found[np.ix_(at, at)] = np.where(n > 1, corr, np.nan)
    cells = [
        (x, y, None if np.isnan(found[i, j]) else float(found[i, j]))
        for i, x in enumerate(columns) for j, y in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, "x string, y string, corr double")
