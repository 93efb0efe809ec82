"""Running counts in value order, the common part of the KS statistic and the exact AUC.

Rows are first reduced to one per distinct value, then the values are cut into slices of about equal
size. Running counts are taken inside a slice, and the totals of the earlier slices, one row per slice,
are added afterwards. So no task sorts more than one slice, however large a column or a group is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 250_000
#: Slices grow with the rows between these; beyond, slices grow, and the sort of one spills to disk.
MIN_SLICES, MAX_SLICES = 8, 4_096
SAMPLED_PER_SLICE = 500


def slice_cuts(
    df: DataFrame, columns: Sequence[str], n_rows: int, slices: int | None = None
) -> dict[str, list[float]]:
    """Cut points per double column that divide ``n_rows`` rows into about equal slices.

    Unless given, the number of slices grows with the rows. The cuts come from a sample whose size depends on the number of slices only. They
    balance the work and nothing else, so a sample does not make the results approximate. They are
    collected and become constants of the plan: every task, and every repeated task, sees the same.
    """
    slices = slices or min(max(-(-n_rows // ROWS_PER_SLICE), MIN_SLICES), MAX_SLICES)
    share = min(1.0, slices * SAMPLED_PER_SLICE / max(n_rows, 1))
    sample = df.select(*columns) if share == 1.0 else df.select(*columns).sample(share, seed=17)
    shares = f"array({', '.join(f'{i / slices}D' for i in range(1, slices))})"
    row = sample.agg(
        *[
            F.expr(f"percentile_approx(if(abs(`{c}`) < double('inf'), `{c}`, null), {shares}, {20 * slices})").alias(c)
            for c in columns
        ]
    ).first()
    return {c: sorted(set(row[c] or [0.0])) for c in columns}


def value_counts(
    df: DataFrame,
    cuts: Mapping[str, Sequence[float]],
    counts: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per distinct value of the double columns in ``cuts``: ``(by, feature, slice, value, counts)``.

    ``counts`` are integer weights, summed per value before and after the shuffle, so a value that
    fills much of a column is one row per map task. Nulls and NaN are left out.
    """
    columns = list(cuts)
    sliced = Bucketizer(
        inputCols=columns,
        outputCols=[f"_slice_{c}" for c in columns],
        splitsArray=[[float("-inf"), *cuts[c], float("inf")] for c in columns],
        handleInvalid="keep",
    ).transform(df.select(*by, *columns, *counts))
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_slice_{c}").cast("int").alias("slice"),
            F.col(c).alias("value"),
        )
        for c in columns
    ]
    return (
        sliced.select(*by, *counts, F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "feature", "slice", "value")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def within_slice(counted: DataFrame, counts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``<count>_upto``: the running count inside the slice, this value included."""
    running = (
        Window.partitionBy(*by, "feature", "slice")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counted.withColumns({f"{c}_upto": F.sum(c).over(running) for c in counts})


def before_slice(totals: DataFrame, counts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``<count>_before`` to slice totals: the count in all earlier slices of the feature."""
    earlier = (
        Window.partitionBy(*by, "feature")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.withColumns(
        {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in counts}
    )
