"""Cleaning, validation, deduplication, counters and profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def drop_null_keys(df: DataFrame, keys: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows in which any (or, with ``how="all"``, every) key is null."""
    return df.dropna(how=how, subset=list(keys))


def fill_zero(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Iterable[str] = ()
) -> DataFrame:
    """Numeric nulls become 0, by default in all numeric columns. Other types stay null."""
    names = list(columns) if columns is not None else numeric_columns(df, exclude)
    return df.fillna(0, subset=names) if names else df


@dataclass(frozen=True)
class Bounds:
    """A range rule; a missing end is open-ended, ``closed`` includes both ends."""

    low: float | None = None
    high: float | None = None
    closed: bool = False

    def holds(self, column: Column) -> Column:
        tests = []
        if self.low is not None:
            tests.append(column >= self.low if self.closed else column > self.low)
        if self.high is not None:
            tests.append(column <= self.high if self.closed else column < self.high)
        if not tests:
            raise ValueError("a range needs at least one end")
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def range_validate(df: DataFrame, rules: Mapping[str, Bounds]) -> DataFrame:
    """Values outside their range, and nulls, become 0. Column types are kept."""
    return df.withColumns(
        {
            c: F.when(rule.holds(F.col(c)), F.col(c)).otherwise(F.lit(0).cast(df.schema[c].dataType))
            for c, rule in rules.items()
        }
    )


def domain_validate(df: DataFrame, rules: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """Values outside their domain, and nulls, become the default; rules are ``{col: (domain, default)}``."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isin(list(domain)), F.col(c)).otherwise(F.lit(default))
            for c, (domain, default) in rules.items()
        }
    )


def bool_default(df: DataFrame, columns: Sequence[str], default: bool = False) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in columns})


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    Spark keeps only ``n`` rows per key and map task before the shuffle (``WindowGroupLimit``), so a
    key that holds much of the table does not end up in one task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key, always the same one.

    Ties on ``order_by`` are broken by all other columns, highest value first, so that the result
    depends neither on partitioning nor on task order.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in order_by or ()]
    rest = [
        F.col(f.name).desc()
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    # an order by the keys themselves is constant; it stands in where nothing else is left to sort on
    return latest_per_key(df, keys, [*order, *rest] or list(keys))


def row_reconcile(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row counts of two layers side by side, and the rows removed between them."""

    def counted(df: DataFrame, is_before: int) -> DataFrame:
        return df.select(*by, F.lit(is_before).alias("_before"))

    both = counted(before, 1).unionByName(counted(after, 0))
    return (
        both.groupBy(*by)
        .agg(
            F.count_if(F.col("_before") == 1).alias("rows_before"),
            F.count_if(F.col("_before") == 0).alias("rows_after"),
        )
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def quality_counters(
    df: DataFrame, checks: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Rows, and rows per named condition, in one pass."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    )


def _unpivot_row(row: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row of ``<value>__<column>`` cells to one row per column."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{v}__{c}").alias(v) for v in values])
        for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def nonnull_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, non-null values and type."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"non_null__{c}") for c in df.columns]
    )
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(f"non_null__{f.name}").alias("non_null"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for f in df.schema.fields
    ]
    return row.select(F.inline(F.array(*cells)))


def describe_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min and max."""
    columns = list(columns or numeric_columns(df))
    stats = {
        "n": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min_value": lambda c: F.min(F.col(c).cast("double")),
        "max_value": lambda c: F.max(F.col(c).cast("double")),
    }
    row = df.agg(*[f(c).alias(f"{name}__{c}") for c in columns for name, f in stats.items()])
    return _unpivot_row(row, columns, list(stats))


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct non-null values.

    Columns become (name, value) pairs, deduplicated before and after one shuffle; nothing is counted
    in a single task but one number per column.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    return (
        pairs.distinct().groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    )
