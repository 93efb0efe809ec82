"""Types of text columns found in one pass, per month, and how they changed from month to month.

A value shows its kind by built-in tests; kinds are bits, merged by OR, so months and files merge in any
order. The kinds met in a column give its type by a lattice: whole numbers are below fractional ones,
dates below timestamps, and everything that does not fit together is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the kinds a value can have.
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
#: The lattice: the type of a column whose kinds are all among the bits, the narrowest first.
LATTICE = (
    ("int", INT),
    ("bigint", INT | LONG),
    ("decimal(38,0)", INT | LONG | DECIMAL),
    ("double", INT | LONG | DECIMAL | DOUBLE),
    ("date", DATE),
    ("timestamp", DATE | TIMESTAMP),
    ("boolean", BOOLEAN),
)
# The forms of numbers, days and times; years of other than four digits are text.
WHOLE = r"^[+-]?[0-9]{1,38}$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}.*$"


def kind(value: Column) -> Column:
    """The bit of the narrowest kind a text has; null and blank texts have none (0)."""
    text = F.trim(value)
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(text.rlike(WHOLE), F.when(text.try_cast("int").isNotNull(), INT).when(text.try_cast("bigint").isNotNull(), LONG).otherwise(DECIMAL))
        .when(text.rlike(NUMBER) & text.try_cast("double").isNotNull(), DOUBLE)
        .when(F.lower(text).isin("nan", "inf", "-inf", "infinity", "-infinity"), DOUBLE)
        .when(text.rlike(DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(TIME) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: Column) -> Column:
    """The narrowest type of the lattice that holds all kinds; no kind at all is text."""
    found = F.when(kinds == 0, "string")
    for name, bits in LATTICE:
        found = found.when(kinds.bitwiseAND(F.lit(~bits)) == 0, name)
    return found.otherwise("string")


def month_kinds(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """``(by, column, kinds)``: the kinds met per month, in one pass and one row per month and column."""
    merged = df.groupBy(by).agg(*[F.bit_or(kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"k{i}").alias("kinds")) for i, c in enumerate(columns)]
    return merged.select(by, F.inline(F.array(*cells)))


def type_evolution(kinds: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """``(by, column, type, upto, widened)``: the type of a month, that of all months up to it, and whether it grew."""
    so_far = Window.partitionBy("column").orderBy(by)
    upto = type_of(F.bit_or("kinds").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    staged = kinds.select(by, "column", type_of(F.col("kinds")).alias("type"), upto.alias("upto"))
    before = F.lag("upto").over(so_far)
    return staged.withColumn("widened", F.coalesce(before != F.col("upto"), F.lit(False)))


def inferred_types(kinds: DataFrame) -> dict[str, str]:
    """The type of each column over all months: one row per column."""
    whole = kinds.groupBy("column").agg(type_of(F.bit_or("kinds")).alias("type"))
    return {r["column"]: r["type"] for r in whole.collect()}


def with_inferred_types(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """Text columns cast to the types that all their values fit; blank texts become null, unless it is text."""
    types = inferred_types(month_kinds(df, columns, by))

    def cast(c: str) -> Column:
        value = F.col(f"`{c}`")
        if types.get(c, "string") == "string":
            return value
        return F.when(F.trim(value) != "", F.trim(value)).try_cast(types[c]).alias(c)

    return df.select(*[cast(c) if c in columns else F.col(f"`{c}`") for c in df.columns])
