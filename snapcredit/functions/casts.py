"""Schema enforcement.

Both operators leave undeclared columns alone, keep the column order and add one projection, however
many columns are declared.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Types = Mapping[str, T.DataType | str] | T.StructType | str

# The text a value must have before it is cast to a type.
CAST_PATTERNS = {
    T.IntegerType: r"^\d+$",
    T.FloatType: r"^\d+(\.\d+)?$",
    T.DecimalType: r"^\d+(\.\d+)?$",
    T.BooleanType: r"^(true|false|1|0)$",
    T.DateType: r"^\d{4}-\d{2}-\d{2}$",
}


def declared_types(types: Types) -> dict[str, T.DataType]:
    """``{column: DataType}`` from a DDL string, a ``StructType`` or a mapping."""
    if isinstance(types, str):
        types = T.StructType.fromDDL(types)
    if isinstance(types, T.StructType):
        return {field.name: field.dataType for field in types.fields}
    return {
        name: T.StructType.fromDDL(f"c {dtype}")["c"].dataType if isinstance(dtype, str) else dtype
        for name, dtype in types.items()
    }


def _checked(df: DataFrame, types: Types) -> dict[str, T.DataType]:
    declared = declared_types(types)
    unknown = [name for name in declared if name not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the data: {', '.join(unknown)}")
    return declared


def schema_enforce(df: DataFrame, types: Types) -> DataFrame:
    """Cast each declared column; a value that does not fit becomes null."""
    declared = _checked(df, types)
    return df.select(
        *[F.col(c).try_cast(declared[c]).alias(c) if c in declared else F.col(c) for c in df.columns]
    )


def gated(column: Column, dtype: T.DataType, pattern: str | None = None) -> Column:
    """``column`` cast to ``dtype`` if its text matches the pattern of that type, else null.

    Text needs no gate. Other types without a pattern are refused.
    """
    if isinstance(dtype, T.StringType):
        return column.cast(dtype)
    if pattern is None:
        pattern = CAST_PATTERNS.get(type(dtype))
    if pattern is None:
        raise ValueError(f"no pattern for type {dtype.simpleString()}")
    text = column.cast("string")
    return F.when(text.rlike(pattern), text).try_cast(dtype)


def pattern_gated_cast(
    df: DataFrame, types: Types, patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Cast with a gate on the text of the value; ``patterns`` replaces the gate of single columns."""
    declared = _checked(df, types)
    own = patterns or {}
    return df.select(
        *[
            gated(F.col(c), declared[c], own.get(c)).alias(c) if c in declared else F.col(c)
            for c in df.columns
        ]
    )
