"""Text parsing and column naming."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duration_months(column: Column | str) -> Column:
    """``"22 Years and 1 Months"`` -> 265. A missing part, or a null, counts as 0."""
    text = F.col(column) if isinstance(column, str) else column

    def amount(unit: str) -> Column:
        return F.coalesce(F.regexp_extract(text, rf"(\d+)\s+{unit}", 1).try_cast("int"), F.lit(0))

    return (amount("Year") * 12 + amount("Month")).cast("int")


def phrase_count(column: Column | str, phrase: str) -> Column:
    """Non-overlapping occurrences of a literal phrase; null counts as 0.

    Compares byte lengths with and without the phrase: no regular expression, no array of matches.
    """
    if not phrase:
        raise ValueError("empty phrase")
    text = F.col(column) if isinstance(column, str) else column
    without = F.replace(text, F.lit(phrase), F.lit(""))
    removed = F.octet_length(text) - F.octet_length(without)
    return F.coalesce((removed / len(phrase.encode())).cast("int"), F.lit(0))


def column_suffix(label: str, fallback: str) -> str:
    """A label as part of a column name: every run of other characters becomes one underscore."""
    return re.sub(r"\W+", "_", label).strip("_") or fallback


def token_counts(
    df: DataFrame,
    column: str,
    phrases: Iterable[str],
    prefix: str = "",
    suffix: str = "_Count",
    keep_source: bool = False,
) -> DataFrame:
    """One integer column per phrase: how often the text of ``column`` holds it."""
    counts = [
        phrase_count(column, phrase).alias(f"{prefix}{column_suffix(phrase, f'phrase_{i}')}{suffix}")
        for i, phrase in enumerate(phrases)
    ]
    kept = [F.col(c) for c in df.columns if keep_source or c != column]
    return df.select(*kept, *counts)
