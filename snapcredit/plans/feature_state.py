"""The feature store kept by state: a new month reads that month and the last state, not the history.

Below one root there are four tables:

* ``base``: encoded attributes and financials, one partition per month;
* ``sums``: per customer and month the sum and count of every click measure, one partition per month;
* ``starts``: the loan starts of a month, once per customer;
* ``newest``: per customer the newest loan start up to a month, one partition per month that was folded last
  (``as_of``).

Sums and counts add up and the newest start is a maximum, so states merge in any grouping of the months.
Whether clicks of a month count depends on the newest start of the customer, which later months move;
so it is decided when the store is read, by one equi-join, and no earlier partition is ever written again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.operators.features import KEYS, loan_starts
from snapcredit.plans import credit_tables as tables
from snapcredit.plans.medallion import encode_features
from snapcredit.sources.sinks import write_snapshots
from snapcredit.sources.snapshots import present_snapshots

CUSTOMER, SNAPSHOT = KEYS


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def month_sums(clicks: DataFrame, measures: Sequence[str] = tables.CLICK_MEASURES) -> DataFrame:
    """``(customer, snapshot, sum_<m>, n_<m>)``; sums and counts of parts add up to those of the whole."""
    known = clicks.where(F.col(CUSTOMER).isNotNull() & F.col(SNAPSHOT).isNotNull())
    return known.groupBy(*KEYS).agg(
        *[F.sum(m).alias(f"sum_{m}") for m in measures], *[F.count(m).alias(f"n_{m}") for m in measures]
    )


def _newest(starts: DataFrame) -> DataFrame:
    return starts.groupBy(CUSTOMER).agg(F.max("loan_start_date").alias("loan_start_date"))


def _table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of the store; None if nothing was ever written to it."""
    try:
        return spark.read.parquet(_path(root, name))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _folded(spark: SparkSession, root: str) -> list[dt.date]:
    """Months with a state, in order; read off the paths."""
    table = _table(spark, root, "newest")
    return sorted(r[0] for r in present_snapshots(table, "as_of").collect()) if table is not None else []


def _fold_newest(spark: SparkSession, root: str, month: dt.date, before: dt.date | None) -> None:
    """The state of a month: that of the one folded before it, and the starts since."""
    # A row without a customer marks the month, should no customer have a start yet.
    parts = [spark.createDataFrame([(None, None)], f"{CUSTOMER} string, loan_start_date date")]
    starts = _table(spark, root, "starts")
    if starts is not None:
        since = F.lit(True) if before is None else F.col(SNAPSHOT) > F.lit(before)
        parts.append(starts.where(since & (F.col(SNAPSHOT) <= F.lit(month))).select(CUSTOMER, "loan_start_date"))
    if before is not None:
        last = spark.read.parquet(_path(root, "newest")).where(F.col("as_of") == F.lit(before))
        parts.append(last.select(CUSTOMER, "loan_start_date"))
    kind = parts[-1].schema[CUSTOMER].dataType
    merged = reduce(DataFrame.unionByName, [p.withColumn(CUSTOMER, F.col(CUSTOMER).cast(kind)) for p in parts])
    write_snapshots(_newest(merged).withColumn("as_of", F.lit(month)), _path(root, "newest"), partition="as_of")


def fold(
    spark: SparkSession,
    root: str,
    first: str | dt.date,
    last: str | dt.date,
    attributes: DataFrame,
    financials: DataFrame,
    clicks: DataFrame,
    loans: DataFrame,
    measures: Sequence[str] = tables.CLICK_MEASURES,
) -> None:
    """Take the months from ``first`` to ``last`` into the store; months that were in it are replaced.

    Of the four tables only these months are read. The state of the last month is that of the month folded
    before, and the starts since. A correction of an old month folds the states after it forward again;
    these read states and starts only.
    """
    first, last = as_date(first), as_date(last)
    one = F.col(SNAPSHOT) == F.lit(first)  # shorter than a range: plans cut long filters off
    window = one if first == last else F.col(SNAPSHOT).between(F.lit(first), F.lit(last))
    base = attributes.where(window).join(financials.where(window), list(KEYS), "inner")
    write_snapshots(encode_features(base), _path(root, "base"))
    write_snapshots(month_sums(clicks.where(window), measures), _path(root, "sums"))
    starts = loan_starts(loans.where(window)).where(F.col(CUSTOMER).isNotNull()).distinct()
    write_snapshots(starts.withColumn(SNAPSHOT, F.col("loan_start_date")), _path(root, "starts"))
    states = sorted({*_folded(spark, root), last})
    for i, month in enumerate(states):
        if month >= first:
            _fold_newest(spark, root, month, states[i - 1] if i else None)


def read_features(
    spark: SparkSession, root: str, measures: Sequence[str] = tables.CLICK_MEASURES, as_of: str | dt.date | None = None
) -> DataFrame:
    """The feature store with the averages of clicks up to the newest loan start known at ``as_of`` (the last state).

    Rows of later months than ``as_of`` are not in it.
    """
    states = [d for d in _folded(spark, root) if as_of is None or d <= as_date(as_of)]
    if not states:
        raise ValueError(f"no state below {root} up to {as_of}")
    known = F.col(SNAPSHOT) <= F.lit(states[-1])
    base = spark.read.parquet(_path(root, "base")).where(known)
    newest = spark.read.parquet(_path(root, "newest")).where(F.col("as_of") == F.lit(states[-1])).drop("as_of")
    sums = _table(spark, root, "sums")
    if sums is None:
        return base.withColumns({f"{m}_avg": F.lit(0.0) for m in measures})
    counted = sums.where(known).join(newest, CUSTOMER).where(F.col(SNAPSHOT) <= F.col("loan_start_date"))
    averages = counted.select(
        *KEYS, *[F.try_divide(F.col(f"sum_{m}").cast("double"), F.col(f"n_{m}")).alias(f"{m}_avg") for m in measures]
    )
    return base.join(averages, list(KEYS), "left").fillna(0, [f"{m}_avg" for m in measures])
