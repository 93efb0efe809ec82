"""Joining cleaned tables to a feature store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.operators.joins import asof_latest, range_join_avg

KEYS = ("Customer_ID", "snapshot_date")


def loan_starts(loans: DataFrame, customer: str = "Customer_ID", snapshot: str = "snapshot_date") -> DataFrame:
    """Customer and snapshot of each loan's start: months on book = 0."""
    return loans.where(F.col("mob") == 0).select(customer, F.col(snapshot).alias("loan_start_date"))


def join_feature_tables(
    attributes: DataFrame,
    financials: DataFrame,
    clicks: DataFrame,
    loans: DataFrame,
    measures: Sequence[str],
) -> DataFrame:
    """Attributes and financials of the same key and snapshot, with averaged clicks where there are any.

    Clicks count up to a loan start of the customer. All snapshots are joined at once.
    """
    customer, snapshot = KEYS
    averaged = range_join_avg(
        clicks, loan_starts(loans), customer, snapshot, "loan_start_date", measures
    )
    return attributes.join(financials, list(KEYS), "inner").join(averaged, list(KEYS), "left")


def asof_feature_tables(
    clicks: DataFrame, attributes: DataFrame, financials: DataFrame
) -> DataFrame:
    """The other form: every click row with the latest attributes and financials known by then."""
    customer, snapshot = KEYS
    with_attributes = asof_latest(clicks, attributes, customer, snapshot, snapshot)
    return asof_latest(with_attributes, financials, customer, snapshot, snapshot)
