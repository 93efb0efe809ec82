"""Registration, and the frames and SQL several bindings share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import snapshot_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if SQL can state its result, the SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exact_sum(column: str) -> Column:
    """A money sum that does not depend on the order of rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        snapshot_of("o_orderdate").alias("snapshot_date"),
    )


def ledger(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Line items as a loan ledger; whole amounts, so that rounding up is the same in every engine."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_suppkey").alias("Customer_ID"),
        snapshot_of("l_shipdate").alias("snapshot_date"),
        F.col("l_linenumber").alias("installment_num"),
        F.round(F.col("l_discount") * 100).cast("int").alias("due_amt"),
        F.round(F.col("l_tax") * 100).cast("int").alias("overdue_amt"),
        *extra,
    )


ORDERS_BY_MONTH = """
orders_by_month AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
         date_trunc('month', o_orderdate)::DATE AS snapshot_date
  FROM orders)"""

LEDGER = """
ledger AS (
  SELECT l_orderkey AS loan_id, l_suppkey AS Customer_ID,
         date_trunc('month', l_shipdate)::DATE AS snapshot_date, l_linenumber AS installment_num,
         round(l_discount * 100)::INT AS due_amt, round(l_tax * 100)::INT AS overdue_amt
  FROM lineitem),
missed AS (
  SELECT *, installment_num AS mob,
         CASE WHEN due_amt = 0 THEN 0 ELSE ceil(overdue_amt / due_amt)::INT END AS installments_missed
  FROM ledger),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN (snapshot_date - to_months(installments_missed))::DATE END AS first_missed_date
  FROM missed),
loans AS (
  SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                 ELSE 0 END::INT AS dpd
  FROM dated),
labels_gold AS (
  SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
         '30dpd_6mob' AS label_def, snapshot_date
  FROM loans WHERE mob = 6)"""
