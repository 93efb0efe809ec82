"""Joins, the window and the loan ledger on the sample tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import snapshot_of
from snapcredit.operators.aggregates import columns_like, corr_matrix, label_ratio, multi_avg
from snapcredit.operators.credit import create_label, delinquency, vintage_bad_rate
from snapcredit.operators.history import asof_intervals, merge_intervals, validity_intervals
from snapcredit.operators.joins import asof_latest, delayed_label_join, label_join, range_join_avg
from snapcredit.operators.quality import quality_counters
from snapcredit.plans.catalog.base import (
    LEDGER,
    ORACLES,
    ORDERS_BY_MONTH,
    exact_sum,
    ledger,
    orders_by_month,
    query,
    rounded,
    table,
)
from snapcredit.session import scratch_path
from snapcredit.sources.stores import bucket_count, colocate, write_bucketed

LEDGER_COLUMNS = (
    "loan_id, Customer_ID, snapshot_date, installment_num, due_amt, overdue_amt, mob, "
    "installments_missed, first_missed_date, dpd"
)


@query("delinquency", f"WITH {LEDGER} SELECT {LEDGER_COLUMNS} FROM loans")
def delinquency_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delinquency(ledger(spark, sf_dir))


@query(
    "quality_counters_ledger",
    f"""WITH {LEDGER}
    SELECT snapshot_date, count(*) AS n_rows, count(*) FILTER (dpd IS NULL) AS never_due,
           count(*) FILTER (installments_missed > 0) AS behind, count(*) FILTER (dpd >= 30) AS late
    FROM loans GROUP BY 1""",
)
def quality_counters_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overdue amounts that were never due stay visible here: their days past due are unknown."""
    checks = {
        "never_due": F.col("dpd").isNull(),
        "behind": F.col("installments_missed") > 0,
        "late": F.col("dpd") >= 30,
    }
    return quality_counters(delinquency(ledger(spark, sf_dir)), checks, by=["snapshot_date"])


@query("label_store", f"WITH {LEDGER} SELECT * FROM labels_gold")
def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return create_label(delinquency(ledger(spark, sf_dir)))


@query(
    "vintage_bad_rate",
    f"""WITH {LEDGER}
    SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate, count(*) AS n
    FROM loans WHERE (snapshot_date - to_months(mob))::DATE < DATE '2000-01-01' GROUP BY 1""",
)
def vintage_bad_rate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = delinquency(ledger(spark, sf_dir)).withColumn(
        "loan_start_date", F.add_months("snapshot_date", -F.col("mob"))
    )
    return vintage_bad_rate(loans, started_before="2000-01-01")


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orders_by_month(spark, sf_dir)
        .groupBy("o_custkey", "snapshot_date")
        .agg(exact_sum("o_totalprice").alias("total"))
    )


def monthly_urgent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orders_by_month(spark, sf_dir)
        .where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey", "snapshot_date")
        .agg(F.count("*").alias("n_urgent"))
    )


MONTHLY = f"""{ORDERS_BY_MONTH},
monthly_totals AS (
  SELECT o_custkey, snapshot_date, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
  FROM orders_by_month GROUP BY 1, 2),
monthly_urgent AS (
  SELECT o_custkey, snapshot_date, count(*) AS n_urgent
  FROM orders_by_month WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)"""


@query(
    "join_inner_composite",
    f"WITH {MONTHLY} SELECT * FROM monthly_totals JOIN monthly_urgent USING (o_custkey, snapshot_date)",
)
def join_inner_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_custkey", "snapshot_date"]
    return monthly_totals(spark, sf_dir).join(monthly_urgent(spark, sf_dir), keys, "inner")


@query("join_colocated", ORACLES["join_inner_composite"])
def join_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join of two stores bucketed by customer."""
    colocate(spark)
    totals, urgent = monthly_totals(spark, sf_dir), monthly_urgent(spark, sf_dir)
    buckets = bucket_count(totals.count())
    left, right = (
        write_bucketed(df, f"{name}_{uuid4().hex}", scratch_path(spark, name), buckets, "o_custkey", ["snapshot_date"])
        for name, df in (("monthly_totals", totals), ("monthly_urgent", urgent))
    )
    return left.join(right, ["o_custkey", "snapshot_date"], "inner")


@query(
    "join_left_composite",
    f"""WITH {MONTHLY}
    SELECT * FROM monthly_totals LEFT JOIN monthly_urgent USING (o_custkey, snapshot_date)""",
)
def join_left_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_custkey", "snapshot_date"]
    return monthly_totals(spark, sf_dir).join(monthly_urgent(spark, sf_dir), keys, "left")


# Measures in whole units, whose averages are the same double in every engine.
WHOLE_MEASURES = {
    "quantity": ("l_quantity", 1),
    "cents": ("l_extendedprice", 100),
    "discount_pct": ("l_discount", 100),
    "tax_pct": ("l_tax", 100),
}


def whole_measures(*names: str) -> list[Column]:
    chosen = {n: WHOLE_MEASURES[n] for n in names or WHOLE_MEASURES}
    return [F.round(F.col(c) * unit).cast("long").alias(n) for n, (c, unit) in chosen.items()]


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer and the snapshot of shipping."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            *whole_measures("quantity", "cents"),
            snapshot_of("l_shipdate").alias("snapshot_date"),
        )
        .join(orders, "o_orderkey")
        .drop("o_orderkey")
    )


def urgent_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orders_by_month(spark, sf_dir)
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select("o_custkey", F.col("snapshot_date").alias("start_date"))
    )


SHIPMENT_PAIRS = f"""{ORDERS_BY_MONTH},
shipments AS (
  SELECT o_custkey, l_quantity::BIGINT AS quantity, round(l_extendedprice * 100)::BIGINT AS cents,
         date_trunc('month', l_shipdate)::DATE AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pairs AS (
  SELECT s.* FROM shipments s JOIN orders_by_month o
    ON s.o_custkey = o.o_custkey AND s.snapshot_date <= o.snapshot_date
  WHERE o.o_orderpriority = '1-URGENT')"""
PAIR_AVERAGES = "avg(quantity) AS quantity_avg, avg(cents) AS cents_avg"


def _range_join(spark: SparkSession, sf_dir: str, group_by: list[str]) -> DataFrame:
    return range_join_avg(
        shipments(spark, sf_dir),
        urgent_starts(spark, sf_dir),
        "o_custkey",
        "snapshot_date",
        "start_date",
        ["quantity", "cents"],
        group_by,
    )


@query(
    "range_join_agg",
    f"WITH {SHIPMENT_PAIRS} SELECT o_custkey, snapshot_date, {PAIR_AVERAGES} FROM pairs GROUP BY 1, 2",
)
def range_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _range_join(spark, sf_dir, ["o_custkey", "snapshot_date"])


@query(
    "range_join_agg_by_key",
    f"WITH {SHIPMENT_PAIRS} SELECT o_custkey, {PAIR_AVERAGES} FROM pairs GROUP BY 1",
)
def range_join_agg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _range_join(spark, sf_dir, ["o_custkey"])


def past_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events moved into the years of the orders."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("o_custkey"), (F.col("ts") - F.expr("interval 28 years")).alias("ts"), "value"
    )


ASOF_EVENTS = """WITH past AS (
      SELECT event_id, user_id AS o_custkey, ts - INTERVAL 28 YEAR AS ts FROM events),
    latest AS (
      SELECT event_id, o_orderkey, o_totalprice, o_orderdate,
             row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM past LEFT JOIN orders ON past.o_custkey = orders.o_custkey AND o_orderdate <= ts)
    SELECT event_id, o_orderkey, o_totalprice, o_orderdate::DATE AS matched_day FROM latest WHERE rn = 1"""


def _asof_events(spark: SparkSession, sf_dir: str, time_slice: str | None) -> DataFrame:
    events = past_events(spark, sf_dir).select("event_id", "o_custkey", "ts")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
    )
    matched = asof_latest(
        events,
        orders,
        "o_custkey",
        "ts",
        "o_orderdate",
        tie_break=["o_orderkey"],
        time_slice=time_slice,
        matched_time="matched",
    )
    return matched.select(
        "event_id", "o_orderkey", "o_totalprice", F.to_date("matched").alias("matched_day")
    )


@query("asof_latest", ASOF_EVENTS)
def asof_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof_events(spark, sf_dir, None)


@query("asof_latest_sliced", ASOF_EVENTS)
def asof_latest_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In slices of a month instead of a day."""
    return _asof_events(spark, sf_dir, "month")


@query("asof_intervals", ASOF_EVENTS)
def asof_intervals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from intervals: orders before 1998 first, the later ones merged in."""
    events = past_events(spark, sf_dir).select("event_id", "o_custkey", "ts")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("matched_day")
    )
    early = F.col("o_orderdate") < "1998-01-01"
    history = validity_intervals(orders.where(early), "o_custkey", "o_orderdate", tie_break=["o_orderkey"])
    path = scratch_path(spark, "order_history")
    merge_intervals(history, orders.where(~early), "o_custkey", "o_orderdate", ["o_orderkey"]).write.parquet(path)
    matched = asof_intervals(events, spark.read.parquet(path), "o_custkey", "ts")
    return matched.select("event_id", "o_orderkey", "o_totalprice", "matched_day")


@query(
    "validity_intervals",
    """WITH days AS (
      SELECT o_custkey, o_orderdate::DATE AS day, o_orderpriority AS priority FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderpriority DESC) = 1),
    changes AS (
      SELECT * FROM days WINDOW w AS (PARTITION BY o_custkey ORDER BY day)
      QUALIFY coalesce(lag(priority) OVER w <> priority, true))
    SELECT o_custkey, day AS valid_from, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS valid_to, priority
    FROM changes""",
)
def validity_intervals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the priority of a customer's orders changed."""
    days = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority")
    )
    return validity_intervals(days, "o_custkey", "day")


@query(
    "asof_date_vs_timestamp",
    """WITH past AS (
      SELECT event_id, user_id AS o_custkey, (ts - INTERVAL 28 YEAR)::DATE AS day FROM events),
    timed AS (SELECT o_custkey, o_orderdate::TIMESTAMP + INTERVAL 5 HOUR AS placed, o_orderkey FROM orders),
    latest AS (
      SELECT event_id, day, o_orderkey, placed::DATE AS placed_day,
             row_number() OVER (PARTITION BY event_id ORDER BY placed DESC, o_orderkey DESC) AS rn
      FROM past LEFT JOIN timed ON past.o_custkey = timed.o_custkey AND placed <= day)
    SELECT event_id, day, o_orderkey, placed_day FROM latest WHERE rn = 1""",
)
def asof_date_vs_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates on the left, times of day on the right: an order of the same day is not known yet."""
    events = past_events(spark, sf_dir).select("event_id", "o_custkey", F.to_date("ts").alias("day"))
    placed = F.col("o_orderdate").cast("timestamp") + F.expr("interval 5 hours")
    orders = table(spark, sf_dir, "orders").select("o_custkey", placed.alias("placed"), "o_orderkey")
    matched = asof_latest(
        events, orders, "o_custkey", "day", "placed", tie_break=["o_orderkey"], matched_time="at"
    )
    return matched.select("event_id", "day", "o_orderkey", F.to_date("at").alias("placed_day"))


@query(
    "asof_chain",
    f"""WITH {MONTHLY},
    daily AS (SELECT user_id, (ts - INTERVAL 28 YEAR)::DATE AS day,
                     sum(value::DECIMAL(18,2))::DOUBLE AS day_value
              FROM events GROUP BY 1, 2),
    balanced AS (
      SELECT o.o_orderkey, o.o_custkey, o.o_orderdate::DATE AS day, m.total,
             row_number() OVER (PARTITION BY o.o_orderkey ORDER BY m.snapshot_date DESC) AS rn
      FROM orders o LEFT JOIN monthly_totals m
        ON o.o_custkey = m.o_custkey AND m.snapshot_date <= o.o_orderdate::DATE),
    chained AS (
      SELECT b.o_orderkey, b.total, d.day_value,
             row_number() OVER (PARTITION BY b.o_orderkey ORDER BY d.day DESC) AS rn
      FROM balanced b LEFT JOIN daily d ON b.o_custkey = d.user_id AND d.day <= b.day
      WHERE b.rn = 1)
    SELECT o_orderkey, total, day_value FROM chained WHERE rn = 1""",
)
def asof_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day")
    )
    daily = (
        past_events(spark, sf_dir)
        .groupBy("o_custkey", F.to_date("ts").alias("event_day"))
        .agg(exact_sum("value").alias("day_value"))
    )
    balanced = asof_latest(orders, monthly_totals(spark, sf_dir), "o_custkey", "day", "snapshot_date")
    chained = asof_latest(balanced, daily, "o_custkey", "day", "event_day")
    return chained.select("o_orderkey", "total", "day_value")


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("Customer_ID"),
        snapshot_of("l_shipdate").alias("snapshot_date"),
        *whole_measures(),
    )
    return multi_avg(items, ["Customer_ID", "snapshot_date"], list(WHOLE_MEASURES))


SUPPLIER_MONTHS = """
supplier_months AS (
  SELECT l_suppkey AS Customer_ID, date_trunc('month', l_shipdate)::DATE AS snapshot_date,
         avg(l_quantity::BIGINT) AS quantity_avg, avg(round(l_extendedprice * 100)::BIGINT) AS cents_avg,
         avg(round(l_discount * 100)::BIGINT) AS discount_pct_avg,
         avg(round(l_tax * 100)::BIGINT) AS tax_pct_avg
  FROM lineitem GROUP BY 1, 2)"""


@query("multi_avg", f"WITH {SUPPLIER_MONTHS} SELECT * FROM supplier_months")
def multi_avg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_months(spark, sf_dir)


AVERAGES = [f"{m}_avg" for m in WHOLE_MEASURES]


@query(
    "corr_matrix_by_suffix",
    f"WITH {SUPPLIER_MONTHS} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS corr FROM supplier_months"
        for x in AVERAGES
        for y in AVERAGES
    ),
)
def corr_matrix_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = supplier_months(spark, sf_dir)
    return rounded(corr_matrix(averaged, columns_like(averaged, suffix="_avg")), 6, "corr")


@query(
    "label_join",
    f"""WITH {LEDGER}, {SUPPLIER_MONTHS},
    newest AS (SELECT Customer_ID, label FROM labels_gold QUALIFY row_number() OVER (
      PARTITION BY Customer_ID ORDER BY snapshot_date DESC, loan_id DESC, label DESC) = 1)
    SELECT Customer_ID, snapshot_date, quantity_avg, label
    FROM supplier_months JOIN newest USING (Customer_ID)""",
)
def label_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = supplier_months(spark, sf_dir).select("Customer_ID", "snapshot_date", "quantity_avg")
    return label_join(features, label_store(spark, sf_dir), one_label_per_key=True)


def scored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in predictions: the average quantity of a supplier and month."""
    return supplier_months(spark, sf_dir).select(
        "Customer_ID", "snapshot_date", F.col("quantity_avg").alias("score")
    )


@query(
    "delayed_label_join",
    f"""WITH {LEDGER}, {SUPPLIER_MONTHS}
    SELECT s.Customer_ID, s.snapshot_date, l.snapshot_date AS label_snapshot,
           s.quantity_avg AS score, l.label
    FROM supplier_months s JOIN labels_gold l ON s.Customer_ID = l.Customer_ID
      AND s.snapshot_date = (l.snapshot_date - INTERVAL 6 MONTH)::DATE""",
)
def delayed_label_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delayed_label_join(scored_months(spark, sf_dir), label_store(spark, sf_dir))


@query(
    "label_ratio",
    f"""WITH {LEDGER}
    SELECT snapshot_date, count(*) AS n_rows, avg(label) AS label_ratio
    FROM labels_gold GROUP BY 1""",
)
def label_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_ratio(label_store(spark, sf_dir), by=["snapshot_date"])
