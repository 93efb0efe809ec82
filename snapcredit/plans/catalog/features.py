"""Encoders, the feature store, scaling, correlations and splits on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import snapshot_of
from snapcredit.operators.aggregates import corr_matrix, top_k
from snapcredit.operators.correlations import corr_matrix_blocked
from snapcredit.operators.encoders import extend_dictionary, one_hot, string_index
from snapcredit.operators.joins import range_join_avg
from snapcredit.operators.quality import fill_zero
from snapcredit.operators.scaling import apply_scaler, fit_scaler
from snapcredit.operators.splits import (
    date_window_split,
    hash_split,
    oot_split,
    stratified_split,
    training_sets,
)
from snapcredit.plans.catalog.base import (
    ORDERS_BY_MONTH,
    exact_sum,
    orders_by_month,
    query,
    rounded,
    table,
)
from snapcredit.plans.catalog.joining import SHIPMENT_PAIRS, shipments, urgent_starts
from snapcredit.session import scratch_path

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _index_sql(source: str, column: str, key: str) -> str:
    return f"""WITH ranked AS (
      SELECT {column}, (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS {column}_index
      FROM {source} GROUP BY 1)
    SELECT {key}, {column}, {column}_index FROM {source} JOIN ranked USING ({column})"""


@query(
    "string_index_versioned",
    f"""WITH {ORDERS_BY_MONTH},
    counted AS (
      SELECT o_custkey::VARCHAR AS category, snapshot_date, count(*) AS n FROM orders_by_month GROUP BY 1, 2),
    first AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY category ORDER BY snapshot_date) = 1)
    SELECT category, snapshot_date AS first_seen,
           row_number() OVER (ORDER BY snapshot_date >= DATE '1996-01-01', snapshot_date, n DESC, category) - 1 AS id
    FROM first""",
)
def string_index_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of customers after two loads, the second one of all months: the ids of the first load stand."""
    orders, path = orders_by_month(spark, sf_dir), scratch_path(spark, "customer_ids")
    extend_dictionary(spark, path, orders.where(F.col("snapshot_date") < "1996-01-01"), "o_custkey")
    extend_dictionary(spark, path, orders, "o_custkey")
    return spark.read.parquet(path)


@query("string_index", _index_sql("events", "event_type", "event_id"))
def string_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_index(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type")


@query("string_index_segment", _index_sql("customer", "c_mktsegment", "c_custkey"))
def string_index_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return string_index(customers, "c_mktsegment")


@query("string_index_large", _index_sql("part", "p_name", "p_partkey"))
def string_index_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly as many categories as rows."""
    return string_index(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name")


@query(
    "one_hot",
    "SELECT event_id, "
    + ", ".join(
        f"(event_type = '{t}')::INT AS event_type_{t}" for t in EVENT_TYPES if t != "error"
    )
    + " FROM events",
)
def one_hot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return one_hot(events, "event_type", EVENT_TYPES, drop_label="error")


@query(
    "feature_store",
    f"""WITH {SHIPMENT_PAIRS},
    attributes AS (
      SELECT DISTINCT o_custkey AS Customer_ID, snapshot_date, c_mktsegment, c_nationkey
      FROM orders_by_month JOIN customer ON o_custkey = c_custkey),
    financials AS (
      SELECT o_custkey AS Customer_ID, snapshot_date, count(*) AS n_orders,
             sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
      FROM orders_by_month GROUP BY 1, 2),
    clicks AS (
      SELECT o_custkey AS Customer_ID, snapshot_date, avg(quantity) AS quantity_avg,
             avg(cents) AS cents_avg
      FROM pairs GROUP BY 1, 2)
    SELECT Customer_ID, snapshot_date, c_nationkey, n_orders, total,
           coalesce(quantity_avg, 0) AS quantity_avg, coalesce(cents_avg, 0) AS cents_avg, """
    + ", ".join(
        f"(c_mktsegment = '{s}')::INT AS c_mktsegment_{s}" for s in SEGMENTS if s != "HOUSEHOLD"
    )
    + """
    FROM attributes JOIN financials USING (Customer_ID, snapshot_date)
    LEFT JOIN clicks USING (Customer_ID, snapshot_date)""",
)
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes and financials of a customer and month, with shipments up to an urgent order."""
    keys = ["Customer_ID", "snapshot_date"]
    orders = orders_by_month(spark, sf_dir).withColumnRenamed("o_custkey", "Customer_ID")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer_ID"), "c_mktsegment", "c_nationkey"
    )
    # counting per (customer, month) gives the financials and the distinct months in one aggregation
    financials = orders.groupBy(*keys).agg(
        F.count("*").alias("n_orders"), exact_sum("o_totalprice").alias("total")
    )
    averaged = range_join_avg(
        shipments(spark, sf_dir).withColumnRenamed("o_custkey", "Customer_ID"),
        urgent_starts(spark, sf_dir).withColumnRenamed("o_custkey", "Customer_ID"),
        "Customer_ID",
        "snapshot_date",
        "start_date",
        ["quantity", "cents"],
    )
    joined = financials.join(customers, "Customer_ID").join(averaged, keys, "left")
    encoded = one_hot(joined, "c_mktsegment", SEGMENTS, drop_label="HOUSEHOLD")
    return fill_zero(encoded, exclude=keys)


SPLIT_TOTALS = "count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total"
BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % 100"


def _by_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"))


@query(
    "oot_split",
    f"""WITH {ORDERS_BY_MONTH},
    aged AS (SELECT *, date_diff('month', snapshot_date, max(snapshot_date) OVER ()) AS age
             FROM orders_by_month)
    SELECT CASE WHEN age < 3 THEN 'oot_' || (3 - age) ELSE 'rest' END AS split, {SPLIT_TOTALS}
    FROM aged GROUP BY 1""",
)
def oot_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_split(oot_split(orders_by_month(spark, sf_dir), 3))


@query(
    "training_sets",
    f"""WITH {ORDERS_BY_MONTH},
    aged AS (SELECT *, date_diff('month', snapshot_date, max(snapshot_date) OVER ()) AS age,
                    {BUCKET.format("o_custkey || '|' || snapshot_date")} AS bucket
             FROM orders_by_month)
    SELECT CASE WHEN age < 3 THEN 'oot_' || (3 - age) WHEN bucket < 70 THEN 'training'
                WHEN bucket < 85 THEN 'validation' ELSE 'test' END AS split, {SPLIT_TOTALS}
    FROM aged GROUP BY 1""",
)
def training_sets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_split(training_sets(orders_by_month(spark, sf_dir), ["o_custkey", "snapshot_date"]))


@query(
    "date_window_split",
    f"""WITH {ORDERS_BY_MONTH}
    SELECT CASE WHEN snapshot_date < DATE '2000-07-01' THEN 'train_test' ELSE 'oot' END AS split,
           {SPLIT_TOTALS}
    FROM orders_by_month WHERE snapshot_date BETWEEN DATE '1999-07-01' AND DATE '2000-08-31'
    GROUP BY 1""",
)
def date_window_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_split(date_window_split(orders_by_month(spark, sf_dir), "2000-09-01"))


@query(
    "hash_split",
    f"""SELECT c_custkey, CASE WHEN {BUCKET.format("c_custkey::VARCHAR")} < 70 THEN 'training'
      WHEN {BUCKET.format("c_custkey::VARCHAR")} < 85 THEN 'validation' ELSE 'test' END AS split
    FROM customer""",
)
def hash_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"])


@query(
    "stratified_split",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '|'))
          <= ceil(count(*) OVER (PARTITION BY o_orderstatus) * 0.2)
      THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def stratified_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, ["o_orderkey"], "o_orderstatus")


SCALED = [f"{m}_scaled" for m in MEASURES]
IS_TRAINING = BUCKET.format("l_orderkey::VARCHAR") + " < 70"


@query(
    "standard_scale",
    "WITH fitted AS (SELECT "
    + ", ".join(f"avg({m}) AS m_{m}, stddev_pop({m}) AS s_{m}" for m in MEASURES)
    + f" FROM lineitem WHERE {IS_TRAINING}) SELECT l_suppkey, "
    + ", ".join(f"round(avg(({m} - m_{m}) / s_{m}), 6) AS {m}_scaled" for m in MEASURES)
    + " FROM lineitem, fitted GROUP BY 1",
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", *MEASURES)
    train = hash_split(items, ["l_orderkey"]).where(F.col("split") == "training")
    scaled = apply_scaler(items, fit_scaler(train, MEASURES), MEASURES, "_scaled")
    means = scaled.groupBy("l_suppkey").agg(*[F.avg(c).alias(c) for c in SCALED])
    return rounded(means, 6, *SCALED)


WIDE = {
    f"m{i}": expr
    for i, expr in enumerate(
        [*MEASURES, *[f"{m} * {m}" for m in MEASURES], *[f"CASE WHEN l_orderkey % {k} > 0 THEN {m} END" for k in (3, 5) for m in MEASURES]]
    )
}


@query(
    "corr_matrix_blocked",
    f"WITH wide AS (SELECT {', '.join(f'{e} AS {n}' for n, e in WIDE.items())} FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS corr FROM wide" for x in WIDE for y in WIDE),
)
def corr_matrix_blocked_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen columns, half of them with nulls, in blocks of five."""
    wide = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(n) for n, e in WIDE.items()])
    return rounded(corr_matrix_blocked(wide, list(WIDE), block=5), 6, "corr")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS corr FROM lineitem"
        for x in MEASURES
        for y in MEASURES
    ),
)
def corr_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(corr_matrix(table(spark, sf_dir, "lineitem"), MEASURES), 6, "corr")


NATION_SCORES = """scores AS (
  SELECT n_name AS feature,
         sum((c_acctbal - 4500)::DECIMAL(18,2))::DOUBLE / count(*) AS score
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""


@query(
    "feature_topk",
    f"""WITH {NATION_SCORES}
    (SELECT 'signed' AS ranking, * FROM scores ORDER BY score DESC, feature LIMIT 10)
    UNION ALL (SELECT 'absolute', * FROM scores ORDER BY abs(score) DESC, feature LIMIT 10)""",
)
def feature_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # balances are averaged per nation before the names are joined
    balance = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal") - 4500)
    scores = (
        balance.groupBy("c_nationkey")
        .agg((exact_sum("c_acctbal") / F.count("*")).alias("score"))
        .join(nations, "c_nationkey")
        .select(F.col("n_name").alias("feature"), "score")
    )
    signed = top_k(scores, "score", tie_break="feature")
    absolute = top_k(scores, "score", by_abs=True, tie_break="feature")
    ranking = F.lit("signed").alias("ranking"), F.lit("absolute").alias("ranking")
    return signed.select(ranking[0], "*").unionByName(absolute.select(ranking[1], "*"))


@query(
    "head_preview",
    f"""WITH {ORDERS_BY_MONTH}
    SELECT o_orderkey, snapshot_date, o_totalprice FROM orders_by_month
    ORDER BY snapshot_date, o_orderkey LIMIT 10""",
)
def head_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", snapshot_of("o_orderdate").alias("snapshot_date"), "o_totalprice"
    )
    return orders.orderBy("snapshot_date", "o_orderkey").limit(10)
