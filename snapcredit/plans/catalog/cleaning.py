"""Casts, validators, deduplication, counters and profiles on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.casts import pattern_gated_cast, schema_enforce
from snapcredit.functions.text import duration_months, token_counts
from snapcredit.operators.quality import (
    Bounds,
    bool_default,
    dedup_latest,
    describe_profile,
    distinct_profile,
    domain_validate,
    drop_null_keys,
    fill_zero,
    latest_per_key,
    nonnull_profile,
    quality_counters,
    range_validate,
    row_reconcile,
)
from snapcredit.plans.catalog.base import query, rounded, table


def dirty_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their numbers as text, in the shapes source files have them."""
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    amount = (
        F.when(kind == 1, F.concat(F.lit("-"), size))
        .when(kind == 2, F.concat(size, F.lit(".0")))
        .when(kind == 3, F.concat(size, F.lit("_")))
        .when(kind == 4, F.lit(""))
        .otherwise(size)
    )
    flag = F.element_at(
        F.array(*[F.lit(v) for v in ("Yes", "No", "NM", "true", "1", "TRUE")]), (kind + 1).cast("int")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        amount.alias("amount"),
        F.concat((F.col("p_size") * 2).cast("string"), F.lit(".995")).alias("ratio"),
        flag.alias("flag"),
    )


DIRTY_PARTS = """
dirty AS (
  SELECT p_partkey,
    CASE p_partkey % 6 WHEN 1 THEN '-' || p_size WHEN 2 THEN p_size || '.0' WHEN 3 THEN p_size || '_'
         WHEN 4 THEN '' ELSE p_size::VARCHAR END AS amount,
    (p_size * 2) || '.995' AS ratio,
    ['Yes', 'No', 'NM', 'true', '1', 'TRUE'][(p_partkey % 6 + 1)::INT] AS flag
  FROM part)"""
DIRTY_TYPES = {"amount": "int", "ratio": "decimal(4,2)", "flag": "boolean"}


@query(
    "schema_enforce",
    f"""WITH {DIRTY_PARTS}
    SELECT p_partkey,
      CASE WHEN regexp_full_match(trim(amount), '[+-]?\\d+') THEN amount::INT END AS amount,
      try_cast(ratio AS DECIMAL(4,2))::DOUBLE AS ratio,
      CASE WHEN lower(flag) IN ('yes', 'true', '1') THEN true WHEN lower(flag) = 'no' THEN false END AS flag
    FROM dirty""",
)
def schema_enforce_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = schema_enforce(dirty_parts(spark, sf_dir), DIRTY_TYPES)
    return typed.withColumn("ratio", F.col("ratio").cast("double"))


@query(
    "pattern_gated_cast",
    f"""WITH {DIRTY_PARTS}
    SELECT p_partkey,
      CASE WHEN regexp_full_match(amount, '\\d+') THEN amount::INT END AS amount,
      try_cast(ratio AS DECIMAL(4,2))::DOUBLE AS ratio,
      CASE WHEN flag IN ('true', '1') THEN true END AS flag
    FROM dirty""",
)
def pattern_gated_cast_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = pattern_gated_cast(dirty_parts(spark, sf_dir), DIRTY_TYPES)
    return typed.withColumn("ratio", F.col("ratio").cast("double"))


def holey_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
    )


HOLEY_EVENTS = """
holey AS (
  SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id,
         nullif(event_type, 'error') AS event_type FROM events)"""


@query(
    "drop_null_keys_any",
    f"WITH {HOLEY_EVENTS} SELECT * FROM holey WHERE user_id IS NOT NULL AND event_type IS NOT NULL",
)
def drop_null_keys_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_keys(holey_events(spark, sf_dir), ["user_id", "event_type"])


@query(
    "drop_null_keys_all",
    f"WITH {HOLEY_EVENTS} SELECT * FROM holey WHERE user_id IS NOT NULL OR event_type IS NOT NULL",
)
def drop_null_keys_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_keys(holey_events(spark, sf_dir), ["user_id", "event_type"], "all")


@query(
    "fill_zero",
    """SELECT l_suppkey, count(*) FILTER (coalesce(nullif(l_discount, 0), 0) = 0) AS zero_discounts,
         count(*) FILTER (coalesce(nullif(l_tax, 0), 0) = 0) AS zero_taxes, count(*) AS n_filled
    FROM lineitem GROUP BY 1""",
)
def fill_zero_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    return (
        fill_zero(items, exclude=["l_suppkey"])
        .groupBy("l_suppkey")
        .agg(
            F.count_if(F.col("l_discount") == 0).alias("zero_discounts"),
            F.count_if(F.col("l_tax") == 0).alias("zero_taxes"),
            F.count(F.col("l_discount") + F.col("l_tax")).alias("n_filled"),
        )
    )


@query(
    "range_validate",
    """SELECT p_partkey, CASE WHEN p_size > 0 AND p_size < 25 THEN p_size ELSE 0 END AS size_open,
         CASE WHEN p_size BETWEEN 0 AND 25 THEN p_size ELSE 0 END AS size_closed,
         CASE WHEN p_retailprice > 1000 THEN p_retailprice ELSE 0 END AS p_retailprice
    FROM part""",
)
def range_validate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", size.alias("size_open"), size.alias("size_closed"), "p_retailprice"
    )
    rules = {
        "size_open": Bounds(0, 25),
        "size_closed": Bounds(0, 25, closed=True),
        "p_retailprice": Bounds(low=1000),
    }
    return range_validate(parts, rules)


@query(
    "range_validate_balance",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS c_acctbal FROM customer""",
)
def range_validate_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return range_validate(customers, {"c_acctbal": Bounds(low=0)})


SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


@query(
    "domain_validate",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
         THEN c_mktsegment ELSE 'Unknown' END AS c_mktsegment FROM customer""",
)
def domain_validate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return domain_validate(customers, {"c_mktsegment": (SEGMENTS, "Unknown")})


@query(
    "bool_default",
    """SELECT o_orderkey, coalesce(o_orderstatus = 'F', false) AS paid FROM orders""",
)
def bool_default_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(text, F.lit("NM")).alias("paid")
    )
    return bool_default(schema_enforce(orders, {"paid": "boolean"}), ["paid"])


@query("pii_drop", "SELECT * EXCLUDE (c_name) FROM customer")
def pii_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").drop("c_name")


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "ts", "event_type", "value"
    )


@query(
    "dedup_latest",
    """SELECT event_id, user_id, ts::DATE AS day, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir)
    return dedup_latest(events, ["user_id", "day"], ["ts", "event_id"]).drop("ts")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    return latest_per_key(orders, ["o_custkey"], [F.desc("day"), F.desc("o_orderkey")])


@query(
    "row_reconcile",
    """WITH kept AS (SELECT event_type FROM events QUALIFY
      row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1)
    SELECT event_type, rows_before, rows_after, rows_before - rows_after AS rows_removed
    FROM (SELECT event_type, count(*) AS rows_before FROM events GROUP BY 1)
    LEFT JOIN (SELECT event_type, count(*) AS rows_after FROM kept GROUP BY 1) USING (event_type)""",
)
def row_reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir)
    kept = dedup_latest(events, ["user_id", "day"], ["ts", "event_id"])
    return row_reconcile(events, kept, ["event_type"])


@query(
    "quality_counters",
    """SELECT c_mktsegment, count(*) AS n_rows, count(*) FILTER (c_acctbal <= 0) AS bad_balance,
         count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')) AS defaulted
    FROM customer GROUP BY 1""",
)
def quality_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {
        "bad_balance": F.col("c_acctbal") <= 0,
        "defaulted": ~F.col("c_mktsegment").isin(SEGMENTS),
    }
    return quality_counters(table(spark, sf_dir, "customer"), checks, by=["c_mktsegment"])


@query(
    "nonnull_profile",
    f"""WITH {HOLEY_EVENTS}
    SELECT 'event_id' AS column_name, count(*) AS n_rows, count(event_id) AS non_null,
           'bigint' AS data_type FROM holey
    UNION ALL SELECT 'user_id', count(*), count(user_id), 'bigint' FROM holey
    UNION ALL SELECT 'event_type', count(*), count(event_type), 'string' FROM holey""",
)
def nonnull_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nonnull_profile(holey_events(spark, sf_dir))


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS stddev, min({column})::DOUBLE AS min_value,
      max({column})::DOUBLE AS max_value FROM part"""


@query(
    "describe_profile",
    " UNION ALL ".join(_described(c) for c in ("p_partkey", "p_size", "p_retailprice")),
)
def describe_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe_profile(table(spark, sf_dir, "part")), 6, "mean", "stddev")


PROFILED = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "distinct_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM customer" for c in PROFILED
    ),
)
def distinct_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_profile(table(spark, sf_dir, "customer"), PROFILED)


@query(
    "parse_duration_months",
    """SELECT p_partkey, CASE p_partkey % 5
      WHEN 0 THEN p_size * 12 + p_partkey % 12 WHEN 1 THEN p_size * 12 WHEN 2 THEN p_partkey % 12
      ELSE 0 END::INT AS months FROM part""",
)
def parse_duration_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 5
    years = F.concat(F.col("p_size").cast("string"), F.lit(" Years"))
    months = F.concat((F.col("p_partkey") % 12).cast("string"), F.lit(" Months"))
    text = (
        F.when(kind == 0, F.concat(years, F.lit(" and "), months))
        .when(kind == 1, years)
        .when(kind == 2, months)
        .when(kind == 3, "NA")
    )
    return table(spark, sf_dir, "part").select("p_partkey", duration_months(text).alias("months"))


PHRASES = ["the", "and", "retitioning", ". In", "C++ (x)"]


def _counted(column: str, phrase: str, output: str) -> str:
    quoted = phrase.replace("'", "''")
    return (
        f"((length({column}) - length(replace({column}, '{quoted}', ''))) / {len(phrase)})::INT "
        f"AS {output}"
    )


@query(
    "token_counts",
    "SELECT doc_id, lang, "
    + ", ".join(
        _counted("text", phrase, name)
        for phrase, name in zip(
            PHRASES, ["n_the_Count", "n_and_Count", "n_retitioning_Count", "n_In_Count", "n_C_x_Count"]
        )
    )
    + " FROM documents",
)
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return token_counts(documents, "text", PHRASES, prefix="n_")


@query(
    "token_counts_names",
    "SELECT p_partkey, "
    + _counted("p_name", "red", "n_red")
    + ", "
    + _counted("p_name", "ring", "n_ring")
    + " FROM part",
)
def token_counts_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return token_counts(parts, "p_name", ["red", "ring"], prefix="n_", suffix="")
