"""Scans, sinks, the month spine and backfill on the sample tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcredit.functions.dates import snapshot_of
from snapcredit.operators.splits import require_history
from snapcredit.plans.catalog.base import ORDERS_BY_MONTH, exact_sum, orders_by_month, query, table
from snapcredit.session import scratch_path
from snapcredit.sources.changes import backfill_changed
from snapcredit.sources.inference import month_kinds, type_evolution
from snapcredit.sources.scans import load_all, load_datasets, load_snapshot, read_csv
from snapcredit.sources.sinks import merge_metrics_log, read_metrics_log, write_snapshots
from snapcredit.sources.snapshots import backfill, missing_snapshots, month_spine, month_spine_of

ORDERS_SCHEMA = (
    "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, snapshot_date date"
)


@query("csv_bronze_roundtrip", f"WITH {ORDERS_BY_MONTH} SELECT * FROM orders_by_month")
def csv_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze_orders")
    write_snapshots(orders_by_month(spark, sf_dir), path, "csv")
    return read_csv(spark, path, ORDERS_SCHEMA)


@query(
    "snapshot_scan",
    f"WITH {ORDERS_BY_MONTH} SELECT * FROM orders_by_month WHERE snapshot_date = DATE '1998-03-01'",
)
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    write_snapshots(orders_by_month(spark, sf_dir), path)
    return load_snapshot(spark, path, "1998-03-01", "parquet")


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(
        F.count("*").alias("n_orders"), exact_sum("o_totalprice").alias("total")
    )


TOTALS = """SELECT snapshot_date, count(*) AS n_orders,
  sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders_by_month GROUP BY 1"""


@query("directory_scan", f"WITH {ORDERS_BY_MONTH} {TOTALS}")
def directory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    write_snapshots(orders_by_month(spark, sf_dir), path)
    return _totals(load_all(spark, path))


@query(
    "snapshot_overwrite_sink",
    f"""WITH {ORDERS_BY_MONTH}
    SELECT snapshot_date, count(*) AS n_orders,
           sum((o_totalprice * CASE WHEN snapshot_date = DATE '1997-05-01' THEN 2 ELSE 1 END)
               ::DECIMAL(18,2))::DOUBLE AS total
    FROM orders_by_month GROUP BY 1""",
)
def snapshot_overwrite_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    orders = orders_by_month(spark, sf_dir)
    write_snapshots(orders, path)
    doubled = orders.where(F.col("snapshot_date") == "1997-05-01")
    write_snapshots(doubled.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return _totals(load_all(spark, path, "parquet"))


@query(
    "month_spine",
    """WITH months AS (SELECT date_trunc('month', l_shipdate)::DATE AS snapshot_date, count(*) AS n
                       FROM lineitem GROUP BY 1),
    spine AS (SELECT unnest(generate_series(min(snapshot_date), max(snapshot_date),
                     INTERVAL 1 MONTH))::DATE AS snapshot_date FROM months)
    SELECT snapshot_date, coalesce(n, 0) AS n FROM spine LEFT JOIN months USING (snapshot_date)""",
)
def month_spine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(snapshot_of("l_shipdate").alias("snapshot_date"))
    per_month = shipped.groupBy("snapshot_date").agg(F.count("*").alias("n"))
    spine = month_spine_of(shipped, "snapshot_date")
    return spine.join(per_month, "snapshot_date", "left").fillna(0, subset=["n"])


@query(
    "missing_snapshots",
    """SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH))::DATE
         AS snapshot_date
    EXCEPT SELECT date_trunc('month', l_shipdate)::DATE FROM lineitem""",
)
def missing_snapshots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(snapshot_of("l_shipdate").alias("snapshot_date"))
    return missing_snapshots(shipped, month_spine(spark, "1995-01-01", "2001-12-01"))


@query("backfill_missing", f"WITH {ORDERS_BY_MONTH} {TOTALS}")
def backfill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = scratch_path(spark, "orders"), scratch_path(spark, "totals")
    write_snapshots(orders_by_month(spark, sf_dir), source)
    orders = load_all(spark, source, "parquet")
    write_snapshots(_totals(orders.where(F.month("snapshot_date") % 2 == 0)), path)
    backfill(orders, _totals, path, "1995-01-01", "2001-12-01")
    return load_all(spark, path, "parquet")


@query(
    "backfill_changed",
    f"""WITH {ORDERS_BY_MONTH},
    reloaded AS (
      SELECT *, o_totalprice * CASE WHEN snapshot_date = DATE '1997-05-01' THEN 2 ELSE 1 END AS price,
             CASE WHEN snapshot_date = DATE '1997-05-01' THEN true
                  WHEN snapshot_date >= DATE '2000-01-01' THEN true ELSE false END AS rebuilt
      FROM orders_by_month
      WHERE snapshot_date <> DATE '1996-02-01'
        AND NOT (snapshot_date = DATE '1998-07-01' AND o_orderkey % 2 = 0))
    SELECT snapshot_date, count(*) AS n_orders, sum(price::DECIMAL(18,2))::DOUBLE AS total,
           bool_or(rebuilt OR snapshot_date = DATE '1998-07-01') AS rebuilt
    FROM reloaded GROUP BY 1""",
)
def backfill_changed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink of the months before 2000; then one month is loaded again with other prices, one loses half its
    rows, one all of them, and the later months arrive."""
    source, path = scratch_path(spark, "orders"), scratch_path(spark, "totals")
    orders = orders_by_month(spark, sf_dir)
    month = F.col("snapshot_date")
    write_snapshots(orders.where(month < "2000-01-01"), source)
    backfill_changed(load_all(spark, source, "parquet"), _totals, path, "1995-01-01", "2001-12-01")
    doubled = F.when(month == "1997-05-01", 2 * F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    halved = orders.where(~((month == "1998-07-01") & (F.col("o_orderkey") % 2 == 0)))
    write_snapshots(halved.where(month != "1996-02-01").withColumn("o_totalprice", doubled), source, whole_table=True)
    rebuilt = backfill_changed(load_all(spark, source, "parquet"), _totals, path, "1995-01-01", "2001-12-01")
    return load_all(spark, path, "parquet").withColumn("rebuilt", month.isin(rebuilt))


@query(
    "union_by_name",
    f"""WITH {ORDERS_BY_MONTH}
    SELECT o_orderkey, snapshot_date, o_totalprice,
           CASE WHEN snapshot_date < DATE '1998-01-01' THEN o_custkey ELSE 0 END AS o_custkey
    FROM orders_by_month""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_month(spark, sf_dir).drop("o_orderpriority")
    old = orders.where(F.col("snapshot_date") < "1998-01-01")
    new = orders.where(F.col("snapshot_date") >= "1998-01-01").drop("o_custkey")
    return old.unionByName(new, allowMissingColumns=True).fillna(0, subset=["o_custkey"])


LOG_SCHEMA = "snapshot_date date, feature string, mean_curr double, auc double"


@query(
    "metrics_log_merge",
    f"""WITH {ORDERS_BY_MONTH},
    log AS (
      SELECT snapshot_date, 'o_totalprice' AS feature,
             sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean_curr
      FROM orders_by_month GROUP BY 1
      UNION ALL
      SELECT snapshot_date, 'o_custkey', sum(o_custkey)::DOUBLE / count(*)
      FROM orders_by_month GROUP BY 1),
    evaluation AS (
      SELECT snapshot_date, count(*) FILTER (o_orderpriority = '1-URGENT') / count(*) AS auc
      FROM orders_by_month WHERE year(snapshot_date) < 2001 GROUP BY 1)
    SELECT snapshot_date, feature, mean_curr, auc FROM log LEFT JOIN evaluation USING (snapshot_date)""",
)
def metrics_log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics_log")
    orders = orders_by_month(spark, sf_dir)
    means = orders.groupBy("snapshot_date").agg(
        (exact_sum("o_totalprice") / F.count("*")).alias("o_totalprice"),
        (F.sum("o_custkey").cast("double") / F.count("*")).alias("o_custkey"),
    )
    log = means.unpivot("snapshot_date", ["o_totalprice", "o_custkey"], "feature", "mean_curr")
    write_snapshots(log.withColumn("auc", F.lit(None).cast("double")), path, "json")
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT") / F.count("*")
    evaluation = (
        orders.where(F.year("snapshot_date") < 2001)
        .groupBy("snapshot_date")
        .agg(urgent.alias("auc"))
    )
    merge_metrics_log(spark, path, LOG_SCHEMA, evaluation)
    return read_metrics_log(spark, path, LOG_SCHEMA)


CLASSIFIED = """CASE WHEN trim(v) = '' THEN 0
      WHEN regexp_matches(v, '^[+-]?[0-9]+$') THEN CASE WHEN TRY_CAST(v AS INT) IS NOT NULL THEN 1 ELSE 2 END
      WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 3
      WHEN regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN 4 ELSE 5 END"""


def _narrowest(kinds: str) -> str:
    """The type of a set of the kinds above."""
    return (
        f"CASE WHEN {kinds} = 2 THEN 'int' WHEN {kinds} IN (4, 6) THEN 'bigint' "
        f"WHEN {kinds} > 0 AND {kinds} < 16 THEN 'double' WHEN {kinds} = 16 THEN 'date' ELSE 'string' END"
    )


@query(
    "csv_inferred",
    f"""WITH {ORDERS_BY_MONTH},
    texts AS (
      SELECT snapshot_date, unnest(['key', 'price', 'day', 'priority']) AS "column",
             unnest([CASE WHEN snapshot_date < DATE '1996-01-01' THEN o_orderkey::VARCHAR
                          WHEN snapshot_date < DATE '1997-01-01' THEN (o_orderkey + 5000000000)::VARCHAR
                          ELSE (o_orderkey + 0.5)::VARCHAR END,
                     CASE WHEN snapshot_date = DATE '1998-03-01' THEN 'n/a' ELSE round(o_totalprice)::BIGINT::VARCHAR END,
                     CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE snapshot_date::VARCHAR END,
                     o_orderpriority]) AS v
      FROM orders_by_month),
    kinds AS (SELECT snapshot_date, "column", {CLASSIFIED} AS k FROM texts),
    months AS (
      SELECT snapshot_date, "column", bit_or(1 << k) & ~1 AS b FROM kinds GROUP BY 1, 2),
    running AS (
      SELECT *, bit_or(b) OVER (PARTITION BY "column" ORDER BY snapshot_date) AS u FROM months),
    named AS (
      SELECT snapshot_date, "column", {_narrowest("b")} AS "type", {_narrowest("u")} AS upto FROM running)
    SELECT *, coalesce(lag(upto) OVER (PARTITION BY "column" ORDER BY snapshot_date) <> upto, false) AS widened FROM named""",
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of CSV columns per month: one widens from int to bigint to double, one to text in a single month."""
    path, month, key = scratch_path(spark, "texts"), F.col("snapshot_date"), F.col("o_orderkey")
    widening = (
        F.when(month < "1996-01-01", key.cast("string"))
        .when(month < "1997-01-01", (key + 5_000_000_000).cast("string"))
        .otherwise((key + F.lit(0.5)).cast("decimal(20,1)").cast("string"))
    )
    texts = orders_by_month(spark, sf_dir).select(
        "snapshot_date",
        widening.alias("key"),
        F.when(month == "1998-03-01", "n/a").otherwise(F.round("o_totalprice").cast("bigint").cast("string")).alias("price"),
        F.when(key % 7 == 0, "").otherwise(month.cast("string")).alias("day"),
        F.col("o_orderpriority").alias("priority"),
    )
    write_snapshots(texts, path, "csv")
    columns = ["key", "price", "day", "priority"]
    source = read_csv(spark, path, infer=False)
    return type_evolution(month_kinds(source, columns))


@query(
    "multi_path_scan",
    f"""WITH {ORDERS_BY_MONTH} SELECT year(snapshot_date)::INT AS year, count(*) AS n_orders,
      sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders_by_month WHERE year(snapshot_date) IN (1996, 1998)
      GROUP BY 1""",
)
def multi_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three folders, read together; their format is found by their files."""
    orders = orders_by_month(spark, sf_dir)
    paths = {}
    for year in (1996, 1997, 1998):
        paths[year] = scratch_path(spark, f"orders_{year}")
        write_snapshots(orders.where(F.year("snapshot_date") == year), paths[year])
    found = load_all(spark, [paths[1996], paths[1998]])
    return found.groupBy(F.year("snapshot_date").alias("year")).agg(
        F.count("*").alias("n_orders"), exact_sum("o_totalprice").alias("total")
    )


@query(
    "named_datasets",
    f"""WITH {ORDERS_BY_MONTH},
    named AS (
      SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'test' WHEN o_orderkey % 4 = 1 THEN 'validation' ELSE 'training' END AS name
      FROM orders_by_month)
    SELECT layout, name, count(*) AS n_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
    FROM named, (SELECT unnest(['folders', 'partitions']) AS layout) GROUP BY 1, 2""",
)
def named_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same named sets in both layouts, found by the library and read by their names."""
    rest = F.col("o_orderkey") % 4
    name = F.when(rest == 0, "test").when(rest == 1, "validation").otherwise("training")
    orders = orders_by_month(spark, sf_dir).withColumn("split", name)
    paths = {layout: scratch_path(spark, layout) for layout in ("partitions", "folders")}
    write_snapshots(orders, paths["partitions"], partition="split")
    for part in ("training", "validation", "test"):
        orders.where(name == part).drop("split").write.parquet(f"{paths['folders']}/{part}.parquet")
    found = [
        df.agg(F.count("*").alias("n_orders"), exact_sum("o_totalprice").alias("total"))
        .select(F.lit(layout).alias("layout"), F.lit(part).alias("name"), "n_orders", "total")
        for layout, path in paths.items()
        for part, df in load_datasets(spark, path).items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "minimum_history",
    f"""WITH {ORDERS_BY_MONTH},
    months AS (SELECT DISTINCT snapshot_date FROM orders_by_month),
    ranges AS (
      SELECT start, n_oot, (SELECT count(*) FROM months WHERE snapshot_date >= start) AS n_snapshots
      FROM (SELECT snapshot_date AS start FROM months), (SELECT unnest([0, 3, 6])::INT AS n_oot))
    SELECT start, n_oot, n_snapshots, n_snapshots - n_oot >= 12 AS enough FROM ranges""",
)
def minimum_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the history from each month on leaves enough snapshots for training."""
    months = orders_by_month(spark, sf_dir).select("snapshot_date").distinct()
    newest_first = Window.orderBy(F.col("snapshot_date").desc())  # one row per month
    sized = months.select(F.col("snapshot_date").alias("start"), F.row_number().over(newest_first).cast("long").alias("n"))

    def enough(n: int, n_oot: int) -> bool:
        try:
            require_history(n, n_oot)
        except ValueError:
            return False
        return True

    rows = [(r.start, n_oot, r.n, enough(r.n, n_oot)) for r in sized.collect() for n_oot in (0, 3, 6)]
    return spark.createDataFrame(rows, "start date, n_oot int, n_snapshots long, enough boolean")
