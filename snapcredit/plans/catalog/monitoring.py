"""Drift and evaluation on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.dates import snapshot_of
from snapcredit.operators.drift import drift_report, ks_two_sample, population_moments, psi
from snapcredit.operators.evaluation import auc_exact, delayed_auc, gini_by_split
from snapcredit.operators.profiles import drift_of_profiles, value_profile
from snapcredit.operators.splits import hash_split
from snapcredit.plans.catalog.base import LEDGER, ORACLES, query, rounded, table
from snapcredit.plans.catalog.features import BUCKET, MEASURES
from snapcredit.plans.catalog.joining import SUPPLIER_MONTHS, label_store, scored_months
from snapcredit.session import scratch_path
from snapcredit.sources.sinks import write_snapshots


def populations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items returned with flag A as reference, with flag R as current population."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", *MEASURES, (F.col("l_discount") > 0.05).cast("int").alias("prediction")
    )
    return tuple(items.where(F.col("l_returnflag") == f).drop("l_returnflag") for f in ("A", "R"))


LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS feature, {m} AS v, l_returnflag AS flag FROM lineitem "
    "WHERE l_returnflag IN ('A', 'R')"
    for m in MEASURES
) + ")"


def _psi_sql(own: bool) -> str:
    edge_flag = "long.flag" if own else "'A'"
    return f"""bounds AS (SELECT feature, flag, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2),
    bucketed AS (
      SELECT long.feature, long.flag,
             1 + {" + ".join(f"(v >= {i} * ((hi - lo) / 10) + lo)::INT" for i in range(1, 10))} AS bucket
      FROM long JOIN bounds ON long.feature = bounds.feature AND bounds.flag = {edge_flag}),
    counted AS (
      SELECT feature, bucket, count(*) FILTER (flag = 'A') AS a, count(*) FILTER (flag = 'R') AS r
      FROM bucketed GROUP BY 1, 2),
    shares AS (
      SELECT feature, a / nullif(sum(a) OVER (PARTITION BY feature), 0) AS p,
             r / nullif(sum(r) OVER (PARTITION BY feature), 0) AS q FROM counted),
    psi AS (
      SELECT feature, round(sum((p - q) * ln((p + 1e-6) / (q + 1e-6))), 8) AS psi
      FROM shares GROUP BY 1)"""


KS = """counts AS (
  SELECT feature, v, count(*) FILTER (flag = 'A') AS a, count(*) FILTER (flag = 'R') AS r
  FROM long GROUP BY 1, 2),
cdf AS (
  SELECT feature,
    sum(a) OVER (PARTITION BY feature ORDER BY v) / nullif(sum(a) OVER (PARTITION BY feature), 0) AS fa,
    sum(r) OVER (PARTITION BY feature ORDER BY v) / nullif(sum(r) OVER (PARTITION BY feature), 0) AS fr
  FROM counts),
ks AS (SELECT feature, round(max(abs(fa - fr)), 8) AS ks FROM cdf GROUP BY 1)"""


def _moments_sql(digits: int) -> str:
    cells = [
        f"round({f}(v) FILTER (flag = '{flag}'), {digits}) AS {name}_{side}"
        for name, f in (("mean", "avg"), ("std", "stddev_pop"))
        for flag, side in (("A", "train"), ("R", "curr"))
    ]
    return f"moments AS (SELECT feature, {', '.join(cells)} FROM long GROUP BY 1)"


MOMENT_COLUMNS = ("mean_train", "mean_curr", "std_train", "std_curr")


@query("psi", f"WITH {LONG}, {_psi_sql(own=False)} SELECT * FROM psi")
def psi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(psi(*populations(spark, sf_dir), MEASURES), 8, "psi")


@query("psi_own_bins", f"WITH {LONG}, {_psi_sql(own=True)} SELECT * FROM psi")
def psi_own_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(psi(*populations(spark, sf_dir), MEASURES, bins="own"), 8, "psi")


@query("ks_two_sample", f"WITH {LONG}, {KS} SELECT * FROM ks")
def ks_two_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ks_two_sample(*populations(spark, sf_dir), MEASURES), 8, "ks")


@query("ks_two_sample_sliced", f"WITH {LONG}, {KS} SELECT * FROM ks")
def ks_two_sample_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statistic over many more slices than the rows ask for."""
    return rounded(ks_two_sample(*populations(spark, sf_dir), MEASURES, slices=64), 8, "ks")


@query("population_moments", f"WITH {LONG}, {_moments_sql(4)} SELECT * FROM moments")
def population_moments_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = population_moments(*populations(spark, sf_dir), MEASURES)
    return rounded(moments, 4, *MOMENT_COLUMNS)


@query(
    "drift_report",
    f"""WITH {LONG}, {_psi_sql(own=False)}, {KS}, {_moments_sql(4)}
    SELECT feature, psi, ks, mean_train, mean_curr, std_train, std_curr,
           (SELECT round(avg((l_discount > 0.05)::INT), 6) FROM lineitem WHERE l_returnflag = 'R')
             AS label_ratio
    FROM moments JOIN psi USING (feature) JOIN ks USING (feature)""",
)
def drift_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = drift_report(*populations(spark, sf_dir), MEASURES)
    return rounded(
        rounded(rounded(report, 8, "psi", "ks"), 4, *MOMENT_COLUMNS), 6, "label_ratio"
    )


@query("drift_report_profiles", ORACLES["drift_report"])
def drift_report_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from stored profiles: those of all months of each flag, merged."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        snapshot_of("l_shipdate").alias("snapshot_date"),
        *MEASURES,
        (F.col("l_discount") > 0.05).cast("int").alias("prediction"),
    )
    path = scratch_path(spark, "profiles")
    write_snapshots(value_profile(items, MEASURES, ["l_returnflag", "snapshot_date"], "prediction"), path)
    profiles = spark.read.parquet(path)
    report = drift_of_profiles(*(profiles.where(F.col("l_returnflag") == flag) for flag in ("A", "R")), MEASURES)
    return rounded(rounded(rounded(report, 8, "psi", "ks"), 4, *MOMENT_COLUMNS), 6, "label_ratio")


# Features with NaN and infinite values, without values on one side, and without any.
EDGES = {
    "with_nan": ("IF(l_orderkey % 50 = 0, CAST('NaN' AS DOUBLE), l_quantity)", "l_orderkey % 50 <> 0", "l_quantity"),
    "with_inf": (
        "IF(l_orderkey % 60 = 0, CAST('Infinity' AS DOUBLE), l_extendedprice)", "l_orderkey % 60 <> 0", "l_extendedprice",
    ),
    "one_sided": ("IF(l_returnflag = 'A', l_tax, NULL)", "l_returnflag = 'A'", "l_tax"),
    "no_values": ("CAST(NULL AS DOUBLE)", "false", "l_tax"),
}
EDGES_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {value} AS v, l_returnflag AS flag FROM lineitem "
    f"WHERE l_returnflag IN ('A', 'R') AND {known}"
    for name, (_, known, value) in EDGES.items()
) + ")"


@query(
    "drift_report_edge",
    f"""WITH {EDGES_LONG}, {_psi_sql(own=False)}, {KS}, {_moments_sql(4)},
    named AS (SELECT unnest([{", ".join(f"'{name}'" for name in EDGES)}]) AS feature)
    SELECT feature, psi, ks, mean_train, mean_curr, std_train, std_curr
    FROM named LEFT JOIN moments USING (feature) LEFT JOIN psi USING (feature) LEFT JOIN ks USING (feature)""",
)
def drift_report_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", *[F.expr(e).alias(name) for name, (e, _, _) in EDGES.items()]
    )
    sides = (items.where(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in ("A", "R"))
    report = drift_report(*sides, list(EDGES), prediction=None)
    return rounded(rounded(report, 8, "psi", "ks"), 4, *MOMENT_COLUMNS)


def _auc_sql(source: str, score: str, label: str, by: str = "") -> str:
    """Mann-Whitney form: sum of average ranks of the positives."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"{by}, " if by else ""
    return f"""ranked AS (
      SELECT {group}{label} AS y, rank() OVER ({part} ORDER BY {score})
        + (count(*) OVER (PARTITION BY {group}{score}) - 1) / 2 AS avg_rank
      FROM {source}),
    auc AS (
      SELECT {group}CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
          (sum(avg_rank) FILTER (y = 1) - sum(y)::DOUBLE * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * sum(1 - y))
        END AS auc, sum(y)::BIGINT AS n_pos, sum(1 - y)::BIGINT AS n_neg
      FROM ranked {f"GROUP BY {by}" if by else ""})"""


SCORED_DOCUMENTS = f"""scored AS (
  SELECT doc_id, n_chars, quality,
         CASE WHEN {BUCKET.format("doc_id::VARCHAR")} < 70 THEN 'training'
              WHEN {BUCKET.format("doc_id::VARCHAR")} < 85 THEN 'validation' ELSE 'test' END AS split
  FROM documents JOIN labels USING (doc_id))"""


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    return hash_split(labelled, ["doc_id"])


@query(
    "auc_exact",
    f"""WITH {SCORED_DOCUMENTS}, {_auc_sql("scored", "n_chars", "quality")}
    SELECT round(auc, 8) AS auc, n_pos, n_neg FROM auc""",
)
def auc_exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(auc_exact(scored_documents(spark, sf_dir), "n_chars", "quality"), 8, "auc")


@query(
    "auc_sliced",
    f"""WITH items AS (SELECT l_extendedprice, (l_returnflag = 'A')::INT AS label FROM lineitem),
    {_auc_sql("items", "l_extendedprice", "label")}
    SELECT round(auc, 8) AS auc, n_pos, n_neg FROM auc""",
)
def auc_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "A").cast("int").alias("label")
    )
    return rounded(auc_exact(items, "l_extendedprice", slices=64), 8, "auc")


@query(
    "auc_by_supplier",
    f"""WITH items AS (SELECT l_suppkey, l_extendedprice, (l_returnflag = 'A')::INT AS label FROM lineitem),
    {_auc_sql("items", "l_extendedprice", "label", "l_suppkey")}
    SELECT l_suppkey, round(auc, 8) AS auc, n_pos, n_neg FROM auc""",
)
def auc_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_extendedprice", (F.col("l_returnflag") == "A").cast("int").alias("label")
    )
    return rounded(auc_exact(items, "l_extendedprice", by=["l_suppkey"]), 8, "auc")


@query(
    "gini_by_split",
    f"""WITH {SCORED_DOCUMENTS}, {_auc_sql("scored", "n_chars", "quality", "split")}
    SELECT split, round(2 * auc - 1, 3) AS gini FROM auc""",
)
def gini_by_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gini_by_split(scored_documents(spark, sf_dir), "n_chars", "quality")


@query(
    "delayed_auc",
    f"""WITH {LEDGER}, {SUPPLIER_MONTHS},
    joined AS (
      SELECT s.snapshot_date, s.quantity_avg AS score, l.label
      FROM supplier_months s JOIN labels_gold l ON s.Customer_ID = l.Customer_ID
        AND s.snapshot_date = (l.snapshot_date - INTERVAL 6 MONTH)::DATE),
    {_auc_sql("joined", "score", "label", "snapshot_date")}
    SELECT snapshot_date, round(auc, 8) AS auc, n_pos, n_neg FROM auc""",
)
def delayed_auc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = delayed_auc(scored_months(spark, sf_dir), label_store(spark, sf_dir), "score")
    return rounded(found, 8, "auc")
