"""The feature store of the product, on the cleaned stand-ins of its four tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.text import column_suffix
from snapcredit.operators.features import asof_feature_tables
from snapcredit.plans import credit_tables as tables
from snapcredit.plans import feature_state, medallion
from snapcredit.plans.catalog.base import ORACLES, QUERIES, query
from snapcredit.plans.catalog.silver_tables import FINANCIALS, MONEY, doubles
from snapcredit.session import scratch_path
from snapcredit.sources.sinks import write_snapshots
from snapcredit.sources.snapshots import present_snapshots

SILVER = {
    "attributes": "silver_attributes",
    "financials": "silver_financials",
    "clicks": "silver_clickstream",
    "loans": "silver_loans",
}
TABLES = ", ".join(f"{name} AS ({ORACLES[key]})" for name, key in SILVER.items())

NUMBERS = [c for c in FINANCIALS if c not in (
    "Customer_ID", "snapshot_date", "Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount", "Type_of_Loan",
)]


def silver_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Attributes, financials, clicks and loans; the first instalment stands in for the start of a loan."""
    attributes, financials, clicks, loans = (QUERIES[key](spark, sf_dir) for key in SILVER.values())
    return [attributes, financials, clicks, loans.withColumn("mob", F.col("mob") - 1)]


def _flags(column: str, labels: list[str], dropped: str) -> list[str]:
    return [
        f"coalesce(({column} = '{label}')::INT, 0) AS {column}_{column_suffix(label, 'x')}"
        for label in labels
        if label != dropped
    ]


def _count(phrase: str) -> str:
    name = f"LoanType_{column_suffix(phrase, 'x')}_Count"
    return f"coalesce((length(Type_of_Loan) - length(replace(Type_of_Loan, '{phrase}', ''))) // {len(phrase)}, 0)::INT AS {name}"


@query(
    "feature_store_full",
    f"""WITH {TABLES},
    averaged AS (
      SELECT c.Customer_ID, c.snapshot_date, {", ".join(f"avg(c.{m}) AS {m}_avg" for m in tables.CLICK_MEASURES)}
      FROM clicks c JOIN loans l
        ON c.Customer_ID = l.Customer_ID AND l.mob = 1 AND c.snapshot_date <= l.snapshot_date
      GROUP BY 1, 2)
    SELECT Customer_ID, snapshot_date, coalesce(Age, 0) AS Age, Payment_of_Min_Amount,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMBERS)},
           {", ".join(_flags("Occupation", tables.OCCUPATIONS, "Other"))},
           {", ".join(_flags("Credit_Mix", tables.CREDIT_MIXES, "Unknown"))},
           {", ".join(_flags("Payment_Behaviour", tables.PAYMENT_BEHAVIOURS, "Unknown"))},
           {", ".join(_count(p) for p in tables.LOAN_TYPES)},
           {", ".join(f"coalesce({m}_avg, 0) AS {m}_avg" for m in tables.CLICK_MEASURES)}
    FROM attributes JOIN financials USING (Customer_ID, snapshot_date)
    LEFT JOIN averaged USING (Customer_ID, snapshot_date)""",
)
def feature_store_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold_features(*silver_tables(spark, sf_dir))


@query("feature_store_incremental", ORACLES["feature_store_full"])
def feature_store_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store, folded: the months up to the last two, each of these alone, then an old month once more."""
    held = [stored_snapshots(spark, df, name) for df, name in zip(silver_tables(spark, sf_dir), SILVER, strict=True)]
    root = scratch_path(spark, "feature_state")
    months = sorted(r[0] for df in held for r in present_snapshots(df).collect())
    months = sorted(set(months))
    spans = [(months[0], months[-3]), (months[-2], months[-2]), (months[-1], months[-1]), (months[5], months[5])]
    for first, last in spans:
        feature_state.fold(spark, root, first, last, *held)
    return feature_state.read_features(spark, root)


def stored_snapshots(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A frame as a table partitioned by snapshot, as silver tables are."""
    path = scratch_path(spark, name)
    write_snapshots(df, path)
    return spark.read.parquet(path)


@query(
    "feature_store_asof",
    f"""WITH {TABLES},
    with_attributes AS (
      SELECT c.*, a.Age, a.Occupation FROM clicks c LEFT JOIN attributes a
        ON c.Customer_ID = a.Customer_ID AND a.snapshot_date <= c.snapshot_date
      QUALIFY row_number() OVER (PARTITION BY c.Customer_ID, c.snapshot_date ORDER BY a.snapshot_date DESC) = 1)
    SELECT w.*, f.* EXCLUDE (Customer_ID, snapshot_date) FROM with_attributes w LEFT JOIN financials f
      ON w.Customer_ID = f.Customer_ID AND f.snapshot_date <= w.snapshot_date
    QUALIFY row_number() OVER (PARTITION BY w.Customer_ID, w.snapshot_date ORDER BY f.snapshot_date DESC) = 1""",
)
def feature_store_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes, financials, clicks, _ = silver_tables(spark, sf_dir)
    # The join takes the clicks several times; cleaned once, they are read from where silver tables lie.
    path = scratch_path(spark, "clicks")
    clicks.write.parquet(path)
    clicks = spark.read.parquet(path)
    return doubles(asof_feature_tables(clicks, attributes, financials), *MONEY, "Credit_Utilization_Ratio")
