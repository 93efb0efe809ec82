"""The full cleaning rules of the four source tables, on text tables derived from the samples.

The raw columns are SQL expressions both engines read alike; the cleaning is written twice, once by
the library and once in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.plans import credit_tables as tables
from snapcredit.plans.catalog.base import query, table
from snapcredit.plans.medallion import silver

INT_TEXT, NUMBER_TEXT = r"\d+", r"\d+(\.\d+)?"


def pick(index: str, values: Sequence[str]) -> str:
    """One of the values by the remainder of an expression."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {cases} END"


def month_text(column: str) -> str:
    return f"CAST(CAST(date_trunc('month', {column}) AS DATE) AS STRING)"


def raw(spark: SparkSession, sf_dir: str, source: str, columns: Mapping[str, str]) -> DataFrame:
    return table(spark, sf_dir, source).select(*[F.expr(e).alias(c) for c, e in columns.items()])


def raw_sql(source: str, columns: Mapping[str, str]) -> str:
    return f"raw AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})"


def gate(column: str, pattern: str, dtype: str) -> str:
    return f"try_cast(CASE WHEN regexp_full_match({column}, '{pattern}') THEN {column} END AS {dtype})"


def first_by_key(columns: Sequence[str]) -> str:
    """One row per key with the highest values, compared column by column."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in columns if c not in ("Customer_ID", "snapshot_date"))
    return f"QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date ORDER BY {order}) = 1"


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


KNOWN_KEYS = "WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL"

CLICKS = {
    "Customer_ID": "CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_suppkey AS STRING) END",
    "snapshot_date": month_text("l_shipdate"),
} | {
    c: f"CASE WHEN (l_orderkey + {i}) % 11 = 0 THEN '-4' WHEN (l_orderkey + {i}) % 13 = 0 THEN '7_' "
    f"ELSE CAST((l_orderkey * {i} + l_partkey) % 101 AS STRING) END"
    for i, c in enumerate(tables.CLICK_MEASURES, 1)
}


@query(
    "silver_clickstream",
    f"""WITH {raw_sql("lineitem", CLICKS)},
    typed AS (SELECT Customer_ID, snapshot_date::DATE AS snapshot_date,
      {", ".join(f"coalesce({gate(c, INT_TEXT, 'INT')}, 0) AS {c}" for c in tables.CLICK_MEASURES)}
      FROM raw)
    SELECT * FROM typed {KNOWN_KEYS} {first_by_key(list(CLICKS))}""",
)
def silver_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(raw(spark, sf_dir, "lineitem", CLICKS), "clickstream_data")


ATTRIBUTES = {
    "Customer_ID": "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_custkey AS STRING) END",
    "Name": "concat('Name ', CAST(o_custkey AS STRING))",
    "Age": "CASE WHEN o_orderkey % 10 = 3 THEN '41_' ELSE CAST(o_orderkey % 140 - 20 AS STRING) END",
    "SSN": "concat('000-00-', CAST(o_custkey AS STRING))",
    "Occupation": pick("o_orderkey", [*tables.OCCUPATIONS, "_______", "Astronaut"]),
    "snapshot_date": f"CASE WHEN o_orderkey % 19 <> 0 THEN {month_text('o_orderdate')} END",
}
OCCUPATION_LIST = ", ".join(f"'{o}'" for o in tables.OCCUPATIONS)


@query(
    "silver_attributes",
    f"""WITH {raw_sql("orders", ATTRIBUTES)},
    typed AS (SELECT Customer_ID, {gate("Age", INT_TEXT, "INT")} AS years, Occupation,
                     snapshot_date::DATE AS snapshot_date FROM raw),
    clean AS (
      SELECT Customer_ID, snapshot_date, CASE WHEN years BETWEEN 0 AND 100 THEN years ELSE 0 END AS Age,
             CASE WHEN Occupation IN ({OCCUPATION_LIST}) THEN Occupation ELSE 'Other' END AS Occupation
      FROM typed {KNOWN_KEYS})
    SELECT * FROM clean {first_by_key(["Age", "Occupation"])}""",
)
def silver_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(raw(spark, sf_dir, "orders", ATTRIBUTES), "customer_attributes")


MONEY = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Total_EMI_per_month",
    "Amount_invested_monthly", "Monthly_Balance", "Changed_Credit_Limit",
]
WHOLE = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Delay_from_due_date",
    "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
]


def _number(seed: int, span: int, low: int, tail: str = "") -> str:
    value = f"CAST((o_orderkey * {seed}) % {span} - {low} AS STRING)"
    clean = f"concat({value}, '{tail}')" if tail else value
    return f"CASE WHEN (o_orderkey + {seed}) % 10 = 0 THEN concat({value}, '_') ELSE {clean} END"


FINANCIALS = (
    {"Customer_ID": "CAST(o_custkey AS STRING)", "snapshot_date": month_text("o_orderdate")}
    | {c: _number(7 + i, 5000, 500, ".25") for i, c in enumerate(MONEY)}
    | {c: _number(31 + i, 160, 20) for i, c in enumerate(WHOLE)}
    | {
        "Credit_Utilization_Ratio": _number(53, 120, 5, ".995"),
        "Credit_Mix": pick("o_orderkey", [*tables.CREDIT_MIXES, "_"]),
        "Payment_Behaviour": pick("o_custkey + o_orderkey", [*tables.PAYMENT_BEHAVIOURS, "!@9#%8"]),
        "Payment_of_Min_Amount": pick("o_orderkey", ["Yes", "No", "NM", "true", "false"]),
        "Credit_History_Age": "CASE o_orderkey % 4 "
        "WHEN 0 THEN concat(CAST(o_orderkey % 30 AS STRING), ' Years and 1 Months') "
        "WHEN 1 THEN concat(CAST(o_orderkey % 12 AS STRING), ' Months') WHEN 2 THEN 'NA' END",
        "Type_of_Loan": pick("o_orderkey", ["Auto Loan, and Auto Loan", "Payday Loan", "Not Specified"]),
    }
)


def _financial(column: str) -> str:
    if column in ("Customer_ID", "Type_of_Loan"):
        return column
    if column == "snapshot_date":
        return "snapshot_date::DATE AS snapshot_date"
    if column == "Credit_Mix":
        return f"CASE WHEN {column} <> '_' THEN {column} ELSE 'Unknown' END AS {column}"
    if column == "Payment_Behaviour":
        return f"CASE WHEN {column} NOT LIKE '!%' THEN {column} ELSE 'Unknown' END AS {column}"
    if column == "Payment_of_Min_Amount":
        return f"({column} = 'true') AS {column}"
    if column == "Credit_History_Age":
        parts = [
            f"coalesce(try_cast(regexp_extract({column}, '(\\d+)\\s+{unit}', 1) AS INT), 0)"
            for unit in ("Year", "Month")
        ]
        return f"{parts[0]} * 12 + {parts[1]} AS {column}"
    dtype = "INT" if column in WHOLE else "DECIMAL(18,2)"
    if column == "Credit_Utilization_Ratio":
        dtype = "DECIMAL(4,2)"
    if column == "Changed_Credit_Limit":
        dtype = "FLOAT"
    value = gate(column, INT_TEXT if column in WHOLE else NUMBER_TEXT, dtype)
    high = f" AND {value} < 100" if column in tables.PERCENT_COLUMNS else ""
    # the other numbers are decimals or floats with few digits, exact as doubles
    shown = "" if column in WHOLE else "::DOUBLE"
    return f"(CASE WHEN {value} > 0{high} THEN {value} ELSE 0 END){shown} AS {column}"


@query(
    "silver_financials",
    f"""WITH {raw_sql("orders", FINANCIALS)},
    clean AS (SELECT {", ".join(_financial(c) for c in FINANCIALS)} FROM raw)
    SELECT * FROM clean {first_by_key(list(FINANCIALS))}""",
)
def silver_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = silver(raw(spark, sf_dir, "orders", FINANCIALS), "customer_financials")
    return doubles(clean, *MONEY, "Credit_Utilization_Ratio")


LOANS = {
    "loan_id": "CAST(l_orderkey AS STRING)",
    "Customer_ID": "CAST(l_suppkey AS STRING)",
    "loan_start_date": month_text("l_shipdate"),
    "tenure": "'10'",
    "installment_num": "CAST(l_linenumber AS STRING)",
    "loan_amt": "CAST(CAST(l_quantity AS INT) * 100 AS STRING)",
    "due_amt": "CASE WHEN l_partkey % 9 <> 0 THEN CAST(CAST(round(l_discount * 100) AS INT) AS STRING) END",
    "paid_amt": "'0.0'",
    "overdue_amt": "CAST(CAST(round(l_tax * 100) AS INT) AS STRING)",
    "balance": "CASE WHEN l_partkey % 4 = 0 THEN '-1' ELSE '1.5' END",
    "snapshot_date": month_text("l_shipdate"),
}
AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]


@query(
    "silver_loans",
    f"""WITH {raw_sql("lineitem", LOANS)},
    typed AS (
      SELECT loan_id, Customer_ID, loan_start_date::DATE AS loan_start_date,
             snapshot_date::DATE AS snapshot_date,
             {", ".join(f"coalesce({gate(c, INT_TEXT, 'INT')}, 0) AS {c}"
                        for c in ("tenure", "installment_num"))},
             {", ".join(f"coalesce({gate(c, NUMBER_TEXT, 'FLOAT')}, 0)::DOUBLE AS {c}" for c in AMOUNTS)}
      FROM raw),
    missed AS (
      SELECT *, installment_num AS mob,
             CASE WHEN due_amt = 0 THEN 0 ELSE ceil(overdue_amt / due_amt)::INT END AS installments_missed
      FROM typed),
    dated AS (
      SELECT *, CASE WHEN installments_missed > 0
                     THEN (snapshot_date - to_months(installments_missed))::DATE END AS first_missed_date
      FROM missed)
    SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                   ELSE 0 END::INT AS dpd
    FROM dated""",
)
def silver_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(silver(raw(spark, sf_dir, "lineitem", LOANS), "loan_data"), *AMOUNTS)
