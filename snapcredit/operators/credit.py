"""Loan ledger operators: delinquency, the default label and vintage curves."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date
from snapcredit.operators.quality import fill_zero


def delinquency(
    loans: DataFrame,
    installment: str = "installment_num",
    due: str = "due_amt",
    overdue: str = "overdue_amt",
    snapshot: str = "snapshot_date",
    keys: Sequence[str] = ("loan_id", "Customer_ID"),
) -> DataFrame:
    """Months on book, instalments missed, the first missed date and days past due.

    * ``installments_missed``: overdue over due amount, rounded up; nothing due gives 0.
    * ``first_missed_date``: that many months before the snapshot; null if none was missed.
    * ``dpd``: calendar days since then; 0 if nothing is overdue, null if an amount is overdue that was
      never due. The null is left visible for the quality counters.

    Null amounts count as 0, like every numeric null of the ledger outside the keys.
    """
    missed = F.ceil(F.try_divide(F.col(overdue), F.col(due))).cast("int")
    staged = fill_zero(
        loans.withColumns({"mob": F.col(installment).cast("int"), "installments_missed": missed}),
        exclude=keys,
    )
    first_missed = F.when(
        F.col("installments_missed") > 0,
        F.add_months(F.col(snapshot), -F.col("installments_missed")),
    )
    dated = staged.withColumn("first_missed_date", first_missed)
    days = F.datediff(F.col(snapshot), F.col("first_missed_date"))
    return dated.withColumn("dpd", F.when(F.col(overdue) > 0, days).otherwise(0).cast("int"))


def create_label(
    loans: DataFrame, dpd: int = 30, mob: int = 6, loan: str = "loan_id", customer: str = "Customer_ID"
) -> DataFrame:
    """The default label: at month ``mob``, is the loan at least ``dpd`` days past due?"""
    return loans.where(F.col("mob") == mob).select(
        loan,
        customer,
        F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def vintage_bad_rate(
    loans: DataFrame,
    dpd: int = 30,
    started_before: str | dt.date | None = None,
    start_column: str = "loan_start_date",
    at_installment: int | None = None,
) -> DataFrame:
    """Share of loans at least ``dpd`` days past due by months on book, in that order."""
    if started_before is not None:
        loans = loans.where(F.col(start_column) < F.lit(as_date(started_before)))
    if at_installment is not None:
        loans = loans.where(F.col("installment_num") == at_installment)
    bad = F.when(F.col("dpd") >= dpd, 1).otherwise(0)
    return loans.groupBy("mob").agg(F.avg(bad).alias("bad_rate"), F.count("*").alias("n")).orderBy("mob")
