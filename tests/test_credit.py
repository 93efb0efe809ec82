import datetime as dt

import pytest

from snapcredit.operators.credit import create_label, delinquency, vintage_bad_rate

SCHEMA = (
    "loan_id string, Customer_ID string, snapshot_date date, installment_num int, "
    "due_amt float, overdue_amt float"
)


def loans(spark, rows):
    data = [(f"l{i}", f"c{i}", d, mob, due, over) for i, (d, mob, due, over) in enumerate(rows)]
    return delinquency(spark.createDataFrame(data, SCHEMA))


def by_loan(df):
    return [r for r in df.orderBy("loan_id").collect()]


def test_one_missed_instalment(spark):
    days = [dt.date(2023, 3, 1), dt.date(2024, 3, 1), dt.date(2023, 5, 1), dt.date(2023, 6, 1)]
    found = loans(spark, [(d, 6, 100.0, 100.0) for d in days])
    assert [r.dpd for r in by_loan(found)] == [28, 29, 30, 31]
    assert [r.label for r in by_loan(create_label(found))] == [0, 0, 1, 1]


def test_month_end_is_clamped(spark):
    row = by_loan(loans(spark, [(dt.date(2023, 3, 31), 1, 100.0, 50.0)]))[0]
    assert (row.installments_missed, row.first_missed_date, row.dpd) == (1, dt.date(2023, 2, 28), 31)


def test_nothing_due(spark):
    day = dt.date(2023, 6, 1)
    rows = by_loan(loans(spark, [(day, 6, 0.0, 10.0), (day, 6, 100.0, 0.0), (day, 6, None, None)]))
    assert [(r.installments_missed, r.first_missed_date, r.dpd) for r in rows] == [
        (0, None, None), (0, None, 0), (0, None, 0),
    ]
    assert rows[2].due_amt == 0.0
    labels = by_loan(create_label(loans(spark, [(day, 6, 0.0, 10.0)])))
    assert labels[0].label == 0


def test_label_columns(spark):
    day = dt.date(2023, 6, 1)
    found = create_label(loans(spark, [(day, 6, 10.0, 95.0), (day, 5, 10.0, 95.0)]), dpd=60, mob=6)
    assert found.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert [tuple(r) for r in found.collect()] == [("l0", "c0", 1, "60dpd_6mob", day)]


def test_vintage_curve(spark):
    day = dt.date(2023, 6, 1)
    found = loans(spark, [(day, 1, 10.0, 0.0), (day, 1, 10.0, 30.0), (day, 2, 10.0, 30.0)])
    found = found.withColumn("loan_start_date", found.snapshot_date)
    curve = [(r.mob, r.bad_rate) for r in vintage_bad_rate(found, started_before="2024-01-01").collect()]
    assert curve == [(1, 0.5), (2, pytest.approx(1.0))]
    assert vintage_bad_rate(found, started_before="2023-06-01").count() == 0
    assert [r.mob for r in vintage_bad_rate(found, at_installment=2).collect()] == [2]
