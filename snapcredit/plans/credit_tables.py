"""Declared schemas, domains and ranges of the four source tables."""

from __future__ import annotations

from snapcredit.operators.quality import Bounds

# Column types of the sources after cleaning.
CLICK_MEASURES = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM = ", ".join(f"{c} int" for c in CLICK_MEASURES) + ", Customer_ID string, snapshot_date date"
ATTRIBUTES = "Age int, Occupation string, Customer_ID string, snapshot_date date"
FINANCIALS = """
    Customer_ID string, Annual_Income decimal(18,2), Monthly_Inhand_Salary decimal(18,2),
    Num_Bank_Accounts int, Num_Credit_Card int, Interest_Rate int, Num_of_Loan int,
    Type_of_Loan string, Delay_from_due_date int, Num_of_Delayed_Payment int,
    Changed_Credit_Limit float, Num_Credit_Inquiries int, Credit_Mix string,
    Outstanding_Debt decimal(18,2), Credit_Utilization_Ratio decimal(4,2),
    Credit_History_Age string, Payment_of_Min_Amount boolean, Total_EMI_per_month decimal(18,2),
    Amount_invested_monthly decimal(18,2), Payment_Behaviour string, Monthly_Balance decimal(18,2),
    snapshot_date date
"""
LOANS = """
    loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int,
    loan_amt float, due_amt float, paid_amt float, overdue_amt float, balance float,
    snapshot_date date
"""

# Allowed categories.
OCCUPATIONS = [
    "Scientist", "Media_Manager", "Musician", "Lawyer", "Teacher", "Developer", "Writer", "Architect",
    "Mechanic", "Entrepreneur", "Journalist", "Doctor", "Engineer", "Accountant", "Manager", "Other",
]
CREDIT_MIXES = ["Good", "Bad", "Standard", "Unknown"]
PAYMENT_BEHAVIOURS = [
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments",
    "Low_spent_Large_value_payments", "High_spent_Small_value_payments",
    "High_spent_Medium_value_payments", "High_spent_Large_value_payments",
]
LOAN_TYPES = [
    "Personal Loan", "Student Loan", "Payday Loan", "Auto Loan", "Home Equity Loan", "Mortgage Loan",
    "Credit-Builder Loan", "Debt Consolidation Loan", "Not Specified",
]

# Valid ranges; anything else becomes 0.
ATTRIBUTE_RANGES = {"Age": Bounds(0, 100, closed=True)}
PERCENT_COLUMNS = ["Interest_Rate", "Credit_Utilization_Ratio"]
POSITIVE_COLUMNS = [
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
    "Outstanding_Debt", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
FINANCIAL_RANGES = {c: Bounds(low=0) for c in POSITIVE_COLUMNS} | {
    c: Bounds(low=0, high=100) for c in PERCENT_COLUMNS
}
