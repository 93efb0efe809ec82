"""Operators bound to the sample tables, each with the SQL that states its result."""

from snapcredit.plans.catalog import (  # noqa: F401
    cleaning,
    features,
    ingest,
    joining,
    modelling,
    monitoring,
    silver_tables,
    store,
)
from snapcredit.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
