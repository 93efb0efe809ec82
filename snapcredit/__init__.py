"""Monthly snapshot data products for credit risk, written as Spark DataFrame operators.

Sub-packages
------------
sources     readers, partitioned sinks, the month spine and backfill
functions   Column -> Column helpers (casts, text, dates)
operators   DataFrame -> DataFrame operators (quality, joins, features, splits, monitoring)
models      Spark ML training, search, registry and scoring
plans       the assembled data product and the query catalogue
"""

__version__ = "0.1.0"
