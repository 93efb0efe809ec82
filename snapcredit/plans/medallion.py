"""The monthly data product: source files -> bronze -> silver -> gold -> training, scoring, monitoring.

Every step takes all its snapshots at once. ``clean_*`` and ``gold_*`` are pure DataFrame functions;
``ingest``, ``refresh`` and the functions that take a path write tables partitioned by snapshot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.functions.casts import pattern_gated_cast, schema_enforce
from snapcredit.functions.dates import as_date, shift_months
from snapcredit.functions.text import duration_months, token_counts
from snapcredit.models.registry import load_champion, promote_champion, save_model
from snapcredit.models.scoring import positive_probability, score_snapshots
from snapcredit.models.training import (
    GBT_SPACE,
    LOGREG_SPACE,
    feature_columns,
    gbt,
    logreg,
    random_search,
    sample_space,
)
from snapcredit.operators.credit import create_label, delinquency
from snapcredit.operators.drift import drift_report
from snapcredit.operators.encoders import one_hot
from snapcredit.operators.evaluation import delayed_auc
from snapcredit.operators.features import KEYS, join_feature_tables
from snapcredit.operators.joins import label_join
from snapcredit.operators.quality import (
    bool_default,
    dedup_latest,
    domain_validate,
    drop_null_keys,
    fill_zero,
    quality_counters,
    range_validate,
    row_reconcile,
)
from snapcredit.operators.splits import require_history, training_sets
from snapcredit.plans import credit_tables as tables
from snapcredit.session import compiled_projections
from snapcredit.sources.changes import backfill_changed
from snapcredit.sources.scans import load_datasets, read_csv
from snapcredit.sources.sinks import merge_metrics_log, read_metrics_log, write_snapshots
from snapcredit.sources.snapshots import month_spine, require_snapshots

TABLES = {
    "clickstream_data": tables.CLICKSTREAM,
    "customer_attributes": tables.ATTRIBUTES,
    "customer_financials": tables.FINANCIALS,
    "loan_data": tables.LOANS,
}


def ingest(
    spark: SparkSession,
    csv_path: str,
    bronze_path: str,
    start: str | dt.date,
    end: str | dt.date,
    counts_path: str | None = None,
) -> None:
    """Source CSV to bronze, all months of the range in one pass over the source.

    Values stay the text they are in the source; only the snapshot date is read as a date. With
    ``counts_path`` the rows, those without a readable date and those outside the range are logged there.
    """
    day = F.col("snapshot_date").try_cast("date")
    source = read_csv(spark, csv_path, infer=False).withColumn("snapshot_date", day)
    window = F.col("snapshot_date").between(F.lit(as_date(start)), F.lit(as_date(end)))
    write_snapshots(source.where(window), bronze_path, "csv")
    if counts_path:
        left_out = {"no_date": day.isNull(), "outside": ~window}
        counted = quality_counters(source, left_out).withColumn("bronze", F.lit(bronze_path))
        counted.write.mode("append").json(counts_path)


def typed(df: DataFrame, table: str, gated: bool = True) -> DataFrame:
    """Enforce the declared types of a table, with the text gate or by plain casts."""
    return (pattern_gated_cast if gated else schema_enforce)(df, TABLES[table])


def clean_clickstream(df: DataFrame) -> DataFrame:
    return dedup_latest(fill_zero(drop_null_keys(df, KEYS), tables.CLICK_MEASURES), KEYS)


def clean_attributes(df: DataFrame, null_keys: str = "any") -> DataFrame:
    df = drop_null_keys(df.drop("Name", "SSN"), KEYS, null_keys)
    df = range_validate(df, tables.ATTRIBUTE_RANGES)
    return dedup_latest(domain_validate(df, {"Occupation": (tables.OCCUPATIONS, "Other")}), KEYS)


def clean_financials(df: DataFrame, null_keys: str = "any") -> DataFrame:
    df = bool_default(drop_null_keys(df, KEYS, null_keys), ["Payment_of_Min_Amount"])
    df = range_validate(df, tables.FINANCIAL_RANGES)
    df = domain_validate(
        df,
        {
            "Credit_Mix": (tables.CREDIT_MIXES, "Unknown"),
            "Payment_Behaviour": (tables.PAYMENT_BEHAVIOURS, "Unknown"),
        },
    )
    df = df.withColumn("Credit_History_Age", duration_months("Credit_History_Age"))
    return dedup_latest(df, KEYS)


def clean_loans(df: DataFrame) -> DataFrame:
    return delinquency(df)


CLEANERS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "clickstream_data": clean_clickstream,
    "customer_attributes": clean_attributes,
    "customer_financials": clean_financials,
    "loan_data": clean_loans,
}


def silver(df: DataFrame, table: str, gated: bool = True) -> DataFrame:
    """Bronze rows of a table, typed and cleaned."""
    if table not in CLEANERS:
        raise ValueError(f"unknown table {table!r}; one of {sorted(CLEANERS)}")
    compiled_projections(df.sparkSession)
    return CLEANERS[table](typed(df, table, gated))


def refresh(
    spark: SparkSession,
    bronze: Mapping[str, str],
    silver_paths: Mapping[str, str],
    start: str | dt.date,
    end: str | dt.date,
    counts_path: str | None = None,
) -> dict[str, list[dt.date]]:
    """Build the silver snapshots of the range that are missing or whose bronze has changed; returns their dates per table.

    With ``counts_path`` the rows of each built snapshot before and after cleaning are logged there.
    """
    built = {}
    for name, path in bronze.items():
        source = read_csv(spark, path, infer=False)
        dates = backfill_changed(source, lambda df, name=name: silver(df, name), silver_paths[name], start, end)
        built[name] = dates
        if counts_path and dates:
            layers = (
                df.where(F.col("snapshot_date").isin(dates)) for df in (source, spark.read.parquet(silver_paths[name]))
            )
            counted = row_reconcile(*layers, by=["snapshot_date"]).withColumn("table", F.lit(name))
            counted.write.mode("append").json(counts_path)
    return built


def gold_labels(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    return create_label(loans, dpd, mob)


def encode_features(df: DataFrame) -> DataFrame:
    """Categories to 0/1 columns, loan types to counts, numeric nulls to 0."""
    df = one_hot(df, "Occupation", tables.OCCUPATIONS, drop_label="Other")
    df = one_hot(df, "Credit_Mix", tables.CREDIT_MIXES, drop_label="Unknown")
    df = one_hot(df, "Payment_Behaviour", tables.PAYMENT_BEHAVIOURS, drop_label="Unknown")
    df = token_counts(df, "Type_of_Loan", tables.LOAN_TYPES, prefix="LoanType_")
    return fill_zero(df, exclude=KEYS)


def gold_features(
    attributes: DataFrame, financials: DataFrame, clicks: DataFrame, loans: DataFrame
) -> DataFrame:
    joined = join_feature_tables(attributes, financials, clicks, loans, tables.CLICK_MEASURES)
    return encode_features(joined)


def write_training_sets(
    features: DataFrame,
    labels: DataFrame,
    path: str,
    start: str | dt.date,
    end: str | dt.date,
    n_oot: int = 3,
) -> None:
    """Labelled feature history, split and stored as one table partitioned by ``split``."""
    spine = month_spine(features.sparkSession, start, end)
    require_history(spine.count(), n_oot)
    require_snapshots(features, start, end)
    window = F.col("snapshot_date").between(F.lit(as_date(start)), F.lit(as_date(end)))
    history = label_join(features.where(window), labels.where(window))
    write_snapshots(training_sets(history, KEYS, n_oot), path, partition="split", whole_table=True)


def train_models(
    spark: SparkSession,
    training_path: str,
    registry_path: str,
    n_trials: int = 100,
    seed: int = 42,
    parallelism: int | None = None,
) -> str:
    """Search both model types, store the best of each, promote the champion; returns its path."""
    sets = load_datasets(spark, training_path)
    train, validation = sets.pop("training"), sets.pop("validation")
    columns = feature_columns(train)
    for name, estimator, space in (("gbt", gbt(), GBT_SPACE), ("logreg", logreg(), LOGREG_SPACE)):
        grid = sample_space(space, n_trials, seed)
        found = random_search(estimator, grid, train, validation, columns, parallelism, sets)
        run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}_{uuid4().hex[:8]}"
        save_model(spark, found, registry_path, name, f"{name}_{seed}_{n_trials}_{run}")
    return promote_champion(spark, registry_path)


def score(
    spark: SparkSession,
    registry_path: str,
    features: DataFrame,
    snapshots: Sequence[str | dt.date],
    path: str,
) -> None:
    """Score snapshots with the champion."""
    model, _ = load_champion(spark, registry_path)
    score_snapshots(model, features, snapshots, path)


METRICS_LOG = (
    "snapshot_date date, feature string, psi double, ks double, mean_train double, "
    "mean_curr double, std_train double, std_curr double, label_ratio double, auc double"
)


def monitor(
    predictions: DataFrame,
    training: DataFrame,
    labels: DataFrame,
    features: Sequence[str] | None,
    snapshot: str | dt.date,
    log_path: str,
    months: int = 6,
) -> None:
    """Log the drift of a scored snapshot, then evaluate the snapshot whose labels arrived with it.

    ``features`` may be the champion's own, of its registry row; None takes all that both have. Of the
    predictions only the two snapshots concerned are read.
    """
    if features is None:
        features = [c for c in feature_columns(training) if c in predictions.columns]
    spark, day = predictions.sparkSession, as_date(snapshot)
    current = predictions.where(F.col("snapshot_date") == F.lit(day))
    report = drift_report(training, current, features).select(
        F.lit(day).alias("snapshot_date"), "*", F.lit(None).cast("double").alias("auc")
    )
    write_snapshots(report, log_path, "json")
    made = F.col("snapshot_date") == F.lit(shift_months(day, -months))
    scored = predictions.where(made).withColumn("score", positive_probability())
    arrived = labels.where(F.col("snapshot_date") == F.lit(day))
    evaluated = delayed_auc(scored, arrived, "score", months=months).select("snapshot_date", "auc")
    merge_metrics_log(spark, log_path, METRICS_LOG, evaluated)


def metrics_log(spark: SparkSession, log_path: str) -> DataFrame:
    return read_metrics_log(spark, log_path, METRICS_LOG)
