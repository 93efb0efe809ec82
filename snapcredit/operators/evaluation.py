"""Exact ranking metrics, also for labels that arrive months after the prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.operators.joins import delayed_label_join
from snapcredit.operators.ranks import before_slice, slice_cuts, value_counts, within_slice
from snapcredit.session import scratch_path


def auc_exact(
    df: DataFrame,
    score: str,
    label: str = "label",
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Area under the ROC curve with ties counted half, per group; null if a class is absent.

    Every pair of a positive and a negative row counts 1 if the positive scores higher and 1/2 if the
    scores are equal. The pairs are never made: per distinct score the negatives below it are known
    from running counts, and the pairs with earlier slices from the totals of those.

    ``df`` is read once: its counts per distinct score are kept as a table, from which the cuts between
    slices and the result follow.
    """
    positive = F.col(label) == 1
    known = df.where(F.col(label).isNotNull()).select(
        *by,
        F.col(score).cast("double").alias("_score"),
        F.when(positive, 1).otherwise(0).alias("n_pos"),
        F.when(positive, 0).otherwise(1).alias("n_neg"),
    )
    counts = ("n_pos", "n_neg")
    path = scratch_path(df.sparkSession, "scores")
    known.groupBy(*by, "_score").agg(*[F.sum(c).alias(c) for c in counts]).write.parquet(path)
    distinct = df.sparkSession.read.parquet(path)
    cuts = slice_cuts(distinct, ["_score"], distinct.count(), slices)
    counted = value_counts(distinct, cuts, counts, by)
    below = F.col("n_neg_upto") - F.col("n_neg") + F.col("n_neg") / 2
    sliced = (
        within_slice(counted, counts, by)
        .groupBy(*by, "feature", "slice")
        .agg(
            F.sum(F.col("n_pos") * below).alias("_inside"),
            *[F.sum(c).alias(c) for c in counts],
        )
    )
    won = F.col("_inside") + F.col("n_pos").cast("double") * F.col("n_neg_before")
    pairs = F.sum("n_pos").cast("double") * F.sum("n_neg")
    return (
        before_slice(sliced, counts, by)
        .groupBy(*by)
        .agg(
            F.try_divide(F.sum(won), pairs).alias("auc"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        )
    )


def gini_by_split(
    df: DataFrame, score: str, label: str = "label", by: Sequence[str] = ("split",)
) -> DataFrame:
    """Gini coefficient, 2 AUC - 1, rounded to 3 digits."""
    auc = auc_exact(df, score, label, by)
    return auc.select(*by, F.round(2 * F.col("auc") - 1, 3).alias("gini"))


def delayed_auc(
    predictions: DataFrame,
    labels: DataFrame,
    score: str,
    key: str | Sequence[str] = "Customer_ID",
    months: int = 6,
    label: str = "label",
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """AUC of each scored snapshot once its labels are known; snapshots without labels are absent."""
    keys = [key] if isinstance(key, str) else list(key)
    scored = predictions.select(*keys, snapshot, score)
    joined = delayed_label_join(scored, labels, keys, months, label, snapshot)
    return auc_exact(joined, score, label, by=[snapshot])
