"""Training, validation, test and out-of-time sets, decided row by row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcredit.functions.dates import as_date, shift_months


def hash_bucket(keys: Sequence[str], buckets: int = 100, seed: str = "") -> Column:
    """A bucket in ``0..buckets-1`` that depends on the key alone, not on the order of rows."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], *([F.lit(seed)] if seed else []))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    shares: Mapping[str, int] | None = None,
    output: str = "split",
    seed: str = "",
) -> DataFrame:
    """Add a split name by key hash; ``shares`` are percentages in order and must add up to 100."""
    shares = shares or {"training": 70, "validation": 15, "test": 15}
    if sum(shares.values()) != 100:
        raise ValueError("shares must add up to 100")
    bucket, upper, case = hash_bucket(keys, seed=seed), 0, F
    for name, share in shares.items():
        upper += share
        case = case.when(bucket < upper, name)
    return df.withColumn(output, case)


def oot_split(
    df: DataFrame,
    n_oot: int = 3,
    date_column: str = "snapshot_date",
    output: str = "split",
    rest: str = "rest",
    latest: dt.date | None = None,
) -> DataFrame:
    """Add a split name: the last ``n_oot`` snapshots are ``oot_1..oot_n``, the newest being ``oot_n``.

    Older rows are ``rest``; rows between two out-of-time snapshots belong to no set and get null. If
    the newest snapshot is not given it is looked up, one date; the split itself is a projection.
    """
    if latest is None:
        latest = df.agg(F.max(date_column)).first()[0]
    if latest is None:
        return df.withColumn(output, F.lit(None).cast("string"))
    months = [shift_months(latest, -back) for back in range(n_oot)]
    case = F.when(F.col(date_column) < months[-1], rest) if months else F.when(F.lit(True), rest)
    for back, month in enumerate(months):
        case = case.when(F.col(date_column) == month, f"oot_{n_oot - back}")
    return df.withColumn(output, case)


def training_sets(
    df: DataFrame,
    keys: Sequence[str],
    n_oot: int = 3,
    date_column: str = "snapshot_date",
    shares: Mapping[str, int] | None = None,
    latest: dt.date | None = None,
) -> DataFrame:
    """``oot_split``, then ``hash_split`` of the rest; rows of no set are dropped."""
    aged = oot_split(df, n_oot, date_column, "_oot", latest=latest)
    staged = hash_split(aged, keys, shares, "_hash")
    split = F.when(F.col("_oot") == "rest", F.col("_hash")).otherwise(F.col("_oot"))
    return staged.withColumn("split", split).where(F.col("split").isNotNull()).drop("_oot", "_hash")


def require_history(n_snapshots: int, n_oot: int, minimum: int = 12) -> None:
    """Refuse a training range with fewer than ``minimum`` snapshots besides the out-of-time ones."""
    if n_snapshots - n_oot < minimum:
        raise ValueError(f"{n_snapshots - n_oot} training snapshots, at least {minimum} are needed")


def training_windows(
    train_date: str | dt.date, train_months: int = 12, oot_months: int = 2
) -> dict[str, tuple[dt.date, dt.date]]:
    """Closed date windows: out-of-time ends the day before ``train_date``, training before that."""
    day = as_date(train_date)
    oot_start = shift_months(day, -oot_months)
    one = dt.timedelta(days=1)
    return {
        "train_test": (shift_months(oot_start, -train_months), oot_start - one),
        "oot": (oot_start, day - one),
    }


def date_window_split(
    df: DataFrame,
    train_date: str | dt.date,
    train_months: int = 12,
    oot_months: int = 2,
    date_column: str = "snapshot_date",
    output: str = "split",
) -> DataFrame:
    """Keep the rows of the two windows and name their split.

    The outer range is a plain predicate on the date, so it prunes partitions.
    """
    windows = training_windows(train_date, train_months, oot_months)
    first = min(start for start, _ in windows.values())
    last = max(end for _, end in windows.values())
    case = F
    for name, (start, end) in windows.items():
        case = case.when(F.col(date_column).between(F.lit(start), F.lit(end)), name)
    return df.where(F.col(date_column).between(F.lit(first), F.lit(last))).withColumn(output, case)


def stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    label: str = "label",
    test_share: float = 0.2,
    seed: str = "",
    output: str = "split",
) -> DataFrame:
    """Add ``train`` / ``test`` so that each class has exactly ``ceil(test_share * n)`` test keys.

    Keys, which identify a row, are ordered by their md5. No class is ever sorted as a whole: a
    histogram over 65,536 hash cells finds the cell in which the quota of a class is reached, the rows of
    that one cell give the last test key, and every row is then decided by comparing with the one of its
    class, in a join. Rows without a label belong to no class and get null.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(seed)))
    hashed = df.select(F.col(label).alias("_class"), digest.alias("_digest")).where(
        F.col(label).isNotNull()
    )
    cell = F.conv(F.substring("_digest", 1, 4), 16, 10).cast("int")
    by_class = Window.partitionBy("_class")
    running = by_class.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (
        hashed.groupBy("_class", cell.alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_class",
            "_cell",
            "_n",
            F.sum("_n").over(running).alias("_upto"),
            F.ceil(F.round(F.sum("_n").over(by_class) * F.lit(test_share), 6)).alias("_quota"),
        )
    )
    reached = cells.where(
        (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota"))
    ).select("_class", "_cell", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
    ranked = hashed.withColumn("_cell", cell).join(reached, ["_class", "_cell"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_class", "_cell").orderBy("_digest"))
    )
    last = ranked.where(F.col("_rank") == F.col("_take")).select("_class", F.col("_digest").alias("_last"))
    is_test = F.coalesce(digest <= F.col("_last"), F.lit(False))
    decided = F.when(F.col(label).isNotNull(), F.when(is_test, "test").otherwise("train"))
    return df.join(last, df[label] == last["_class"], "left").select(
        *[df[c] for c in df.columns if c != output], decided.alias(output)
    )
