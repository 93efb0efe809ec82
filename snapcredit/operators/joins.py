"""Range, as-of and label joins.

Plain equi-joins on the composite key are ``DataFrame.join``; adaptive execution splits their skewed
partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcredit.operators.aggregates import multi_avg
from snapcredit.operators.quality import dedup_latest

BEFORE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def range_join_avg(
    facts: DataFrame,
    starts: DataFrame,
    key: str,
    fact_date: str,
    start_date: str,
    measures: Sequence[str],
    group_by: Sequence[str] | None = None,
    suffix: str = "_avg",
) -> DataFrame:
    """Average facts dated at or before a start of the same key, over all (fact, start) pairs.

    The pairs are never made. ``group_by`` is ``[key, fact_date]`` (the default) or ``[key]``. Facts meet
    one row per key with a start; adaptive execution broadcasts those rows if they turn out to be few.
    """
    group_by = list(group_by or [key, fact_date])
    facts = facts.where(F.col(key).isNotNull() & F.col(fact_date).isNotNull())
    starts = starts.where(F.col(key).isNotNull() & F.col(start_date).isNotNull())
    if set(group_by) == {key, fact_date}:
        # all facts of a group pair with the same starts, so it only matters that there is one
        newest = starts.groupBy(key).agg(F.max(start_date).alias("_newest"))
        paired = facts.join(newest, key).where(F.col(fact_date) <= F.col("_newest"))
        return multi_avg(paired, group_by, measures, suffix)
    if group_by != [key]:
        raise ValueError("group_by must be the key, with or without the fact date")
    return _weighted_avg(facts, starts, key, fact_date, start_date, measures, suffix)


def _weighted_avg(
    facts: DataFrame,
    starts: DataFrame,
    key: str,
    fact_date: str,
    start_date: str,
    measures: Sequence[str],
    suffix: str,
) -> DataFrame:
    """Averages per key in which a fact weighs as much as there are starts on or after its date.

    Facts are summed and starts counted per (key, date) before anything is sorted; a running count sees
    one row per date of a key and month, so no key is ever one task's work.
    """
    sums = facts.groupBy(key, F.col(fact_date).alias("_date")).agg(
        *[F.sum(m).cast("double").alias(f"_sum_{m}") for m in measures],
        *[F.count(m).alias(f"_n_{m}") for m in measures],
    )
    counts = starts.groupBy(key, F.col(start_date).alias("_date")).agg(
        F.count(F.lit(1)).alias("_starts")
    )
    # starts are counted backwards inside a month of the key; those of later months are carried in
    rows = sums.unionByName(counts, allowMissingColumns=True).withColumn("_month", F.trunc("_date", "month"))
    months = rows.groupBy(key, "_month").agg(F.sum("_starts").alias("_in_month"))
    after = Window.partitionBy(key).orderBy(F.col("_month").desc()).rowsBetween(*BEFORE)
    months = months.select(
        F.col(key).alias("_key"),
        F.col("_month").alias("_of"),
        F.coalesce(F.sum("_in_month").over(after), F.lit(0)).alias("_carried"),
    )
    later = (
        Window.partitionBy(key, "_month")
        .orderBy(F.col("_date").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    weighted = (
        rows.withColumn("_inside", F.coalesce(F.sum("_starts").over(later), F.lit(0)))
        .join(months, (F.col(key) == F.col("_key")) & (F.col("_month") == F.col("_of")))
        .withColumn("_weight", F.col("_inside") + F.col("_carried"))
        .drop("_key", "_of")
    )

    def total(column: str) -> Column:
        return F.sum(F.col(column) * F.col("_weight"))

    paired = weighted.where(F.col("_starts").isNull() & (F.col("_weight") > 0))
    return paired.groupBy(key).agg(
        *[F.try_divide(total(f"_sum_{m}"), total(f"_n_{m}")).alias(f"{m}{suffix}") for m in measures]
    )


def _timeline(probes: DataFrame, hits: DataFrame, keys: Sequence[str], time_slice: str) -> DataFrame:
    """The latest hit at or before each probe time; ``(keys, _time, _hit)``.

    A window holds one ``time_slice`` of a key; the last match of the earlier slices is carried in.
    ``_side`` orders a carried hit before the hits, and the hits before the probes, of the same time.
    """
    no_hit = F.lit(None).cast(hits.schema["_hit"].dataType)
    start = F.date_trunc(time_slice, "_time").cast(hits.schema["_time"].dataType)
    rows = (
        hits.select(*keys, "_time", F.lit(1).alias("_side"), "_hit")
        .unionByName(probes.select(*keys, "_time", F.lit(2).alias("_side"), no_hit.alias("_hit")))
        .withColumn("_slice", start)
    )
    # latest hit of each (key, slice), carried into the later slices of the key
    slices = rows.groupBy(*keys, "_slice").agg(
        F.max_by("_hit", F.when(F.col("_side") == 1, F.col("_time"))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*BEFORE)
    carried = slices.select(
        *keys,
        F.col("_slice").alias("_time"),
        F.lit(0).alias("_side"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_hit"),
        "_slice",
    )
    so_far = Window.partitionBy(*keys, "_slice").orderBy("_time", "_side").rowsBetween(*UP_TO_HERE)
    return (
        rows.unionByName(carried)
        .withColumn("_hit", F.last("_hit", ignorenulls=True).over(so_far))
        .where(F.col("_side") == 2)
        .select(*keys, "_time", "_hit")
    )


def _common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The wider of two date or time types; a date is the midnight it begins with."""
    if left == right or isinstance(right, T.DateType):
        return left
    return right if isinstance(left, T.DateType) else T.TimestampType()


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str] | Mapping[str, str] | None = None,
    tie_break: Sequence[str] = (),
    time_slice: str | None = None,
    matched_time: str | None = None,
) -> DataFrame:
    """Left join with the latest right row of the same key at or before the left time.

    Left rows without a match are kept with nulls. Right rows of equal time are decided by
    ``tie_break`` (highest first), then by the payload. ``payload`` names the right columns to add
    (``{right: output}`` renames them), by default all but the keys and the time; ``matched_time`` adds
    the time of the matched row.

    Times of different types are compared in the wider one, so no time of day is lost. The match depends
    only on (key, time): it is computed for the distinct times of the left side and joined back, so
    whatever repeats collapses before the shuffle, and the join back is an equi-join that adaptive
    execution can split. A key has at most one row per side and time, and a window holds one
    ``time_slice`` of it, by default a day, or a year if both times are dates.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if payload is None:
        payload = [c for c in right.columns if c not in (*keys, right_time)]
    if not isinstance(payload, Mapping):
        payload = {c: c for c in payload}
    outputs = dict(payload) | ({right_time: matched_time} if matched_time else {})
    clash = set(outputs.values()) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides, rename them in payload: {sorted(clash)}")

    known_keys = F.lit(True)
    for k in keys:
        known_keys = known_keys & F.col(k).isNotNull()
    time_type = _common_type(left.schema[left_time].dataType, right.schema[right_time].dataType)
    time_slice = time_slice or ("year" if isinstance(time_type, T.DateType) else "day")
    needed = dict.fromkeys([*keys, right_time, *outputs, *tie_break])
    candidates = (
        right.where(known_keys & F.col(right_time).isNotNull())
        .select(*needed)
        .withColumn("_time", F.col(right_time).cast(time_type))
    )
    hits = dedup_latest(candidates, [*keys, "_time"], tie_break).select(
        *keys, "_time", F.struct(*[F.col(c).alias(o) for c, o in outputs.items()]).alias("_hit")
    )
    timed = left.withColumn("_time", F.col(left_time).cast(time_type))
    probes = timed.where(known_keys & F.col("_time").isNotNull()).select(*keys, "_time").distinct()
    matched = _timeline(probes, hits, keys, time_slice)
    return timed.join(matched, [*keys, "_time"], "left").select(
        *[F.col(c) for c in left.columns], *[F.col("_hit")[o].alias(o) for o in outputs.values()]
    )


def label_join(
    features: DataFrame,
    labels: DataFrame,
    key: str | Sequence[str] = "Customer_ID",
    label: str = "label",
    one_label_per_key: bool = False,
    label_date: str = "snapshot_date",
) -> DataFrame:
    """Feature history with the label of the customer; the dates differ by design.

    A customer with several loans repeats the feature rows, once per label, unless only the latest
    label is wanted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if one_label_per_key:
        labels = dedup_latest(labels, keys, [label_date])
    return features.join(labels.select(*keys, label), keys, "inner")


def delayed_label_join(
    predictions: DataFrame,
    labels: DataFrame,
    key: str | Sequence[str] = "Customer_ID",
    months: int = 6,
    label: str = "label",
    snapshot: str = "snapshot_date",
    label_snapshot: str = "label_snapshot",
) -> DataFrame:
    """Labels known at a snapshot with the predictions made ``months`` earlier: one equi-join."""
    keys = [key] if isinstance(key, str) else list(key)
    known = labels.select(
        *keys,
        F.add_months(F.col(snapshot), -months).alias(snapshot),
        F.col(snapshot).alias(label_snapshot),
        label,
    )
    return predictions.join(known, [*keys, snapshot], "inner")
