"""Validity intervals: what was known of a key from one time to the next, kept instead of its snapshots.

An interval holds from ``valid_from`` on and ends before ``valid_to`` (null: still open). Intervals of a key
do not overlap and have no gaps after its first row, so "the latest row at or before a time" is the one
interval that holds then. Looking it up is an equi-join on (key, month) and a comparison of times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcredit.operators.quality import dedup_latest

FROM, TO = "valid_from", "valid_to"


def _changed(payload: Sequence[str], window) -> Column:
    """Whether a row differs from the one before it, or is the first."""
    now = F.struct(*payload)
    return F.lag(F.lit(1)).over(window).isNull() | ~now.eqNullSafe(F.lag(now).over(window))


def validity_intervals(
    rows: DataFrame,
    key: str | Sequence[str],
    time: str,
    payload: Sequence[str] | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``(key, valid_from, valid_to, payload)`` from rows that state what is known of a key at a time.

    Of equal times the row with the highest ``tie_break``, then payload, counts. Rows that repeat the payload
    of the one before them lengthen its interval, so what changes seldom is stored once, not once a month.
    Rows with a null key or time are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in rows.columns if c not in (*keys, time)] if payload is None else list(payload)
    known = rows.select(*dict.fromkeys([*keys, time, *payload, *tie_break]))
    for c in (*keys, time):
        known = known.where(F.col(c).isNotNull())
    once = dedup_latest(known, [*keys, time], tie_break).select(*keys, time, *payload)
    ordered = Window.partitionBy(*keys).orderBy(time)
    changes = once.withColumn("_new", _changed(payload, ordered)).where("_new")
    return changes.select(*keys, F.col(time).alias(FROM), F.lead(time).over(ordered).alias(TO), *payload)


def merge_intervals(history: DataFrame, rows: DataFrame, key: str | Sequence[str], time: str,
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """The history with later rows merged in, as if it had been made of all of them.

    Rows may be of any time: of the history only the keys that they name are taken apart into rows and put
    together again; all others pass through. A row at the start of an interval replaces it. A row that had
    lengthened an interval without changing anything is not known any more, so a correction that falls
    inside an interval holds up to its end.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in history.columns if c not in (*keys, FROM, TO)]
    touched = rows.select(*keys).distinct()
    kept = history.join(touched, keys, "left_anti")
    newer = rows.select(*keys, F.col(time).alias(FROM), *payload, *[c for c in tie_break if c not in payload])
    newer = dedup_latest(newer.where(F.col(FROM).isNotNull()), [*keys, FROM], tie_break).select(*keys, FROM, *payload)
    older = history.join(touched, keys, "left_semi").select(*keys, FROM, *payload)
    stated = newer.withColumn("_rank", F.lit(1)).unionByName(older.withColumn("_rank", F.lit(0)))
    rebuilt = validity_intervals(stated, keys, FROM, payload, ["_rank"])
    return kept.unionByName(rebuilt)


def month_buckets(history: DataFrame, first, last) -> DataFrame:
    """Intervals once for each month from ``first`` to ``last`` that they hold in, in column ``_month``."""
    start = F.greatest(F.trunc(F.col(FROM), "month"), F.lit(first))
    # An interval that ends at the very start of a month does not hold in it.
    end = F.least(F.trunc(F.coalesce(F.col(TO).cast("timestamp") - F.expr("interval 1 microsecond"), F.lit(last)), "month"),
                  F.lit(last))
    months = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
    return history.withColumn("_month", F.explode(months))


def asof_intervals(
    left: DataFrame,
    history: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    payload: Sequence[str] | None = None,
    matched_from: str | None = None,
) -> DataFrame:
    """Left join with the interval of the same key that holds at the left time.

    Rows without one, or with a null key or time, are kept with nulls. ``matched_from`` adds the start of the
    interval. One equi-join on (key, month): adaptive execution splits a hot key by its months and parts.
    """
    keys = [on] if isinstance(on, str) else list(on)
    payload = [c for c in history.columns if c not in (*keys, FROM, TO)] if payload is None else list(payload)
    clash = {*payload, *([matched_from] if matched_from else [])} & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    # One row: the months that are asked for bound the buckets of open intervals.
    ends = left.agg(F.trunc(F.min(left_time), "month").alias("a"), F.trunc(F.max(left_time), "month").alias("b")).first()
    hit = F.struct(*payload, F.col(FROM).alias("_from")) if payload else F.struct(F.col(FROM).alias("_from"))
    bucketed = month_buckets(history, ends["a"], ends["b"]).select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_month", FROM, TO, hit.alias("_hit")
    )
    timed = left.withColumn("_of", F.trunc(F.col(left_time), "month"))
    match = F.col("_of") == F.col("_month")
    for i, k in enumerate(keys):
        match = match & (timed[k] == bucketed[f"_key_{i}"])
    at = F.col(left_time)
    match = match & (F.col(FROM) <= at) & (F.col(TO).isNull() | (at < F.col(TO)))
    extra = [F.col("_hit._from").alias(matched_from)] if matched_from else []
    return timed.join(bucketed, match, "left").select(
        *[timed[c] for c in left.columns], *[F.col("_hit")[c].alias(c) for c in payload], *extra
    )
