"""Value-count profiles: what drift reports need of a population, stored once and merged exactly.

A profile holds the number of rows of each distinct value per feature. Profiles of parts add up to that of
the whole, so drift between any two months, or spans of months, reads their profiles and no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.operators.drift import COUNTS, SIDES, _check_bins, _per_feature, _report
from snapcredit.operators.ranks import MAX_SLICES, MIN_SLICES, ROWS_PER_SLICE

#: The feature under which a profile holds the predictions: 1 for a positive one, 0 for any other.
PREDICTION = "*prediction"


def value_profile(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = ("snapshot_date",), prediction: str | None = None
) -> DataFrame:
    """``(by, feature, value, n)``: rows per distinct finite value, summed before the shuffle.

    Nulls, NaN and infinities are left out, as in drift reports. With ``prediction`` its positives and all
    other rows are counted as well.
    """
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    if prediction:
        hit = F.when(F.col(prediction) == 1, 1.0).otherwise(0.0)
        cells.append(F.struct(F.lit(PREDICTION).alias("feature"), hit.alias("value")))
    long = df.select(*by, F.inline(F.array(*cells))).where(F.abs("value") < float("inf"))
    return long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def _merged(reference: DataFrame, current: DataFrame) -> DataFrame:
    """``(feature, value, n_ref, n_cur)`` of two sets of profiles."""
    none = F.lit(0).cast("long")
    sides = reference.select("feature", "value", F.col("n").alias("n_ref"), none.alias("n_cur")).unionByName(
        current.select("feature", "value", none.alias("n_ref"), F.col("n").alias("n_cur"))
    )
    return sides.groupBy("feature", "value").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _facts(counted: DataFrame, features: Sequence[str]) -> tuple[dict[str, object], float, int]:
    """Ranges, totals and moments per feature and side, the share of positives now, and the distinct values.

    Two rows per feature reach the driver. Deviations are taken from the mean in a second pass.
    """
    def of(side: str, what):
        return F.when(F.col(f"n_{side}") > 0, what)

    first = counted.groupBy("feature").agg(
        F.count(F.lit(1)).alias("distinct"),
        *[F.sum(f"n_{s}").alias(f"{s}_n") for s in SIDES],
        *[F.sum(F.col("value") * F.col(f"n_{s}")).alias(f"{s}_sum") for s in SIDES],
        *[f(of(s, F.col("value"))).alias(f"{s}_{end}") for s in SIDES for end, f in (("lo", F.min), ("hi", F.max))],
    )
    rows = {r["feature"]: r.asDict() for r in first.collect()}
    empty = dict.fromkeys(f"{s}_{x}" for s in SIDES for x in ("n", "sum", "lo", "hi")) | {"ref_n": 0, "cur_n": 0}
    facts, names = {}, {"ref": "train", "cur": "curr"}
    for f in features:
        row = rows.get(f, empty)
        facts |= {f"{f}__{s}_{x}": row[f"{s}_{x}"] for s in SIDES for x in ("n", "lo", "hi")}
        facts |= {f"{f}__mean_{names[s]}": row[f"{s}_sum"] / row[f"{s}_n"] if row[f"{s}_n"] else None for s in SIDES}
    squares = [
        F.sum(F.col(f"n_{s}") * F.pow(F.col("value") - _per_feature({f: F.lit(facts[f"{f}__mean_{names[s]}"]) for f in features}), 2.0)).alias(s)
        for s in SIDES
    ]
    spread = {r["feature"]: r for r in counted.where(F.col("feature").isin(list(features))).groupBy("feature").agg(*squares).collect()}
    for f in features:
        for s in SIDES:
            n = facts[f"{f}__{s}_n"]
            facts[f"{f}__std_{names[s]}"] = (spread[f][s] / n) ** 0.5 if n else None
    told = rows.get(PREDICTION, empty)
    ratio = told["cur_sum"] / told["cur_n"] if told["cur_n"] else 0.0
    return facts, ratio, sum(r["distinct"] for r in rows.values())


def _sliced(counted: DataFrame, features: Sequence[str], n_values: int, slices: int | None) -> DataFrame:
    """Counts with the slice of their value, by cuts that divide the distinct values of a feature about evenly."""
    slices = slices or min(max(-(-n_values // ROWS_PER_SLICE), MIN_SLICES), MAX_SLICES)
    shares = f"array({', '.join(f'{i / slices}D' for i in range(1, slices))})"
    found = counted.groupBy("feature").agg(F.expr(f"percentile_approx(value, {shares}, {20 * slices})").alias("cuts"))
    cuts = {r["feature"]: sorted(set(r["cuts"] or [0.0])) for r in found.collect()}
    apart = [f"_value_{i}" for i in range(len(features))]
    wide = counted.select("*", *[F.when(F.col("feature") == f, F.col("value")).alias(c) for f, c in zip(features, apart, strict=True)])
    placed = Bucketizer(
        inputCols=apart,
        outputCols=[f"_slice_{i}" for i in range(len(features))],
        splitsArray=[[float("-inf"), *cuts.get(f, [0.0]), float("inf")] for f in features],
        handleInvalid="keep",
    ).transform(wide.where(F.col("feature").isin(list(features))))
    slice_of = _per_feature({f: F.col(f"_slice_{i}") for i, f in enumerate(features)})
    return placed.select("feature", slice_of.cast("int").alias("slice"), "value", *COUNTS)


def drift_of_profiles(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    prediction: bool = True,
    buckets: int = 10,
    bins: str = "reference",
    slices: int | None = None,
) -> DataFrame:
    """The drift report of two populations from the profiles of their parts, such as months.

    The same as `drift_report` of the rows: PSI, KS and moments are exact functions of the value counts.
    """
    _check_bins(bins)
    counted = _merged(reference, current)
    facts, ratio, n_values = _facts(counted, features)
    sliced = _sliced(counted, features, n_values, slices)
    return _report(reference.sparkSession, facts, sliced, features, buckets, bins, ratio if prediction else None)
