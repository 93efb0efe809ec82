"""Population drift between a reference and a current population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from snapcredit.operators.ranks import before_slice, slice_cuts, value_counts, within_slice

# Fixed value: keeps the logarithm finite for a bucket that is empty on one side.
EPSILON = 1e-6
SIDES = ("ref", "cur")
COUNTS = ("n_ref", "n_cur")
MOMENTS = {
    "mean_train": ("ref", F.avg),
    "mean_curr": ("cur", F.avg),
    "std_train": ("ref", F.stddev_pop),
    "std_curr": ("cur", F.stddev_pop),
}


def _both(
    reference: DataFrame, current: DataFrame, features: Sequence[str], extra: Mapping[str, Column] = {}
) -> DataFrame:
    """Both populations with 0/1 side weights and the features as doubles.

    NaN and infinite values are left out like nulls, from ranges, shares, ranks and moments alike.
    ``extra`` columns are taken from the current population only.
    """

    def finite(feature: str) -> Column:
        value = F.col(feature).cast("double")
        return F.when(F.abs(value) < float("inf"), value).alias(feature)

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        more = [F.lit(None).alias(n) if is_ref else c.alias(n) for n, c in extra.items()]
        return df.select(
            *[finite(f) for f in features],
            F.lit(is_ref).alias("n_ref"),
            F.lit(1 - is_ref).alias("n_cur"),
            *more,
        )

    return side(reference, 1).unionByName(side(current, 0))


def _of(side: str, column: str) -> Column:
    return F.when(F.col(f"n_{side}") == 1, F.col(column))


def _per_feature(cases: Mapping[str, Column]) -> Column:
    """The expression of the feature a row is about."""
    return reduce(lambda case, f: case.when(F.col("feature") == f, cases[f]), cases, F)


def _range_aggregates(features: Sequence[str]) -> list[Column]:
    return [
        f(_of(s, c)).alias(f"{c}__{s}_{end}")
        for c in features
        for s in SIDES
        for end, f in (("lo", F.min), ("hi", F.max))
    ]


def _moment_aggregates(features: Sequence[str]) -> list[Column]:
    return [f(_of(s, c)).alias(f"{c}__{name}") for c in features for name, (s, f) in MOMENTS.items()]


def _total_aggregates(features: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows")] + [
        F.count(_of(s, c)).alias(f"{c}__{s}_n") for c in features for s in SIDES
    ]


Edges = dict[tuple[str, str], list[float]]


def _edges_of(row: Row, features: Sequence[str], buckets: int) -> Edges:
    """Inner edges of equal-width buckets per feature and side.

    A constant feature gets a unit-wide range around its value, a feature without values no edges.
    """
    edges: Edges = {}
    for feature in features:
        for side in SIDES:
            lo, hi = row[f"{feature}__{side}_lo"], row[f"{feature}__{side}_hi"]
            if lo is None:
                edges[feature, side] = []
                continue
            if lo == hi:
                lo, hi = lo - 0.5, hi + 0.5
            edges[feature, side] = [i * ((hi - lo) / buckets) + lo for i in range(1, buckets)]
    return edges


def _bucket(value: Column, edges: Sequence[float]) -> Column:
    """1 + edges at or below the value: values on an edge go up, the outer buckets are open."""
    return reduce(lambda total, edge: total + (value >= edge).cast("int"), edges, F.lit(1))


def _check_bins(bins: str) -> None:
    if bins not in ("reference", "own"):
        raise ValueError("bins must be 'reference' or 'own'")


def _psi_of(cells: DataFrame) -> DataFrame:
    """PSI per feature from counts per ``(feature, bucket)``; null if a side has no values."""
    counts = cells.groupBy("feature", "bucket").agg(*[F.sum(c).alias(c) for c in COUNTS])
    whole = Window.partitionBy("feature")
    shares = counts.select("feature", *[F.try_divide(F.col(c), F.sum(c).over(whole)).alias(c) for c in COUNTS])
    p, q = (F.col(c) for c in COUNTS)
    term = (p - q) * F.log((p + EPSILON) / (q + EPSILON))
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    buckets: int = 10,
    bins: str = "reference",
) -> DataFrame:
    """Population stability index per feature, nulls, NaN and infinities left out.

    A feature without values on a side has a null index, one without values on both sides no row.

    ``bins="reference"`` cuts both populations by the range of the reference; ``bins="own"`` cuts each
    by its own range, in which a pure shift is invisible. Two scans: one for the ranges, of which one
    row is collected, and one that counts per bucket before the shuffle.
    """
    _check_bins(bins)
    both = _both(reference, current, features)
    edges = _edges_of(both.agg(*_range_aggregates(features)).first(), features, buckets)

    def bucket(feature: str) -> Column:
        by_ref = _bucket(F.col(feature), edges[feature, "ref"])
        if bins == "reference":
            return by_ref
        by_cur = _bucket(F.col(feature), edges[feature, "cur"])
        return F.when(F.col("n_ref") == 1, by_ref).otherwise(by_cur)

    cells = [
        F.struct(
            F.lit(f).alias("feature"), F.when(F.col(f).isNotNull(), bucket(f)).alias("bucket")
        )
        for f in features
    ]
    long = both.select(*COUNTS, F.inline(F.array(*cells)))
    return _psi_of(long.where(F.col("bucket").isNotNull()))


def _psi_of_counts(counted: DataFrame, edges: Edges, features: Sequence[str], bins: str) -> DataFrame:
    """PSI from counts per distinct value; with own bins a value has one bucket per side."""
    value, zero = F.col("value"), F.lit(0).cast("long")
    by_ref = _per_feature({f: _bucket(value, edges[f, "ref"]) for f in features})
    if bins == "reference":
        return _psi_of(counted.withColumn("bucket", by_ref))
    by_cur = _per_feature({f: _bucket(value, edges[f, "cur"]) for f in features})
    sides = F.array(
        F.struct(by_ref.alias("bucket"), F.col("n_ref"), zero.alias("n_cur")),
        F.struct(by_cur.alias("bucket"), zero.alias("n_ref"), F.col("n_cur")),
    )
    cells = counted.select("feature", F.inline(sides))
    return _psi_of(cells.where((F.col("n_ref") > 0) | (F.col("n_cur") > 0)))


def _ks_of_counts(counted: DataFrame, row: Row, features: Sequence[str]) -> DataFrame:
    """KS statistic from counts per distinct value.

    Inside a slice the two distribution functions differ by a gap that all values share, made in the
    earlier slices, plus a gap of their own; the extremes of the latter are all that is kept.
    """

    def gap(suffix: str) -> Column:
        return _per_feature(
            {
                f: F.try_divide(F.col(f"n_ref_{suffix}"), F.lit(row[f"{f}__ref_n"]))
                - F.try_divide(F.col(f"n_cur_{suffix}"), F.lit(row[f"{f}__cur_n"]))
                for f in features
            }
        )

    inside = within_slice(counted, COUNTS).withColumn("_gap", gap("upto"))
    slices = inside.groupBy("feature", "slice").agg(
        F.max("_gap").alias("_highest"),
        F.min("_gap").alias("_lowest"),
        *[F.sum(c).alias(c) for c in COUNTS],
    )
    shared = before_slice(slices, COUNTS).withColumn("_shared", gap("before"))
    widest = F.greatest(
        F.abs(F.col("_shared") + F.col("_highest")), F.abs(F.col("_shared") + F.col("_lowest"))
    )
    return shared.groupBy("feature").agg(F.max(widest).alias("ks"))


def ks_two_sample(
    reference: DataFrame, current: DataFrame, features: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov statistic per feature; null if a side is empty."""
    both = _both(reference, current, features)
    row = both.agg(*_total_aggregates(features)).first()
    cuts = slice_cuts(both, features, row["_rows"], slices)
    return _ks_of_counts(value_counts(both, cuts, COUNTS), row, features)


def population_moments(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    """Mean and population deviation of both populations per feature, in one aggregation."""
    row = _both(reference, current, features).agg(*_moment_aggregates(features))
    cells = [
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{f}__{m}").alias(m) for m in MOMENTS])
        for f in features
    ]
    return row.select(F.inline(F.array(*cells)))


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    prediction: str | None = "prediction",
    buckets: int = 10,
    bins: str = "reference",
    slices: int | None = None,
) -> DataFrame:
    """PSI, KS and moments per feature, and the share of positive predictions now.

    Two scans of the populations for any number of features: the first collects one row of ranges,
    totals and moments, the second counts distinct values, from which PSI and KS both follow. Large
    populations are scanned once more for a sample that balances the work.
    """
    _check_bins(bins)
    hit = {"_hit": F.when(F.col(prediction) == 1, 1).otherwise(0)} if prediction else {}
    both = _both(reference, current, features, hit)
    spark = both.sparkSession
    row = both.agg(
        *_range_aggregates(features),
        *_moment_aggregates(features),
        *_total_aggregates(features),
        *([F.coalesce(F.avg("_hit"), F.lit(0.0)).alias("label_ratio")] if prediction else []),
    ).first()
    counted = value_counts(both, slice_cuts(both, features, row["_rows"], slices), COUNTS)
    return _report(spark, row, counted, features, buckets, bins, row.label_ratio if prediction else None)


def _report(
    spark: SparkSession,
    row: Row | Mapping[str, object],
    counted: DataFrame,
    features: Sequence[str],
    buckets: int,
    bins: str,
    label_ratio: float | None,
) -> DataFrame:
    """The report from one row of ranges, totals and moments, and the counts of distinct values."""
    shared = () if label_ratio is None else (label_ratio,)
    known = spark.createDataFrame(
        [(f, *[row[f"{f}__{m}"] for m in MOMENTS], *shared) for f in features],
        "feature string, " + ", ".join(f"{m} double" for m in MOMENTS) + ", label_ratio double" * len(shared),
    )
    edges = _edges_of(row, features, buckets)
    report = known.join(_psi_of_counts(counted, edges, features, bins), "feature", "left").join(
        _ks_of_counts(counted, row, features), "feature", "left"
    )
    return report.select("feature", "psi", "ks", *MOMENTS, *(["label_ratio"] if shared else []))
