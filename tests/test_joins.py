import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapcredit.operators.features import asof_feature_tables, join_feature_tables
from snapcredit.operators.joins import asof_latest, delayed_label_join, label_join, range_join_avg

EPOCH = dt.datetime(2023, 1, 1)


def history(seed, as_dates):
    """Left and right rows in which one key holds half of everything, with ties and gaps."""
    rng = random.Random(seed)

    def moment():
        t = EPOCH + dt.timedelta(hours=rng.randrange(0, 24 * 40))
        return t.date() if as_dates else t

    def key():
        return rng.choice(["hot"] * 5 + ["a", "b", "c", "d", None])

    left = [(i, key(), moment() if rng.random() > 0.03 else None) for i in range(300)]
    right = [(key(), moment(), i % 7, rng.random() if i % 9 else None) for i in range(150)]
    return left, right


def latest(left, right):
    found = {}
    for i, k, t in left:
        hits = [r for r in right if k is not None and t is not None and r[0] == k and r[1] <= t]
        best = max(hits, key=lambda r: (r[1], r[2], -1 if r[3] is None else r[3]), default=None)
        found[i] = (best[2], best[3], best[1]) if best else (None, None, None)
    return found


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("as_dates", [True, False])
@pytest.mark.parametrize("way", [{}, {"time_slice": "month"}, {"time_slice": "hour"}])
def test_asof_against_brute_force(spark, seed, as_dates, way):
    left, right = history(seed, as_dates)
    dtype = "date" if as_dates else "timestamp_ntz"
    l = spark.createDataFrame(left, f"id int, k string, t {dtype}").repartition(5)
    r = spark.createDataFrame(right, f"k string, t2 {dtype}, n int, v double").repartition(3)
    if as_dates and "time_slice" in way:
        way = {"time_slice": "month"}
    joined = asof_latest(l, r, "k", "t", "t2", tie_break=["n"], matched_time="at", **way)
    assert joined.columns == ["id", "k", "t", "n", "v", "at"]
    rows = joined.collect()
    assert len(rows) == len(left)
    assert {x.id: (x.n, x.v, x["at"]) for x in rows} == latest(left, right)
    assert all(x["at"] is None or x["at"] <= x.t for x in rows)


def test_asof_names(spark):
    df = spark.createDataFrame([("k", dt.date(2023, 1, 1), 1)], "k string, t date, v int")
    with pytest.raises(ValueError, match="both sides"):
        asof_latest(df, df, "k", "t", "t")
    renamed = asof_latest(df, df, "k", "t", "t", payload={"v": "v_before"})
    assert renamed.first().v_before == 1


@pytest.mark.parametrize("group_by", [["k", "t"], ["k"]])
def test_range_join_against_pairs(spark, group_by):
    rng = random.Random(5)
    day = lambda: dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(60))
    key = lambda: rng.choice(["hot"] * 4 + ["a", "b", None])
    facts = [(key(), day(), rng.choice([None, 1, 2, 3]), rng.randrange(10)) for _ in range(300)]
    starts = [(key(), day()) for _ in range(40)]
    found = range_join_avg(
        spark.createDataFrame(facts, "k string, t date, x int, y int"),
        spark.createDataFrame(starts, "k string, s date"),
        "k", "t", "s", ["x", "y"], group_by,
    )
    groups = {}
    for k, t, x, y in facts:
        for k2, s in starts:
            if k is not None and k == k2 and t <= s:
                groups.setdefault((k, t) if len(group_by) == 2 else (k,), []).append((x, y))

    def mean(values):
        known = [v for v in values if v is not None]
        return pytest.approx(sum(known) / len(known)) if known else None

    expected = {g: (mean([p[0] for p in ps]), mean([p[1] for p in ps])) for g, ps in groups.items()}
    actual = {tuple(r[c] for c in group_by): (r.x_avg, r.y_avg) for r in found.collect()}
    assert actual == expected


def test_labels(spark):
    d = dt.date
    features = spark.createDataFrame([("a", d(2023, 1, 1)), ("b", d(2023, 1, 1))], "Customer_ID string, snapshot_date date")
    labels = spark.createDataFrame(
        [("a", 1, d(2023, 7, 1)), ("a", 0, d(2023, 8, 1)), ("b", 0, d(2023, 8, 1))],
        "Customer_ID string, label int, snapshot_date date",
    )
    assert label_join(features, labels).count() == 3
    newest = {r.Customer_ID: r.label for r in label_join(features, labels, one_label_per_key=True).collect()}
    assert newest == {"a": 0, "b": 0}
    delayed = delayed_label_join(features, labels).collect()
    assert [(r.Customer_ID, r.label, r.label_snapshot) for r in delayed] == [("a", 1, d(2023, 7, 1))]


def test_feature_tables(spark):
    d = dt.date
    key = "Customer_ID string, snapshot_date date"
    attributes = spark.createDataFrame([("a", d(2023, 1, 1), 30), ("b", d(2023, 1, 1), 40)], f"{key}, Age int")
    financials = spark.createDataFrame([("a", d(2023, 1, 1), 5), ("b", d(2023, 1, 1), 6), ("b", d(2023, 2, 1), 7)], f"{key}, debt int")
    clicks = spark.createDataFrame([("a", d(2023, 1, 1), 3), ("b", d(2023, 1, 1), 8), ("b", d(2023, 2, 1), 9)], f"{key}, fe_1 int")
    loans = spark.createDataFrame([("a", d(2023, 1, 1), 0), ("b", d(2022, 12, 1), 0), ("a", d(2023, 2, 1), 1)], f"{key}, mob int")
    joined = join_feature_tables(attributes, financials, clicks, loans, ["fe_1"])
    assert {r.Customer_ID: (r.Age, r.debt, r.fe_1_avg) for r in joined.collect()} == {
        "a": (30, 5, 3.0), "b": (40, 6, None),
    }
    chained = asof_feature_tables(clicks, attributes, financials).orderBy("Customer_ID", "snapshot_date")
    assert [tuple(r)[2:] for r in chained.collect()] == [(3, 30, 5), (8, 40, 6), (9, 40, 7)]


def test_skewed_key_does_not_reach_one_task(spark):
    """Rows of a hot key are reduced to one per date before they are sorted together."""
    days = F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 30).cast("int"))
    left = spark.range(20_000).select("id", F.lit("hot").alias("k"), days.alias("t"))
    right = spark.range(5_000).select(F.lit("hot").alias("k"), days.alias("t2"), F.col("id").alias("v"))
    joined = asof_latest(left, right, "k", "t", "t2")
    assert joined.count() == 20_000
    assert "WindowGroupLimit" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.max("v")).first()[0] == 4_999


def test_asof_never_looks_ahead_across_types(spark):
    """A date is the midnight it begins with: a row of later that day is not known yet."""
    left = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 1, 2))], "k string, t date")
    right = spark.createDataFrame(
        [("a", dt.datetime(2019, 12, 31, 5), 1), ("a", dt.datetime(2020, 1, 1, 5), 2)], "k string, t2 timestamp, v int"
    )
    joined = asof_latest(left, right, "k", "t", "t2").orderBy("t")
    assert [(r.t, r.v) for r in joined.collect()] == [(dt.date(2020, 1, 1), 1), (dt.date(2020, 1, 2), 2)]
    back = asof_latest(right, left.withColumn("n", F.lit(7)), "k", "t2", "t").orderBy("t2")
    assert [r.n for r in back.collect()] == [None, 7]


def test_asof_carries_maps(spark):
    left = spark.createDataFrame([("a", dt.date(2020, 1, 1))], "k string, t date")
    right = spark.createDataFrame([("a", dt.date(2019, 1, 1), {"x": 1})], "k string, t2 date, m map<string,int>")
    assert asof_latest(left, right, "k", "t", "t2").first().m == {"x": 1}


def test_hot_key_of_a_range_join_is_cut_by_month(spark):
    """One key with most distinct dates: the running count of starts sees one month of it at a time."""
    dates = F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int"))
    facts = spark.range(4_000).select(F.lit("hot").alias("k"), dates.alias("t"), F.col("id").alias("x"))
    starts = spark.range(0, 4_000, 7).select(F.lit("hot").alias("k"), dates.alias("s"))
    joined = range_join_avg(facts, starts, "k", "t", "s", ["x"], ["k"])
    weights = [(i, sum(1 for s in range(0, 4_000, 7) if s >= i)) for i in range(4_000)]
    expected = sum(i * w for i, w in weights) / sum(w for _, w in weights)
    assert joined.first().x_avg == pytest.approx(expected)
    assert "_month" in joined._jdf.queryExecution().executedPlan().toString()
