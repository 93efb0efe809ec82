"""Validity intervals against the as-of join and plain Python."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from snapcredit.operators.history import asof_intervals, merge_intervals, validity_intervals
from snapcredit.operators.joins import asof_latest

D = dt.date
SCHEMA = "k string, t date, a long, b string"


def drawn(n, seed, start=0, days=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = D(2022, 11, 1) + dt.timedelta(days=start + rng.randrange(days))
        rows.append((rng.choice(["x", "y", "hot", "hot", None]), rng.choice([day, day, None]) if rng.random() < 0.1 else day,
                     rng.choice([1, 2, None]), rng.choice(["p", None])))
    return rows


def plain(rows):
    best = {}
    for k, t, a, b in rows:
        if k is not None and t is not None:
            payload = (a is not None, a or 0, b is not None, b or "")
            best[k, t] = max(best.get((k, t), payload), payload)
    out, by_key = [], {}
    for (k, t), p in sorted(best.items()):
        steps = by_key.setdefault(k, [])
        if not steps or steps[-1][1] != p:
            steps.append((t, p))
    for k, steps in by_key.items():
        for i, (t, p) in enumerate(steps):
            to = steps[i + 1][0] if i + 1 < len(steps) else None
            out.append((k, t, to, p[1] if p[0] else None, p[3] if p[2] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals(spark, seed):
    rows = drawn(300, seed)
    assert rows_of(validity_intervals(spark.createDataFrame(rows, SCHEMA), "k", "t")) == plain(rows)


def test_merge_equals_a_rebuild(spark):
    """Batches in order of time, one of them with keys that are new, end as one build of all rows."""
    batches = [drawn(150, 3, 0, 100), drawn(80, 4, 100, 100), [("new", D(2023, 9, 1), 1, "p")], drawn(80, 5, 320, 60)]
    history = validity_intervals(spark.createDataFrame(batches[0], SCHEMA), "k", "t")
    for batch in batches[1:]:
        history = merge_intervals(history, spark.createDataFrame(batch, SCHEMA), "k", "t")
    assert rows_of(history) == plain([r for b in batches for r in b])


def test_corrections(spark):
    old = [("x", D(2023, 1, 1), 1, "p"), ("x", D(2023, 5, 1), 2, "p"), ("y", D(2023, 1, 1), 1, "p")]
    history = validity_intervals(spark.createDataFrame(old, SCHEMA), "k", "t")
    fixed = merge_intervals(history, spark.createDataFrame([("x", D(2023, 5, 1), 1, "p")], SCHEMA), "k", "t")
    assert rows_of(fixed) == [("x", D(2023, 1, 1), None, 1, "p"), ("y", D(2023, 1, 1), None, 1, "p")]
    inside = merge_intervals(history, spark.createDataFrame([("x", D(2023, 3, 1), 9, "p")], SCHEMA), "k", "t")
    assert [r[1:4] for r in rows_of(inside) if r[0] == "x"] == [
        (D(2023, 1, 1), D(2023, 3, 1), 1), (D(2023, 3, 1), D(2023, 5, 1), 9), (D(2023, 5, 1), None, 2),
    ]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_asof(spark, kind):
    right = spark.createDataFrame(drawn(300, 7), SCHEMA).withColumn("t", F.col("t").cast("timestamp") + F.expr("interval 9 hours"))
    right = right.withColumn("t", F.col("t").cast(kind)).withColumnsRenamed({"a": "p", "b": "q"})
    left = spark.createDataFrame(drawn(400, 8, -60, 600), SCHEMA).withColumn("t", F.col("t").cast(kind))
    left = left.withColumn("id", F.monotonically_increasing_id()).cache()
    history = validity_intervals(right, "k", "t").cache()
    got = asof_intervals(left, history, "k", "t", ["p", "q"])
    assert got.columns == [*left.columns, "p", "q"]
    assert rows_of(got) == rows_of(asof_latest(left, right, "k", "t", "t", ["p", "q"]))
    since = asof_intervals(left, history, "k", "t", ["p"], matched_from="since").where("since is not null")
    assert since.where("since > t").count() == 0 and since.count() > 0
    with pytest.raises(ValueError, match="both sides"):
        asof_intervals(left.withColumn("p", F.lit(1)), history, "k", "t")


def test_empty_sides(spark):
    left, right = spark.createDataFrame(drawn(20, 1), SCHEMA), spark.createDataFrame([], SCHEMA)
    history = validity_intervals(right.withColumnsRenamed({"a": "p", "b": "q"}), "k", "t")
    assert asof_intervals(left, history, "k", "t").where("p is null").count() == 20
    full = validity_intervals(left.withColumnsRenamed({"a": "p", "b": "q"}), "k", "t")
    assert asof_intervals(right, full, "k", "t").count() == 0


def test_probe_is_one_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.createDataFrame(drawn(20, 1), SCHEMA)
        history = validity_intervals(left.withColumnsRenamed({"a": "p", "b": "q"}), "k", "t")
        plan = asof_intervals(left, history, "k", "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"(SortMergeJoin|NestedLoop|Cartesian|BroadcastHashJoin) \[(.*?)\]", plan)
    assert [j for j, _ in joins] == ["SortMergeJoin"] and "_of" in joins[0][1]
