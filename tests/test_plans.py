"""Physical plans: what must not be in them, and what must."""

import re

import pytest

from snapcredit.operators.credit import create_label
from snapcredit.plans.catalog import ORACLES, QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans as they are for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {name: plan(QUERIES[name](spark, sf_dir)) for name in ORACLES}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_pairwise_joins(plans):
    assert not [n for n, p in plans.items() if re.search("NestedLoop|CartesianProduct", p)]


def test_no_python_on_the_executors(plans):
    assert not [n for n, p in plans.items() if re.search("Python|InPandas|ArrowEval", p)]


def test_broadcasts_are_checked(plans):
    # none is asked for: adaptive execution broadcasts what turns out to be small
    assert not {n for n, p in plans.items() if "BroadcastExchange" in p}


def test_windows_are_partitioned(plans):
    for name, p in plans.items():
        for window in re.findall(r"Window \[.*?windowspecdefinition\((.*?)specifiedwindowframe", p):
            first = window.split(",")[0]
            # the offsets of a category index are one row per sorted partition
            assert not re.search(" (ASC|DESC) ", first) or "_part" in first, (name, window)


def test_single_partition_only_for_totals(plans):
    # a row each: profiles, correlations, ends of the spine, one AUC, one champion; a row per partition
    single = {n for n, p in plans.items() if "Exchange SinglePartition" in p}
    assert single <= {
        "nonnull_profile", "describe_profile", "corr_matrix", "corr_matrix_by_suffix", "month_spine",
        "population_moments", "auc_exact", "auc_sliced", "model_champion", "string_index", "string_index_segment",
        "string_index_large", "logreg_balance", "boosting_prefixes", "gbt_importances", "named_datasets",
    }


def test_top_one_is_cut_before_the_shuffle(plans):
    for name in ("dedup_latest", "latest_per_key", "silver_clickstream", "asof_latest_sliced"):
        p = plans[name]
        assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit", p, re.S), name


def test_row_operators_do_not_shuffle(plans):
    for name in (
        "schema_enforce", "pattern_gated_cast", "range_validate", "domain_validate", "token_counts",
        "delinquency", "label_store", "one_hot", "hash_split", "silver_loans",
    ):
        assert "Exchange" not in plans[name], name


def test_scans_are_pruned(spark, sf_dir, plans, capsys, tmp_path):
    def explained(df):
        df.explain("formatted")
        return capsys.readouterr().out

    text = explained(QUERIES["label_store"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_orderkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_shipdate",
    }
    QUERIES["delinquency"](spark, sf_dir).write.parquet(str(tmp_path / "silver"))
    text = explained(create_label(spark.read.parquet(str(tmp_path / "silver"))))
    assert "PushedFilters: [IsNotNull(mob), EqualTo(mob,6)]" in text
    assert "PartitionFilters: [isnotnull(snapshot_date" in plans["snapshot_scan"]


def test_partial_aggregation(plans):
    assert plans["multi_avg"].count("HashAggregate") == 2
    assert plans["multi_avg"].count("Exchange") == 1


def test_as_of_windows_hold_a_slice_of_a_key(plans):
    windows = re.findall(r"Window \[last\(_hit.*?windowspecdefinition\((.*?) ASC", plans["asof_latest"])
    assert windows and all("_slice" in w for w in windows)
