"""The whole product on synthetic sources: bronze to monitoring."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapcredit.models.registry import champion, load_champion, read_registry
from snapcredit.models.scoring import narrow_scores
from snapcredit.models.training import GBT_SPACE, LOGREG_SPACE, sample_space, top_features
from snapcredit.plans import credit_tables as tables
from snapcredit.plans import medallion as m

START, END = "2023-01-01", "2024-04-01"
MONTHS, CUSTOMERS = 16, 60


def noise(*columns):
    return F.abs(F.xxhash64(*columns))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Four CSV sources: a row per customer and month, one loan per customer, some dirt."""
    root = tmp_path_factory.mktemp("sources")
    keys = spark.range(CUSTOMERS * MONTHS).select(
        F.concat(F.lit("CUS_"), (F.col("id") % CUSTOMERS).cast("string")).alias("Customer_ID"),
        (F.col("id") / CUSTOMERS).cast("int").alias("m"),
        (F.col("id") % CUSTOMERS).cast("int").alias("c"),
    ).withColumn("snapshot_date", F.add_months(F.lit(dt.date(2023, 1, 1)), F.col("m")))

    def text(seed, span):
        return (noise(F.lit(seed), "c", "m") % span).cast("string")

    def choose(values, seed):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (noise(F.lit(seed), "c") % len(values) + 1).cast("int"))

    clicks = keys.select(
        *[text(i, 100).alias(c) for i, c in enumerate(tables.CLICK_MEASURES)], "Customer_ID", "snapshot_date"
    )
    attributes = keys.select(
        "Customer_ID",
        F.lit("somebody").alias("Name"),
        F.when(F.col("c") % 9 == 0, "-500").otherwise((F.col("c") % 60 + 18).cast("string")).alias("Age"),
        F.lit("000-00-0000").alias("SSN"),
        choose([*tables.OCCUPATIONS, "_______"], 1).alias("Occupation"),
        "snapshot_date",
    )
    money = [c for c in tables.POSITIVE_COLUMNS + tables.PERCENT_COLUMNS]
    financials = keys.select(
        "Customer_ID",
        *[text(100 + i, 150).alias(c) for i, c in enumerate(money)],
        choose([*tables.CREDIT_MIXES, "_"], 2).alias("Credit_Mix"),
        choose([*tables.PAYMENT_BEHAVIOURS, "!@9#%8"], 3).alias("Payment_Behaviour"),
        F.lit("3 Years and 2 Months").alias("Credit_History_Age"),
        F.lit("No").alias("Payment_of_Min_Amount"),
        choose(["Auto Loan, and Auto Loan", "Payday Loan"], 4).alias("Type_of_Loan"),
        "snapshot_date",
    )
    # loans start in one of the first nine months; who falls behind depends on a click measure
    behind = (noise(F.lit(0), "c") % 100 > 50) & (F.col("mob") > 3)
    loans = (
        keys.withColumn("mob", F.col("m") - F.col("c") % 9)
        .where(F.col("mob").between(0, 10))
        .select(
            F.concat_ws("_", "Customer_ID", F.lit("loan")).alias("loan_id"),
            "Customer_ID",
            F.add_months("snapshot_date", -F.col("mob")).alias("loan_start_date"),
            F.lit("10").alias("tenure"),
            F.col("mob").cast("string").alias("installment_num"),
            F.lit("1000").alias("loan_amt"),
            F.lit("100").alias("due_amt"),
            F.lit("0").alias("paid_amt"),
            F.when(behind, "250.5").otherwise("0").alias("overdue_amt"),
            F.lit("500").alias("balance"),
            "snapshot_date",
        )
    )
    frames = {
        "clickstream_data": clicks, "customer_attributes": attributes,
        "customer_financials": financials, "loan_data": loans,
    }
    for name, df in frames.items():
        df.coalesce(2).write.option("header", True).csv(str(root / name))
    return {name: str(root / name) for name in frames}


@pytest.fixture(scope="module")
def gold(spark, sources, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    bronze = {n: str(root / "bronze" / n) for n in sources}
    silver = {n: str(root / "silver" / n) for n in sources}
    for name, path in sources.items():
        m.ingest(spark, path, bronze[name], START, END, str(root / "ingested"))
    built = m.refresh(spark, bronze, silver, START, END, str(root / "refreshed"))
    assert all(len(dates) == MONTHS for dates in built.values())
    assert not any(m.refresh(spark, bronze, silver, START, END).values())
    clean = {n: spark.read.parquet(p) for n, p in silver.items()}
    labels = m.gold_labels(clean["loan_data"])
    features = m.gold_features(
        clean["customer_attributes"], clean["customer_financials"], clean["clickstream_data"], clean["loan_data"]
    )
    m.write_snapshots(labels, str(root / "labels"))
    m.write_snapshots(features, str(root / "features"))
    return {
        "root": root, "clean": clean,
        "labels": spark.read.parquet(str(root / "labels")),
        "features": spark.read.parquet(str(root / "features")),
    }


def test_counts_are_logged(spark, gold):
    ingested = {r.bronze.rsplit("/", 1)[1]: r for r in spark.read.json(str(gold["root"] / "ingested")).collect()}
    assert set(ingested) == set(gold["clean"])
    assert all(r.n_rows > r.no_date + r.outside >= 0 for r in ingested.values())
    refreshed = spark.read.json(str(gold["root"] / "refreshed"))
    for name, df in gold["clean"].items():
        rows = refreshed.where(F.col("table") == name).collect()
        assert len(rows) == MONTHS and sum(r.rows_after for r in rows) == df.count()
        assert all(r.rows_removed == r.rows_before - r.rows_after for r in rows)


def test_silver(gold):
    attributes = gold["clean"]["customer_attributes"]
    assert attributes.count() == MONTHS * CUSTOMERS
    assert "Name" not in attributes.columns and "SSN" not in attributes.columns
    assert attributes.where("Age = 0").count() == MONTHS * len(range(0, CUSTOMERS, 9))
    assert attributes.where(~F.col("Occupation").isin(tables.OCCUPATIONS)).count() == 0
    financials = gold["clean"]["customer_financials"]
    assert financials.agg(F.max("Interest_Rate")).first()[0] < 100
    assert [r[0] for r in financials.select("Credit_History_Age").distinct().collect()] == [38]


def test_gold(gold):
    features, labels = gold["features"], gold["labels"]
    assert features.count() == MONTHS * CUSTOMERS
    assert "Occupation_Other" not in features.columns and "Occupation" not in features.columns
    flags = [c for c in features.columns if c.startswith("Credit_Mix_")]
    assert sorted(flags) == ["Credit_Mix_Bad", "Credit_Mix_Good", "Credit_Mix_Standard"]
    assert set(r[0] for r in features.select("LoanType_Auto_Loan_Count").distinct().collect()) == {0, 2}
    assert features.where(F.col("fe_1_avg").isNull()).count() == 0
    assert labels.count() == CUSTOMERS
    assert 0 < labels.where("label = 1").count() < CUSTOMERS


@pytest.fixture(scope="module")
def trained(spark, gold):
    root = gold["root"]
    sets, registry = str(root / "training"), str(root / "registry")
    m.write_training_sets(gold["features"], gold["labels"], sets, START, END)
    with pytest.raises(ValueError, match="at least 12"):
        m.write_training_sets(gold["features"], gold["labels"], sets, START, END, n_oot=5)
    small = {"maxIter": [2], "maxDepth": [2]}
    spaces = m.GBT_SPACE, m.LOGREG_SPACE
    m.GBT_SPACE, m.LOGREG_SPACE = GBT_SPACE | small, LOGREG_SPACE | {"maxIter": [10]}
    try:
        m.train_models(spark, sets, registry, n_trials=2)
    finally:
        m.GBT_SPACE, m.LOGREG_SPACE = spaces
    return {"sets": sets, "registry": registry}


def test_training(spark, trained):
    found = read_registry(spark, trained["registry"])
    metrics = {r.model_type: r.metrics for r in found.collect()}
    assert set(metrics) == {"gbt", "logreg"}
    expected = {"train_auc", "val_auc", "test_auc", "oot_1_auc", "oot_2_auc", "oot_3_auc"}
    assert all(set(v) == expected for v in metrics.values())
    best = champion(found).first()
    assert best.metrics["val_auc"] == max(v["val_auc"] for v in metrics.values())
    assert len(best.top_features) == 10
    assert champion(found, "unknown").count() == 0
    with pytest.raises(ValueError, match="unknown"):
        load_champion(spark, trained["registry"], "unknown")
    assert sample_space(GBT_SPACE, 5) == sample_space(GBT_SPACE, 5)


def test_scoring_and_monitoring(spark, gold, trained):
    path, log = str(gold["root"] / "predictions"), str(gold["root"] / "log")
    snapshots = ["2023-03-01", "2023-09-01"]
    for _ in range(2):
        m.score(spark, trained["registry"], gold["features"], snapshots, path)
    predictions = spark.read.parquet(path)
    assert predictions.count() == 2 * CUSTOMERS
    narrow = narrow_scores(predictions, "champion")
    assert narrow.columns == ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]
    assert narrow.where("model_predictions between 0 and 1").count() == 2 * CUSTOMERS
    model, row = load_champion(spark, trained["registry"])
    features = [f.feature for f in row.top_features]
    assert features == [r.feature for r in top_features(model, predictions).collect()]
    training = m.load_datasets(spark, trained["sets"])["training"]
    for snapshot in snapshots:
        m.monitor(predictions, training, gold["labels"], features, snapshot, log)
    found = m.metrics_log(spark, log)
    assert found.count() == 20
    known = {r.snapshot_date: r.n for r in found.groupBy("snapshot_date").agg(F.count("auc").alias("n")).collect()}
    # the labels of September judge the predictions of March
    assert known == {dt.date(2023, 3, 1): 10, dt.date(2023, 9, 1): 0}


def test_fewer_out_of_time_months_leave_no_stale_sets(spark, gold, tmp_path):
    path = str(tmp_path / "sets")
    for n_oot, names in ((3, {"oot_1", "oot_2", "oot_3"}), (2, {"oot_1", "oot_2"})):
        m.write_training_sets(gold["features"], gold["labels"], path, START, END, n_oot=n_oot)
        assert {n for n in m.load_datasets(spark, path) if n.startswith("oot")} == names


def test_a_retrain_that_scores_lower_is_not_read_as_the_old_one(spark, trained, tmp_path):
    from snapcredit.models.registry import save_model
    from snapcredit.models.training import SearchResult

    model, row = load_champion(spark, trained["registry"])
    root = str(tmp_path / "registry")
    for name, auc in (("a", 1.0), ("b", 0.7), ("a", 0.6)):
        save_model(spark, SearchResult(model, {}, {"val_auc": auc}), root, "gbt", name)
    found = read_registry(spark, root)
    assert {r.model_name: r.metrics["val_auc"] for r in found.collect()} == {"a": 0.6, "b": 0.7}
    assert champion(found).first().model_name == "b"
    names = [r.model_name for r in read_registry(spark, trained["registry"]).collect()]
    assert len(set(names)) == len(names) == 2


def test_monitoring_an_empty_month(spark, gold, trained, tmp_path):
    path, log = str(tmp_path / "predictions"), str(tmp_path / "log")
    m.score(spark, trained["registry"], gold["features"], ["2023-03-01"], path)
    training = m.load_datasets(spark, trained["sets"])["training"]
    m.monitor(spark.read.parquet(path), training, gold["labels"], None, "2023-04-01", log)
    rows = m.metrics_log(spark, log).collect()
    assert rows and all(r.label_ratio == 0 and r.psi is None for r in rows)


def test_silver_projections_are_compiled(spark):
    """Cleaning 20 columns in one generated method is too large for HotSpot unless the session limits methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    held = spark.conf.get(name)
    raw = spark.createDataFrame([("c", "2023-01-01", *["1"] * 20)], ["Customer_ID", "snapshot_date", *tables.CLICK_MEASURES])
    try:
        spark.conf.set(name, "65535")  # the default of a session that was made elsewhere
        m.silver(raw, "clickstream_data")
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "9000")
        m.silver(raw, "clickstream_data")
        assert spark.conf.get(name) == "9000"
    finally:
        spark.conf.set(name, held)
