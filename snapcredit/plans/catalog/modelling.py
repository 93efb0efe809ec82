"""Training, selection and scoring on the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.models.boosting import prefix_margins, tree_facts
from snapcredit.models.registry import champion, load_champion, model_select, save_model
from snapcredit.models.scoring import batch_score, narrow_scores, positive_probability
from snapcredit.models.training import (
    CV_GBT_SPACE,
    GBT_SPACE,
    SearchResult,
    assembler,
    compact,
    cv_search,
    feature_columns,
    feature_scores,
    gbt,
    logreg,
    random_search,
    sample_space,
    split_stats,
)
from snapcredit.operators.aggregates import columns_like
from snapcredit.operators.credit import create_label, delinquency
from snapcredit.operators.evaluation import auc_exact
from snapcredit.operators.splits import training_sets
from snapcredit.plans import scorecard
from snapcredit.plans.catalog.base import LEDGER, ORDERS_BY_MONTH, exact_sum, ledger, orders_by_month, query
from snapcredit.plans.catalog.features import BUCKET
from snapcredit.plans.catalog.joining import supplier_months
from snapcredit.session import scratch_path

NOT_FEATURES = ("loan_id", "Customer_ID", "snapshot_date", "label_def", "label", "split")


def labelled_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the averages of their supplier in the same month, split for training."""
    labels = create_label(delinquency(ledger(spark, sf_dir)))
    keys = ["Customer_ID", "snapshot_date"]
    joined = labels.join(supplier_months(spark, sf_dir), keys, "left")
    return training_sets(joined, ["loan_id"])


#: What is stored once per session and folder: the splits, and the models fitted on them.
_stored: dict[tuple[object, ...], object] = {}


def sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The splits, stored once as a partitioned table as training does, so that fits only scan them."""
    key = (spark.sparkContext.applicationId, sf_dir, "sets")
    if key not in _stored:
        path = scratch_path(spark, "training_sets")
        loans = labelled_loans(spark, sf_dir)
        loans.hint("rebalance", "split").write.partitionBy("split").parquet(path)
        _stored[key] = path
    stored = spark.read.parquet(_stored[key])
    return {
        name: stored.where(F.col("split") == name)
        for name in ("training", "validation", "test", "oot_1", "oot_2", "oot_3")
    }


def _features(df: DataFrame) -> list[str]:
    return feature_columns(df, NOT_FEATURES)


def _fit(spark: SparkSession, sf_dir: str, kind: str) -> tuple[SearchResult, dict[str, DataFrame]]:
    data, key = sets(spark, sf_dir), (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _stored:
        train, validation = data["training"], data["validation"]
        estimator = gbt() if kind == "gbt" else logreg()
        _stored[key] = random_search(estimator, [{}], train, validation, _features(train))
    return _stored[key], data


@query("train_gbt")
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, data = _fit(spark, sf_dir, "gbt")
    return feature_scores(found.model, data["training"])


@query("train_logreg")
def train_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, data = _fit(spark, sf_dir, "logreg")
    return feature_scores(found.model, data["training"])


SPLITS = f"""WITH {LEDGER},
    aged AS (SELECT *, date_diff('month', snapshot_date, max(snapshot_date) OVER ()) AS age,
                    {BUCKET.format("loan_id::VARCHAR")} AS bucket FROM labels_gold),
    splits AS (SELECT *, CASE WHEN age < 3 THEN 'oot_' || (3 - age) WHEN bucket < 70 THEN 'training'
                              WHEN bucket < 85 THEN 'validation' ELSE 'test' END AS split FROM aged)"""

N_TRIALS = 100


def _once(spark: SparkSession, sf_dir: str, name: object, make: Callable[[], object]) -> object:
    """What `make` gives, kept under a name for the other queries of the session on the same tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def _random(spark: SparkSession, sf_dir: str, n_trials: int) -> SearchResult:
    data = sets(spark, sf_dir)
    train, validation = data.pop("training"), data.pop("validation")
    grid = sample_space(GBT_SPACE, n_trials)
    return random_search(gbt(), grid, train, validation, _features(train), further=data)


def _crossed(spark: SparkSession, sf_dir: str, n_trials: int) -> SearchResult:
    train = sets(spark, sf_dir)["training"]
    return cv_search(gbt(), sample_space(CV_GBT_SPACE, n_trials, distinct=True), train, _features(train))


@query("random_search")
def random_search_query(spark: SparkSession, sf_dir: str, n_trials: int = N_TRIALS) -> DataFrame:
    """Trials from the declared space; metrics of the winner on all sets."""
    found = _once(spark, sf_dir, (random_search, n_trials), lambda: _random(spark, sf_dir, n_trials))
    return spark.createDataFrame(sorted(found.metrics.items()), "metric string, value double")


@query("cv_search")
def cv_search_query(spark: SparkSession, sf_dir: str, n_trials: int = N_TRIALS) -> DataFrame:
    found = _once(spark, sf_dir, (cv_search, n_trials), lambda: _crossed(spark, sf_dir, n_trials))
    rows = [(i, t["cv_auc"]) for i, t in enumerate(found.trials)]
    return spark.createDataFrame(rows, "trial int, cv_auc double")


def _search_facts(
    spark: SparkSession, found: SearchResult, grid: list[dict], space: dict, metric: str, used: DataFrame
) -> DataFrame:
    """What must hold of any search, beside the rows and labels of the sets it used."""
    inside = sum(all(point[name] in values for name, values in space.items()) for point in grid)
    scores = [t[metric] for t in found.trials]
    facts = {
        "n_trials": len(grid),
        "n_inside": inside,
        "n_scored": sum(0 <= x <= 1 for x in scores),
        "winner_is_best": found.metrics[metric] == max(scores) and found.params == grid[scores.index(max(scores))],
    }
    return used.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("label").alias("n_pos"),
        *[F.lit(value).alias(name) for name, value in facts.items()],
    )


@query(
    "random_search_trials",
    f"""{SPLITS} SELECT split, count(*) AS n_rows, sum(label)::BIGINT AS n_pos, {N_TRIALS} AS n_trials,
      {N_TRIALS} AS n_inside, {N_TRIALS} AS n_scored, true AS winner_is_best
    FROM splits WHERE split IN ('training', 'validation') GROUP BY 1""",
)
def random_search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sets and trials of the random search."""
    found = _once(spark, sf_dir, (random_search, N_TRIALS), lambda: _random(spark, sf_dir, N_TRIALS))
    data = sets(spark, sf_dir)
    used = data["training"].unionByName(data["validation"])
    return _search_facts(spark, found, sample_space(GBT_SPACE, N_TRIALS), GBT_SPACE, "val_auc", used)


@query(
    "cv_search_trials",
    f"""{SPLITS} SELECT split, count(*) AS n_rows, sum(label)::BIGINT AS n_pos, {N_TRIALS} AS n_trials,
      {N_TRIALS} AS n_inside, {N_TRIALS} AS n_scored, true AS winner_is_best, {N_TRIALS} AS n_distinct
    FROM splits WHERE split = 'training' GROUP BY 1""",
)
def cv_search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set and the trials of the cross-validated search, all different."""
    found = _once(spark, sf_dir, (cv_search, N_TRIALS), lambda: _crossed(spark, sf_dir, N_TRIALS))
    grid = sample_space(CV_GBT_SPACE, N_TRIALS, distinct=True)
    facts = _search_facts(spark, found, grid, CV_GBT_SPACE, "cv_auc", sets(spark, sf_dir)["training"])
    return facts.withColumn("n_distinct", F.lit(len({tuple(sorted(p.items())) for p in grid})))


@query(
    "boosting_prefixes",
    f"""{SPLITS}, lengths AS (SELECT unnest([1, 4, 10]) AS n_trees)
    SELECT n_trees, count(*) AS n_rows, 0::BIGINT AS n_differ FROM splits, lengths WHERE split = 'validation' GROUP BY 1""",
)
def boosting_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose margin from the first trees of one ensemble is not that of an ensemble fitted so long."""
    data = sets(spark, sf_dir)
    assemble = assembler(_features(data["training"]))
    train, rows = (assemble.transform(data[n]).select("features", "label", "loan_id") for n in ("training", "validation"))
    train = compact(train)
    whole = gbt(maxIter=10, maxDepth=4).fit(train)
    margins = prefix_margins(whole, tree_facts(whole), rows, [1, 4, 10])
    for n in (1, 4, 10):
        alone = gbt(maxIter=n, maxDepth=4).fit(train).setRawPredictionCol("raw").transform(margins)
        off = F.abs(vector_to_array("raw")[1] - F.col(f"margin_{n}")) > 1e-9
        margins = alone.withColumn(f"off_{n}", off).drop("raw", "probability", "prediction")
    train.unpersist()
    counted = margins.agg(*[F.count_if(f"off_{n}").alias(str(n)) for n in (1, 4, 10)], F.count("*").alias("n_rows"))
    return counted.unpivot("n_rows", ["1", "4", "10"], "n_trees", "n_differ").withColumn(
        "n_trees", F.col("n_trees").cast("int")
    )


@query(
    "gbt_importances",
    f"""{SPLITS} SELECT 5::BIGINT AS n_features, 5::BIGINT AS n_named, true AS sum_is_one, true AS constant_is_zero,
      count(*) AS n_rows FROM splits WHERE split = 'training'""",
)
def gbt_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of a fitted model by name: they sum to 1, name each input once, and a constant has none."""
    data = sets(spark, sf_dir)
    train, validation = (data[n].withColumn("constant", F.lit(1.0)) for n in ("training", "validation"))
    columns = _features(train)
    found = random_search(gbt(maxIter=5), [{}], train, validation, columns)
    scores = feature_scores(found.model, train)
    known = F.count_distinct(F.when(F.col("feature").isin(columns), F.col("feature")))
    return scores.agg(
        F.count(F.lit(1)).alias("n_features"),
        known.alias("n_named"),
        (F.abs(F.sum("score") - 1) < 1e-9).alias("sum_is_one"),
        (F.max(F.when(F.col("feature") == "constant", F.col("score"))) == 0).alias("constant_is_zero"),
    ).withColumn("n_rows", F.lit(train.count()).cast("long"))


@query("model_save_load")
def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of a model on its test set before and after a round trip through the registry."""
    found, data = _fit(spark, sf_dir, "logreg")
    root = scratch_path(spark, "registry")
    save_model(spark, found, root, "logreg", "logreg_1")
    loaded, _ = load_champion(spark, root)
    return _test_auc(found.model, data, "fitted").unionByName(_test_auc(loaded, data, "loaded"))


def _test_auc(model: PipelineModel, data: dict[str, DataFrame], name: str) -> DataFrame:
    scored = batch_score(model, data["test"]).withColumn("score", positive_probability())
    return auc_exact(scored, "score").select(F.lit(name).alias("model"), "auc", "n_pos", "n_neg")


@query("batch_score")
def batch_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow scores of the newest snapshot."""
    found, data = _fit(spark, sf_dir, "gbt")
    scored = batch_score(found.model, data["oot_3"])
    return narrow_scores(scored, "gbt_1", ["loan_id", "Customer_ID", "snapshot_date"])


def _scorecard_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The sets of the fourteen months before a date, and the columns of their features."""

    def write() -> tuple[str, list[str]]:
        labels = create_label(delinquency(ledger(spark, sf_dir)))
        features = supplier_months(spark, sf_dir)
        path = scratch_path(spark, "scorecard_sets")
        scorecard.window_sets(labels, features, "2001-01-01", path, ["loan_id", "snapshot_date"])
        return path, columns_like(features, suffix="_avg")

    path, columns = _once(spark, sf_dir, "scorecard sets", write)
    return spark.read.parquet(path), columns


@query("scorecard")
def scorecard_query(spark: SparkSession, sf_dir: str, n_trials: int = N_TRIALS) -> DataFrame:
    """Card of a cross-validated search on the fourteen months before a date."""
    stored, columns = _scorecard_sets(spark, sf_dir)
    found = scorecard.train_scorecard(stored, columns, n_trials=n_trials)
    return scorecard.model_card(found.model, stored, "credit_model_2001_01_01")


@query(
    "scorecard_sets",
    f"""WITH {LEDGER},
    windowed AS (
      SELECT *, CASE WHEN snapshot_date >= DATE '2000-11-01' THEN 'oot' ELSE 'train_test' END AS side FROM labels_gold
      WHERE snapshot_date >= DATE '1999-11-01' AND snapshot_date < DATE '2001-01-01'),
    classes AS (
      SELECT side, label, count(*) AS n, CASE WHEN side = 'oot' THEN 0 ELSE ceil(round(count(*) * 0.2, 6))::BIGINT END AS test
      FROM windowed GROUP BY 1, 2),
    parts AS (
      SELECT 'oot' AS split, label, n FROM classes WHERE side = 'oot'
      UNION ALL SELECT 'test', label, test FROM classes WHERE side = 'train_test'
      UNION ALL SELECT 'train', label, n - test FROM classes WHERE side = 'train_test')
    SELECT split, sum(n)::BIGINT AS n_rows, sum(n * label)::BIGINT AS n_pos FROM parts GROUP BY 1""",
)
def scorecard_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positives of the sets of the score card."""
    stored, _ = _scorecard_sets(spark, sf_dir)
    return stored.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_pos"))


@query(
    "logreg_balance",
    f"""{SPLITS} SELECT count(*) AS n_rows, sum(label)::BIGINT AS n_pos, true AS balanced
    FROM splits WHERE split = 'training'""",
)
def logreg_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression without a penalty predicts as many positives as its training set has."""
    found, data = _fit(spark, sf_dir, "logreg")
    scored = batch_score(found.model, data["training"]).withColumn("score", positive_probability())
    off = F.abs(F.sum("score") - F.sum("label")) / F.count(F.lit(1))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_pos"), (off < 1e-3).alias("balanced")
    )


@query(
    "model_roundtrip",
    f"{SPLITS} SELECT split, count(*) AS n_rows, 0::BIGINT AS n_differ FROM splits WHERE split <> 'training' GROUP BY 1",
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a model scores otherwise after a round trip through the registry."""
    found, data = _fit(spark, sf_dir, "gbt")
    root = scratch_path(spark, "registry")
    save_model(spark, found, root, "gbt", "gbt_1")
    loaded, _ = load_champion(spark, root)
    rows = reduce(
        DataFrame.unionByName,
        [df.withColumn("split", F.lit(name)) for name, df in data.items() if name != "training"],
    )
    scored = batch_score(found.model, rows).withColumn("fitted", positive_probability())
    scored = batch_score(loaded, scored.drop("features", "rawPrediction", "probability", "prediction"))
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("fitted") != positive_probability()).alias("n_differ")
    )


@query(
    "batch_score_rows",
    f"""{SPLITS} SELECT snapshot_date, 'gbt_1' AS model_name, count(*) AS n_rows, count(*) AS n_scored,
      count(DISTINCT loan_id) AS n_loans FROM splits WHERE split LIKE 'oot%' GROUP BY 1""",
)
def batch_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the out-of-time snapshots has one score between 0 and 1."""
    found, data = _fit(spark, sf_dir, "gbt")
    rows = reduce(DataFrame.unionByName, [data[f"oot_{n}"] for n in (1, 2, 3)])
    scores = narrow_scores(batch_score(found.model, rows), "gbt_1", ["loan_id", "Customer_ID", "snapshot_date"])
    return scores.groupBy("snapshot_date", "model_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("model_predictions").between(0, 1)).alias("n_scored"),
        F.countDistinct("loan_id").alias("n_loans"),
    )


CANDIDATES = f"""WITH {ORDERS_BY_MONTH},
candidates AS (
  SELECT o_orderpriority AS model_name, year(snapshot_date) AS year,
         sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) / 1e6 AS val_auc
  FROM orders_by_month GROUP BY 1, 2)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in registry: a score per order priority and year."""
    score = exact_sum("o_totalprice") / F.count("*") / 1e6
    return (
        orders_by_month(spark, sf_dir)
        .groupBy(F.col("o_orderpriority").alias("model_name"), F.year("snapshot_date").alias("year"))
        .agg(score.alias("val_auc"))
    )


@query(
    "model_select",
    f"""{CANDIDATES} SELECT model_name, year::INT AS year, val_auc FROM candidates
    QUALIFY row_number() OVER (PARTITION BY year ORDER BY val_auc DESC, model_name DESC) = 1""",
)
def model_select_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_select(candidates(spark, sf_dir), "val_auc", by=("year",))


@query(
    "model_champion",
    f"""{CANDIDATES} SELECT model_name, 'm/' || model_name || '/' || year AS path, val_auc
    FROM candidates ORDER BY val_auc DESC, path DESC LIMIT 1""",
)
def model_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = candidates(spark, sf_dir).select(
        "model_name",
        F.concat_ws("/", F.lit("m"), "model_name", F.col("year").cast("string")).alias("path"),
        F.create_map(F.lit("val_auc"), "val_auc").alias("metrics"),
    )
    best = champion(registry)
    return best.select("model_name", "path", F.col("metrics")["val_auc"].alias("val_auc"))


@query(
    "model_card",
    f"""WITH {LEDGER},
    aged AS (SELECT *, date_diff('month', snapshot_date, max(snapshot_date) OVER ()) AS age,
                    {BUCKET.format("loan_id::VARCHAR")} AS bucket FROM labels_gold)
    SELECT CASE WHEN age < 3 THEN 'oot_' || (3 - age) WHEN bucket < 70 THEN 'training'
                WHEN bucket < 85 THEN 'validation' ELSE 'test' END AS split,
           count(*) AS n_rows, round(avg(label), 2) AS mean_label,
           min(snapshot_date) AS first_snapshot, max(snapshot_date) AS last_snapshot
    FROM aged GROUP BY 1""",
)
def model_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = create_label(delinquency(ledger(spark, sf_dir)))
    return split_stats(training_sets(labels, ["loan_id"]))
