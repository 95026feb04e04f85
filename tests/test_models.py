"""Models, evaluation and explanation."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.catalog.modelling import trained
from holdfast.operators import quantiles, rates
from holdfast.plans import explain, features, metrics, models
from holdfast.sources.projection import SourceTables


def auc(model, rows):
    scored = models.score_customers(model, rows)
    return metrics.roc_auc(scored, "label", "churn_probability").first()[0]


def test_models_rank_well(spark):
    # 300 test rows; the smallest data set has 30, too few for a floor.
    fitted = trained(SourceTables(spark, "/root/testdata/sf0.01"))
    assert auc(fitted.logistic, fitted.test) > 0.8
    assert auc(fitted.boosted, fitted.test) > 0.8


def test_all_customers_get_a_score(fitted, src):
    scored = models.score_customers(fitted.boosted, fitted.prepared)
    assert scored.count() == src.crm.count()
    joined = rates.join_scores(src.view.select("customer_id"), scored)
    assert rates.unscored_count(joined).first()[0] == 0
    assert scored.filter((F.col("churn_probability") > 0.5) != (F.col("prediction") == 1)).count() == 0


def test_reloaded_transformers_score_alike(fitted, tmp_path):
    path = models.save_model(fitted.preprocessor, str(tmp_path / "prep"))
    model_path = models.save_model(fitted.logistic, str(tmp_path / "model"))
    prepared = features.apply_preprocessor(models.load_preprocessor(path), fitted.split)
    again = models.score_customers(type(fitted.logistic).load(model_path), prepared)
    first = models.score_customers(fitted.logistic, fitted.prepared)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.select(*again.columns).collect()))


def test_logistic_fit_is_the_optimum_of_the_penalised_loss(fitted):
    rows = fitted.balanced.select("label", "features").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])
    beta, n = np.array(fitted.logistic.coefficients), len(rows)
    p = 1 / (1 + np.exp(-(x @ beta + fitted.logistic.intercept)))
    # Classes are balanced, so all weights are one; C is one.
    assert np.abs(x.T @ (p - y) + beta).max() / n < 1e-3
    assert abs((p - y).sum()) / n < 1e-3


@pytest.mark.parametrize("rows", [1_000_000, 5])
def test_auc_equals_the_evaluator(fitted, monkeypatch, rows):
    monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", rows)
    scored = fitted.logistic.transform(fitted.prepared)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    assert auc(fitted.logistic, fitted.prepared) == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()[0] == 0.875
    assert metrics.roc_auc(df.filter("label = 1")).first()[0] is None


def test_report_without_predictions_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    got = {r["row_name"]: r for r in metrics.classification_report(df).collect()}
    assert (got["Churned"]["precision"], got["Churned"]["recall"], got["Churned"]["f1"], got["Churned"]["support"]) == (0, 0, 0, 2)
    assert got["accuracy"]["f1"] == pytest.approx(1 / 3)
    cells = {(r["label"], r["prediction"]): r["rows"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_challenger_wins_ties(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name, score in (("logistic_regression", 0.8), ("boosted_trees", 0.8), ("other", 0.7)):
        models.log_run(spark, path, name, {"a": 1}, score)
    runs = models.read_runs(spark, path)
    assert runs.count() == 3 and runs.first()["params"] == {"a": "1"}
    assert {r["run_name"] for r in metrics.model_compare(runs).collect() if r["best"]} == {"boosted_trees"}
    best = metrics.model_compare(runs.filter("run_name <> 'boosted_trees'"))
    assert {r["run_name"] for r in best.collect() if r["best"]} == {"logistic_regression"}


@pytest.mark.parametrize("best", ["logistic_regression", "boosted_trees"])
def test_what_the_log_finds_best_is_saved_and_scored(spark, fitted, src, tmp_path, best):
    from holdfast.catalog.modelling import Trained

    path = str(tmp_path / "runs")
    for name, model in (("logistic_regression", fitted.logistic), ("boosted_trees", fitted.boosted)):
        models.log_run(spark, path, name, {}, 0.9 if name == best else 0.8, models.save_model(model, str(tmp_path / name)))
    chosen = Trained(src)
    chosen.__dict__.update(fitted.__dict__ | {"runs": models.read_runs(spark, path)})
    chosen.__dict__.pop("winner", None)
    assert type(chosen.winner) is type(fitted.logistic if best == "logistic_regression" else fitted.boosted)
    assert chosen.winner.uid == (fitted.logistic if best == "logistic_regression" else fitted.boosted).uid


def test_the_fit_does_not_depend_on_the_files(fitted):
    rows = fitted.balanced
    fits = [models.fit_boosted(rows.repartition(n), trees=3).featureImportances.toArray() for n in (1, 4, 16)]
    assert (fits[0] == fits[1]).all() and (fits[0] == fits[2]).all()


def test_trees_are_those_of_kept_node_ids(fitted):
    ours = models.fit_boosted(fitted.balanced, trees=6)
    kept = GBTClassifier(**{**models.BOOSTED, "maxIter": 6}, seed=42, cacheNodeIds=True).fit(models.laid_out(fitted.balanced))
    assert [t.toDebugString.split("\n")[1:] for t in ours.trees] == [t.toDebugString.split("\n")[1:] for t in kept.trees]
    assert list(ours.featureImportances) == list(kept.featureImportances)


def test_a_million_training_rows_are_not_cut_into_small_tasks():
    # 60 times the customers of sf 0.1 are 1,081,548 balanced rows; each level of 300 trees runs a task per partition.
    assert models.training_partitions(1_081_548) == 32


def test_training_partitions_follow_the_rows():
    assert [models.training_partitions(n, 100) for n in (0, 1, 100, 101, 200, 201, 400, 401)] == [1, 1, 1, 2, 2, 4, 4, 8]


def test_logistic_fit_is_optimal(fitted):
    """The gradient of the summed, balanced, penalised loss is zero at the fit."""
    rows = fitted.balanced.select("label", "features").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows], dtype=float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta = np.array(fitted.logistic.coefficients)
    off = weight * (1 / (1 + np.exp(-(x @ beta + fitted.logistic.intercept))) - y)
    gradient = np.append(x.T @ off + beta / models.LOGISTIC["C"], off.sum())
    assert np.abs(gradient).max() < 1e-3 * np.abs(weight[:, None] * x).sum(axis=0).max()


def test_linear_attributions_add_up(fitted):
    means = explain.feature_means(fitted.balanced, fitted.names)
    beta = np.array(fitted.logistic.coefficients)
    phi = explain.linear_attribution(fitted.test, list(beta), means, fitted.names)
    got = {r["customer_id"]: r["s"] for r in phi.groupBy("customer_id").agg(F.sum("phi").alias("s")).collect()}
    base = float(beta @ np.array(means)) + fitted.logistic.intercept
    for r in fitted.logistic.transform(fitted.test).select("customer_id", "rawPrediction").collect():
        assert got[r["customer_id"]] + base == pytest.approx(r["rawPrediction"][1], abs=1e-8)


def test_sampled_attributions_add_up(fitted):
    phi = fitted.attributions
    assert phi.count() == fitted.test.count() * len(fitted.names)
    got = {r["customer_id"]: r["s"] for r in phi.groupBy("customer_id").agg(F.sum("phi").alias("s")).collect()}
    scored = fitted.winner.transform(fitted.test).withColumn("margin", explain.margin(fitted.winner))
    for r in scored.select("customer_id", "margin", "probability").collect():
        assert got[r["customer_id"]] + fitted.base_value == pytest.approx(r["margin"], abs=1e-8)
        assert 1 / (1 + np.exp(-r["margin"])) == pytest.approx(r["probability"][1], abs=1e-9)


def test_sampled_attributions_of_a_linear_model_are_exact(fitted):
    background = explain.background_rows(fitted.prepared.filter("split = 'train'"), 2)
    phi = explain.sampled_shapley(fitted.logistic, fitted.test, background, fitted.names)
    exact = explain.linear_attribution(
        fitted.test, list(fitted.logistic.coefficients), list(np.mean(background, axis=0)), fitted.names)
    both = phi.join(exact.withColumnRenamed("phi", "want"), ["customer_id", "feature"])
    assert both.count() == phi.count()
    assert both.agg(F.max(F.abs(F.col("phi") - F.col("want")))).first()[0] < 1e-8
    assert both.agg(F.max("error")).first()[0] < 1e-6


def test_effects_by_leaves_are_those_of_scored_hybrids(spark, fitted):
    """Against scoring every step, with a customer that comes twice and one without a key."""
    model = models.fit_boosted(fitted.balanced, trees=7)
    background = explain.background_rows(fitted.prepared.filter("split = 'train'"), 3)
    rows = fitted.test.select("customer_id", vector_to_array("features").alias("x")).orderBy("customer_id").limit(6)
    other = rows.orderBy(F.desc("customer_id")).limit(1)
    rows = rows.unionByName(other).unionByName(other.select(F.lit(None).cast("string").alias("customer_id"), F.reverse("x").alias("x")))
    width = len(fitted.names)
    slow = explain.pair_effects(model, rows.repartition(2, "customer_id"), background, width, 3, 6).groupBy(
        "customer_id", "base", "idx").agg(F.sum("phi"), F.sum(F.col("phi") ** 2)).collect()
    want = {(r[0], r[1] * width + r[2]): r[3:] for r in slow}
    fast = explain._pair_sums(model, rows.repartition(2, "customer_id"), background, width, 3, 6, 42).collect()
    found = {(r["customer_id"], i): (s, ss) for r in fast for i, (s, ss) in enumerate(zip(r["s"], r["ss"]))}
    assert len(fast) == 7 and found.keys() == want.keys()
    assert all(found[k] == pytest.approx(tuple(want[k]), abs=1e-11) for k in want)
    assert sum(abs(s) > 1e-3 for s, _ in found.values()) > 20


def test_the_hybrids_of_trees_are_not_made(fitted, monkeypatch):
    # They were 46 rows for each of 16 permutations of a customer.
    monkeypatch.setattr(explain, "pair_effects", None)
    model = models.fit_boosted(fitted.balanced, trees=2)
    background = explain.background_rows(fitted.prepared.filter("split = 'train'"), 2)
    assert explain.sampled_shapley(model, fitted.test, background, fitted.names).count() == fitted.test.count() * len(fitted.names)


def test_sampled_attributions_reach_their_target(fitted):
    """Of a few trees: the stated errors are within the target, and the values agree with four times as many rounds."""
    model = models.fit_boosted(fitted.balanced, trees=5)
    background = explain.background_rows(fitted.prepared.filter("split = 'train'"), 2)
    rows = fitted.test.limit(8)
    found = explain.sampled_shapley(model, rows, background, fitted.names, target=0.02)
    effect = found.groupBy("customer_id").agg(F.sum(F.abs("phi")).alias("s")).agg(F.avg("s")).first()[0]
    errors = found.groupBy("customer_id").agg(F.sqrt(F.avg(F.col("error") ** 2)).alias("e"))
    assert errors.agg(F.max("e")).first()[0] <= 0.02 * effect + 1e-6
    more = explain.sampled_shapley(model, rows, background, fitted.names, target=0.0, most_rounds=64, seed=7)
    both = found.join(more.withColumnRenamed("phi", "want").drop("error"), ["customer_id", "feature"])
    assert both.count() == 8 * len(fitted.names)
    assert both.agg(F.sqrt(F.avg((F.col("phi") - F.col("want")) ** 2))).first()[0] <= 0.03 * effect


def test_riskiest_customer_is_explained(fitted):
    riskiest = rates.riskiest_customer(models.score_customers(fitted.winner, fitted.test))
    rows = explain.explain_customer(fitted.attributions, riskiest, fitted.base_value).collect()
    assert len(rows) == len(fitted.names) and len({r["customer_id"] for r in rows}) == 1
    sizes = [abs(r["phi"]) for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    top = explain.top_features(fitted.attributions, 15).collect()
    assert len(top) == 15 and top[0]["importance"] >= top[-1]["importance"]
