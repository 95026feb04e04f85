"""Split, scaling, encoding and oversampling."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.plans import features, oversample


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_cut_is_the_wanted_row(spark, digits):
    ids = [f"c{i}" for i in range(500)]
    df = spark.createDataFrame([(i, int(n % 4 == 0)) for n, i in enumerate(ids)], "customer_id string, label int")
    cuts = {r["label"]: r["cut"]["i"] for r in features.hash_cuts(df, "customer_id", "label", F.lit(17), 42, digits).collect()}
    for label in (0, 1):
        own = [i for n, i in enumerate(ids) if int(n % 4 == 0) == label]
        assert cuts[label] == sorted(own, key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[16]


def test_split_is_complete_and_stratified(src):
    from holdfast.catalog.modelling import label_keys

    keys = label_keys(src)
    rows = features.stratified_split(keys).collect()
    assert len(rows) == keys.count() == len({r["customer_id"] for r in rows})
    for label in (0, 1):
        own = [r["split"] for r in rows if r["label"] == label]
        assert own.count("test") == int(len(own) * 0.2 + 0.5)


def test_hashed_split_share(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("customer_id"))
    share = features.hashed_split(df).filter("split = 'test'").count() / 20000
    assert share == pytest.approx(0.2, abs=0.02)


def _rows(spark, contracts):
    n = len(contracts)
    rows = [(f"c{i}", i % 2, float(i), c) for i, c in enumerate(contracts)]
    return spark.createDataFrame(rows[:n], "customer_id string, label int, tenure double, contract string")


def test_scaling_uses_population_deviation_of_the_training_rows(spark):
    df = _rows(spark, ["x"] * 4)
    train = df.filter("tenure < 3")
    got = [r["tenure"] for r in features.standard_scale(df, train, ["tenure"]).orderBy("customer_id").collect()]
    want = (np.arange(4) - 1.0) / np.std([0, 1, 2])
    assert got == pytest.approx(list(want))
    flat = features.standard_scale(df.withColumn("tenure", F.lit(3.0)), train.withColumn("tenure", F.lit(3.0)), ["tenure"])
    assert {r["tenure"] for r in flat.collect()} == {0.0}


def test_unseen_category_is_all_zeros_and_null_is_a_category(spark):
    train, new = _rows(spark, ["a", "b", None]), _rows(spark, ["z", "a", None])
    model = features.build_preprocessor(train).fit(train)
    assert features.feature_names(model) == ["tenure", "contract_None", "contract_a", "contract_b"]
    got = [r["x"][1:] for r in features.apply_preprocessor(model, new).orderBy("customer_id").select(
        vector_to_array("features").alias("x")).collect()]
    assert got == [[0, 0, 0], [0, 1, 0], [1, 0, 0]]
    long = {(r["customer_id"], r["feature"]): r["value"] for r in features.one_hot(new, train, ["contract"]).collect()}
    assert long == {
        (f"c{i}", f"contract_{c}"): int((i, c) in {(1, "a"), (2, "None")}) for i in range(3) for c in ("None", "a", "b")
    }


def test_a_hundred_thousand_categories(spark, monkeypatch):
    monkeypatch.setattr(features, "CATEGORIES_PER_RANGE", 9_000)
    rows = spark.range(150_000).select(
        F.concat(F.lit("c"), "id").alias("customer_id"),
        F.when(F.col("id") < 100_000, F.concat(F.lit("v"), F.col("id") * 7919 % 100_000)).otherwise("v5").alias("plan"),
        F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("kind"))
    dictionary = features.category_dictionary(rows, ["plan", "kind"])
    told = dictionary.toPandas()
    assert sorted(told["idx"]) == list(range(100_002))
    names = told.sort_values("idx")
    assert list(zip(names["column_name"], names["category"])) == (
        [("plan", c) for c in sorted(f"v{i}" for i in range(100_000))] + [("kind", "None"), ("kind", "x")])
    idx = dict(zip(zip(told["column_name"], told["category"]), told["idx"]))
    vectors = features.one_hot_vectors(rows, dictionary, ["plan", "kind"])
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan
    got = vectors.toPandas()
    assert len(got) == 150_000
    for name, ones in got.sample(500, random_state=1).itertuples(index=False):
        i = int(name[1:])
        own = f"v{i * 7919 % 100_000}" if i < 100_000 else "v5"
        assert list(ones) == [idx["plan", own], idx["kind", "None" if i % 3 == 0 else "x"]]


def test_the_split_counts_rows_of_the_view(spark):
    """Billing rows that the join drops have no part in the shares."""
    from holdfast.catalog.modelling import label_keys

    class Joined:
        crm = spark.range(100).select(F.col("id").cast("string").alias("customer_id"))
        services = crm
        billing = spark.range(1000).selectExpr("string(id) customer_id", "if(id % 2 = 0, 'Yes', 'No') churn")

    split = features.stratified_split(label_keys(Joined)).groupBy("label", "split").count().collect()
    assert sorted(map(tuple, split)) == [(0, "test", 10), (0, "train", 40), (1, "test", 10), (1, "train", 40)]


def test_oversampling_needs_two_classes(spark):
    for labels in ([1], [1, 2, 3], range(50)):
        rows = spark.createDataFrame([(str(i), int(c), [0.0]) for i, c in enumerate(labels)], "customer_id string, label int, features array<double>")
        with pytest.raises(ValueError):
            oversample.smote(rows)


def test_encoder_and_scaler_agree_with_the_fitted_pipeline(fitted):
    names = fitted.names
    assert names[: len(S.NUMERIC_COLUMNS)] == S.NUMERIC_COLUMNS
    scaled = features.standard_scale(fitted.split, fitted.train)
    numeric = {r["customer_id"]: [r[c] for c in S.NUMERIC_COLUMNS] for r in scaled.collect()}
    long = features.one_hot(fitted.split, fitted.train).filter("value = 1").collect()
    hot = {(r["customer_id"], r["feature"]) for r in long}
    vectors = features.apply_preprocessor(fitted.preprocessor, fitted.split).collect()
    for r in vectors:
        x = list(r["features"].toArray())
        assert x[:11] == pytest.approx(numeric[r["customer_id"]], rel=1e-9, abs=1e-9)
        assert {(r["customer_id"], n) for n, v in zip(names[11:], x[11:]) if v == 1} == {
            h for h in hot if h[0] == r["customer_id"]}


def test_synthetic_rows_balance_the_classes_and_lie_between_neighbours(fitted):
    train = fitted.train.select("customer_id", "label").collect()
    balanced = fitted.balanced.select("customer_id", "label", "synthetic", vector_to_array("features").alias("x")).collect()
    sizes = {c: sum(r["label"] == c for r in balanced) for c in (0, 1)}
    assert sizes[0] == sizes[1] == max(sum(r["label"] == c for r in train) for c in (0, 1))
    assert len({r["customer_id"] for r in balanced}) == len(balanced)
    minority = {r["customer_id"]: np.array(r["x"]) for r in balanced if r["label"] == 1 and not r["synthetic"]}
    ids, points = list(minority), np.array(list(minority.values()))
    for r in balanced:
        if not r["synthetic"]:
            continue
        origin = minority[r["customer_id"].split("#")[0]]
        p = np.array(r["x"])
        near = np.argsort(((points - origin) ** 2).sum(axis=1), kind="stable")[:8]
        gaps = []
        for j in near:
            d = points[j] - origin
            u = 0.0 if not d.any() else np.clip((p - origin) @ d / (d @ d), 0, 1)
            gaps.append(np.abs(origin + u * d - p).max())
        assert min(gaps) < 1e-9, ids


def test_oversampling_needs_two_classes(spark):
    df = spark.createDataFrame([("a", 1, [0.0])], "customer_id string, label int, x array<double>")
    with pytest.raises(ValueError):
        oversample.smote(df.select("customer_id", "label", array_to_vector("x").alias("features")))


def test_a_single_minority_row_cannot_be_oversampled(spark):
    rows = [(f"c{i}", int(i == 0), [float(i)]) for i in range(4)]
    df = spark.createDataFrame(rows, "customer_id string, label int, x array<double>")
    with pytest.raises(ValueError):
        oversample.smote(df.select("customer_id", "label", array_to_vector("x").alias("features")))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    got = {r["label"]: r["weight"] for r in oversample.class_weights(df).collect()}
    assert got == {0: pytest.approx(4 / 6), 1: 2.0}


def test_matrix_can_leave_out_the_leaking_score(src):
    derived = features.add_derived_features(src.view)
    assert "churn_score" in features.model_matrix(derived).columns
    assert "churn_score" not in features.model_matrix(derived, exclude=("churn_score",)).columns
