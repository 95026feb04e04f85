"""Classifiers, scoring and the run log."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.plans.features import SEED
from holdfast.plans.oversample import with_class_weights

# The training settings.
LOGISTIC = {"maxIter": 1000, "C": 1.0}
BOOSTED = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


#: Most training rows of one partition: a level of a tree is one pass over all, and a task's fixed cost is that of 20,000 rows.
ROWS_PER_PARTITION = 65_536


def training_partitions(rows: int, most: int = ROWS_PER_PARTITION) -> int:
    """Partitions of so many training rows: a power of two, so that a table that grows a little keeps its layout.

    The rows that a tree draws depend on it as on the seed, so it is logged with the run; given that number, a later fit of
    the same rows gives the same model.
    """
    return 1 << (max(1, -(-rows // most)) - 1).bit_length()


def laid_out(train: DataFrame, partitions: int | None = None) -> DataFrame:
    """The same rows in the same places and order, however the input is split."""
    return train.repartition(partitions or training_partitions(train.count()), "customer_id").sortWithinPartitions("customer_id")


def fit_logistic(
    train: DataFrame, max_iter: int = LOGISTIC["maxIter"], c: float = LOGISTIC["C"], partitions: int | None = None,
) -> LogisticRegressionModel:
    """L2-penalised, class-balanced. The penalty 1 / (C * sum of weights) is the one of a summed loss."""
    weighted = with_class_weights(laid_out(train, partitions))
    total = weighted.agg(F.sum("weight")).first()[0]
    estimator = LogisticRegression(
        maxIter=max_iter, regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False, weightCol="weight",
    )
    return estimator.fit(weighted)


def fit_boosted(
    train: DataFrame, trees: int = BOOSTED["maxIter"], seed: int = SEED, partitions: int | None = None,
) -> GBTClassificationModel:
    # Walking down five levels is cheaper than keeping the rows' nodes as one more table a level; the trees are the same.
    estimator = GBTClassifier(**{**BOOSTED, "maxIter": trees}, seed=seed, cacheNodeIds=False, checkpointInterval=10)
    return estimator.fit(laid_out(train, partitions))


def score_customers(model, prepared: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(customer_id, churn_probability, prediction) for every row given."""
    kept = [c for c in ("customer_id", "label", "split") if c in prepared.columns]
    scored = model.transform(prepared.select(*kept, "features")).select(
        *kept, F.get(vector_to_array("probability"), F.lit(1)).alias("churn_probability")
    )
    return scored.withColumn("prediction", F.when(F.col("churn_probability") > threshold, 1).otherwise(0))


def log_run(
    spark: SparkSession, path: str, run_name: str, params: dict, roc_auc: float, model_path: str | None = None
) -> None:
    row = [(run_name, {k: str(v) for k, v in params.items()}, float(roc_auc), model_path)]
    schema = "run_name string, params map<string,string>, roc_auc double, model_path string"
    run = spark.createDataFrame(row, schema).withColumn("ts", F.current_timestamp())
    run.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_preprocessor(path: str) -> PipelineModel:
    return PipelineModel.load(path)
