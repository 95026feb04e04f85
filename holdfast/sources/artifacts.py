"""Feature, score and attribution tables on shared storage."""

from pyspark.sql import DataFrame, SparkSession


def features_write(prepared: DataFrame, path: str) -> str:
    prepared.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def features_read(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored if split is None else stored.filter(stored["split"] == split)


def scores_write(scores: DataFrame, path: str) -> str:
    """Keyed by customer, so that readers join instead of relying on row order."""
    scores.select("customer_id", "churn_probability", "prediction").write.mode("overwrite").parquet(path)
    return path


def attributions_write(attributions: DataFrame, path: str) -> str:
    attributions.select("customer_id", "feature", "phi").write.mode("overwrite").parquet(path)
    return path


def names_write(names: DataFrame, path: str) -> str:
    names.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def names_read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("idx int, name string").option("header", True).csv(path)
