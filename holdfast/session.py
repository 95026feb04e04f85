"""Session settings and the shared scratch folder."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose measured partitions fit in memory build a hash map instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Per-customer streaming state outgrows executor heaps; keep it in RocksDB with changelog checkpoints.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "holdfast", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root of the folder all executors see; on one machine a local one is made where none is named."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="holdfast-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def small_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A few literal rows as a local relation, whose size the optimizer knows."""
    return spark.createDataFrame(pa.table(columns), schema=schema)


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/holdfast/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediates of this application; frames that read them can no longer be used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def wide_parallelism(spark: SparkSession) -> int:
    """Partitions for steps whose work is out of proportion to their bytes, which adaptive execution would join."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For a result that several branches of a query use: it is computed once, its lineage ends there, and losing an
    executor loses nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
