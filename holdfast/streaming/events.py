"""Incremental intake of usage events."""

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.operators.view360 import usage_totals

LATENESS = "60 days"
#: Most files that one batch of the intake writes for a day.
FILES_PER_DAY = 8
#: Batches of totals that are read beside the base before they are folded into it.
FOLD_BATCHES = 16
OLDEST = -(2**62)


def read_event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.CDR).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _ended(query) -> tuple[int, datetime | None]:
    """Waits for the end of the query; rows it dropped for being late and its last watermark, over all its batches.

    A query remembers its last batches only, so they are gathered while it runs.
    """
    dropped: dict[int, int] = {}
    watermark = None
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        for progress in query.recentProgress:
            dropped[progress.batchId] = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            if "watermark" in progress.eventTime:
                at = datetime.fromisoformat(progress.eventTime["watermark"]).replace(tzinfo=None)
                watermark = max(at, watermark or at)
    return sum(dropped.values()), watermark


def _keyed(events: DataFrame) -> DataFrame:
    """The events with event_key, which copies share, and event_day, by which they are stored.

    An event without an id is no copy of another one; its key is its place in the feed, the same whenever it is read.
    """
    place = F.concat_ws("#", F.lit("none"), "_metadata.file_path", "_metadata.row_index")
    return events.select(
        "*", F.coalesce(F.col("event_id").cast("string"), place).alias("event_key"),
        F.to_date("event_date").alias("event_day"),
    )


def stream_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    lateness: str = LATENESS,
    files_per_trigger: int | None = None,
) -> int:
    """Append new events once per event id, and all events without one; returns how many rows came too late.

    Ids are remembered for ``lateness`` behind the newest event, which bounds the state. Rows older than that pass the
    stream by and are merged beside the target by ``add_late``; ``ingested`` reads both. Two queries follow the feed: an
    outer one takes the list of new files, the inner one takes all of these in, then the outer one looks at the same files
    again for what the watermark made the inner one drop. So a failure anywhere is made good by the next run, and files
    that arrive meanwhile wait for it. Copies have the same id and day. Run with a UTC session so that both casts of the
    event time are exact.
    """
    late = 0

    def settle(files: DataFrame, batch_id: int) -> None:
        nonlocal late
        late, watermark = _take_in(spark, source, target, checkpoint, lateness, files_per_trigger)
        # Only what is older than the watermark can have been dropped; without one any row might, in a run that failed.
        old = files if watermark is None else files.where(
            F.col("event_date").isNull() | (F.col("event_date") <= F.lit(watermark).cast("timestamp_ntz")))
        add_late(spark, old, target, batch_id)

    query = (
        _keyed(read_event_stream(spark, source)).writeStream.foreachBatch(settle)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}-late").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return late


def _take_in(
    spark: SparkSession, source: str, target: str, checkpoint: str, lateness: str, files_per_trigger: int | None,
) -> tuple[int, datetime | None]:
    """Append the feed's new events that are not older than the watermark; rows dropped, and the last watermark."""
    events = _keyed(read_event_stream(spark, source, files_per_trigger))
    timed = events.withColumn("event_date", F.col("event_date").cast("timestamp"))
    unique = timed.withWatermark("event_date", lateness).dropDuplicatesWithinWatermark(["event_key"])
    stored = unique.withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))
    # A day has a few files of each batch, also if it holds most of the rows.
    spread = stored.withColumn("_file", F.pmod(F.xxhash64("event_key"), F.lit(FILES_PER_DAY)))
    query = (
        spread.repartition("event_day", "_file").drop("_file")
        .writeStream.format("parquet").outputMode("append").option("path", target).partitionBy("event_day")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    return _ended(query)


def _late(target: str) -> str:
    return f"{target.rstrip('/')}-late"


def _held(spark: SparkSession, path: str, more: str = "") -> DataFrame | None:
    """Stored events with their key and day; None if the folder is not there yet."""
    try:
        return spark.read.schema(f"{_fields(S.CDR)}, event_key string{more}, event_day date").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _fields(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """All events taken in: those of the stream and those that came too late for it."""
    # The stream's folder lists its files in a log of its own, so late rows have a folder beside it.
    columns = [f.name for f in S.CDR]
    stored, late = _held(spark, target), _held(spark, _late(target), ", batch_id long")
    if stored is None:
        return spark.createDataFrame([], S.CDR)
    return stored.select(columns) if late is None else stored.select(columns).union(late.select(columns))


def held_keys(spark: SparkSession, target: str, days: list, batch_id: int) -> DataFrame:
    """Keys of the events of these days in the target and in its late batches but this one; no other day's file is read."""
    dated = [day for day in days if day is not None]
    chosen = F.col("event_day").isin(dated) if dated else F.lit(False)
    if None in days:
        chosen = chosen | F.col("event_day").isNull()
    keys = spark.createDataFrame([], "event_key string")
    stored, late = _held(spark, target), _held(spark, _late(target), ", batch_id long")
    if stored is not None:
        keys = stored.where(chosen).select("event_key")
    if late is not None:
        keys = keys.union(late.where(chosen & (F.col("batch_id") != batch_id)).select("event_key"))
    return keys


def add_late(spark: SparkSession, old: DataFrame, target: str, batch_id: int) -> None:
    """Put those of the keyed rows beside the target that it lacks, once for each key.

    Only the days that the rows touch are read; their list is the one thing that reaches the driver, one value for each
    day at most. A repeated batch replaces its own rows.
    """
    days = [row["event_day"] for row in old.select("event_day").distinct().collect()]
    if not days:
        return
    missing = old.dropDuplicates(["event_key"]).join(held_keys(spark, target, days, batch_id), "event_key", "left_anti")
    spread = missing.withColumn("_file", F.pmod(F.xxhash64("event_key"), F.lit(FILES_PER_DAY)))
    placed = spread.repartition("event_day", "_file").select(*[f.name for f in S.CDR], "event_key", "event_day")
    placed.write.mode("overwrite").partitionBy("event_day").parquet(f"{_late(target)}/batch_id={batch_id}")


def _children(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Complete folders `<prefix>=<number>` of a path by their number."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    found = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{prefix}=") and files.exists(done):
            found[int(name.split("=")[1])] = f"{path.rstrip('/')}/{name}"
    return found


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stream_usage_totals(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_trigger: int | None = None
) -> None:
    """Keep running usage totals per customer.

    Each batch writes the customers it changed into its own folder; a repeated batch replaces the same folder. Every
    FOLD_BATCHES batches these are folded into a table of all customers, see ``keep_totals``.
    """
    totals = usage_totals(read_event_stream(spark, source, files_per_trigger))
    query = (
        totals.writeStream.outputMode("update").foreachBatch(lambda batch, number: keep_totals(batch, target, number))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def keep_totals(batch: DataFrame, target: str, batch_id: int, fold: int = FOLD_BATCHES) -> None:
    """Store the customers that a batch changed, and after each `fold` batches fold them into the base.

    The base is one row per customer, hashed by customer, up to a stated batch; the batches after it are read beside it, so
    a read costs the customers and `fold` batches at most, however many there were. What the base before last covers is
    deleted: a repeated batch still finds what it folds, and a reader of the base before this one still finds its files.
    """
    batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
    if (batch_id + 1) % fold:
        return
    spark = batch.sparkSession
    _newest(spark, target, batch_id - 1, batch_id).write.mode("overwrite").parquet(f"{target}/base={batch_id}")
    bases = sorted(_children(spark, target, "base"))
    if len(bases) > 1:
        previous = bases[-2]
        old = [path for number, path in _children(spark, target, "batch_id").items() if number <= previous]
        for path in old + [f"{target}/base={number}" for number in bases[:-2]]:
            _delete(spark, path)


def total_folders(
    spark: SparkSession, target: str, base_until: int | None = None, until: int | None = None,
) -> tuple[str | None, list[str]]:
    """The newest base (up to a batch), if there is one, and the batches after it (up to a batch)."""
    bases = {n: path for n, path in _children(spark, target, "base").items() if base_until is None or n <= base_until}
    after = max(bases) if bases else None
    batches = [path for n, path in sorted(_children(spark, target, "batch_id").items())
               if (after is None or n > after) and (until is None or n <= until)]
    return bases.get(after), batches


def _newest(spark: SparkSession, target: str, base_until: int | None = None, until: int | None = None) -> DataFrame:
    base, batches = total_folders(spark, target, base_until, until)
    # The base counts as older than each batch that is read beside it.
    parts = [spark.read.parquet(base).withColumn("batch_id", F.lit(OLDEST))] if base else []
    if batches:
        parts.append(spark.read.option("basePath", target).parquet(*batches).withColumn("batch_id", F.col("batch_id").cast("long")))
    changes = reduce(DataFrame.unionByName, parts)
    measures = [c for c in changes.columns if c not in ("customer_id", "batch_id")]
    newest = changes.groupBy("customer_id").agg(F.max_by(F.struct(*measures), "batch_id").alias("row"))
    return newest.select("customer_id", "row.*")


def latest_totals(spark: SparkSession, target: str) -> DataFrame:
    """The newest row of each customer: the base, and the at most FOLD_BATCHES batches after it."""
    return _newest(spark, target)


def compact_totals(spark: SparkSession, target: str, compacted: str) -> str:
    """Write the newest rows as the base of a fresh folder, for readers to switch to and batches to go on in.

    Run it while no batch is active. The compacted rows count as older than every batch, also than a repeated one.
    """
    latest_totals(spark, target).write.mode("overwrite").parquet(f"{compacted}/base=-1")
    return compacted
