"""Random sharding by a two-pass external shuffle.

First pass: each record goes to one of as many buckets as keep a bucket small enough for a task's memory, by a seeded hash
of its row. Second pass: each bucket is put in order, shuffled (Fisher-Yates, the built-in shuffle of arrays with a seed)
and dealt out. The buckets laid end to end are one random order of all records; shards are equal runs of it, so their
numbers of rows differ by one at most. A task works on a run of neighbouring buckets, one after another, and so holds a
run of that order: it writes its rows to the one or few shards they belong to, without another shuffle. Only built-in
functions are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import store, wide_parallelism

SEED = 20
#: Bytes of records that are shuffled in one task's memory.
BUCKET_BYTES = 8 << 20
#: Neighbouring buckets that one task works on, where there are enough for all tasks.
TASK_BUCKETS = 16
#: Fixed part of a record's size.
RECORD_BYTES = 16
#: Buckets whose counts are added up in one group.
GROUP = 1000


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def bucket_starts(scattered: DataFrame) -> DataFrame:
    """bucket and the number of rows in the buckets before it; sums of groups of buckets first, then inside each group."""
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("group", F.expr(f"bucket div {GROUP}"))
    groups = counts.groupBy("group").agg(F.sum("n").alias("all"))
    before = groups.select(
        "group", (F.sum("all").over(Window.orderBy("group")) - F.col("all")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("group").orderBy("bucket")) - F.col("n")
    return counts.withColumn("inside", inside).join(before, "group").select(
        "bucket", (F.col("before") + F.col("inside")).alias("start"))


def shuffled(rows: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Rows (with doc_id, text_crc32 and size) and `position`, their place in one random order from 0; their number."""
    columns = rows.columns
    # The row's place in its input partition keeps copies apart. Counts and rows have to agree on it, so what was scattered
    # is stored.
    key = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scattered = rows.withColumn("_key", key).withColumn(
        "bucket", F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(buckets)))
    stored = store(scattered, "scattered")
    run = max(1, min(TASK_BUCKETS, buckets // wide_parallelism(rows.sparkSession)))
    record = F.struct("_key", *columns)
    # The starts travel with the records, as rows without one, so they need no join.
    records = stored.select("bucket", record.alias("record"), F.lit(None).cast("long").alias("start"))
    empty = F.lit(None).cast(records.schema["record"].dataType).alias("record")
    both = records.union(bucket_starts(stored).select("bucket", empty, "start")).withColumn(
        "task", F.expr(f"cast(bucket div {run} as int)"))
    held = both.repartitionById(-(-buckets // run), F.col("task")).groupBy("task", "bucket").agg(
        F.array_sort(F.collect_list("record")).alias("held"), F.max("start").alias("start"))
    dealt = held.select("start", F.posexplode(F.shuffle("held", F.lit(seed))).alias("at", "row"))
    return dealt.select(
        *[F.col("row")[c].alias(c) for c in columns], (F.col("start") + F.col("at")).alias("position")), stored.count()


def shards(
    docs: DataFrame, number: int = 40, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, keep: list[str] | None = None,
) -> DataFrame:
    """The rows (columns `keep`, else all) with size, text_crc32, shard (0 to number - 1) and slot (from 0, without gaps).

    The law is `rows`: the shards' numbers of rows differ by one at most; with fewer rows than shards some stay empty. size
    is the UTF-8 bytes of the text, none for null, plus 16; text_crc32 is null for a null text. Copies of a row are
    spread like any rows. Null keys are rows like any other. The order depends on the seed and on how the input is split.
    """
    keep = docs.columns if keep is None else keep
    # Named anew, so that no column of the input is in the way.
    own = {c: f"_in{i}" for i, c in enumerate(keep)}
    rows = docs.select(*[F.col(c).alias(name) for c, name in own.items()], "doc_id",
                       record_size(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"))
    rows, total = shuffled(rows, seed, bucket_bytes)
    shard = F.expr(f"((position + 1) * {number} - 1) div {max(total, 1)}").cast("int")
    first = F.expr(f"(shard * {max(total, 1)}) div {number}")
    return rows.withColumn("shard", shard).withColumn("slot", (F.col("position") - first).cast("long")).select(
        *[F.col(name).alias(c) for c, name in own.items()], "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, number: int = 40, **options) -> None:
    """Write each shard to a folder of its own: its files in the order of their names hold its rows in that of their slots.

    Rows are written by the tasks that shuffled them, so a shard may be larger than any task.
    """
    shards(docs, number, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
