"""Databases, tables, views and parameterised SQL."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import schemas as S
from holdfast.operators import view360 as V


def query(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """Run SQL text; ``:name`` markers take their values from the keyword arguments."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def create_tables(spark: SparkSession, root: str, raw: str = "raw", analytics: str = "analytics") -> None:
    """Both databases and the four empty source tables; existing ones are left as they are."""
    for database in (raw, analytics):
        spark.sql(f"create database if not exists {database} location '{root}/{database}'")
    for name, schema in S.TABLES.items():
        if not spark.catalog.tableExists(f"{raw}.{name}"):
            spark.catalog.createTable(f"{raw}.{name}", source="parquet", schema=schema)


def declared(df: DataFrame, table: str) -> DataFrame:
    """The rows with the columns, order and types that an existing table declares.

    A missing, an additional or a doubled column is an error, and so is a type that does not widen to the declared one.
    """
    schema = df.sparkSession.table(table).schema
    if sorted(df.columns) != sorted(schema.names):
        raise ValueError(f"{table} has the columns {schema.names}, not {df.columns}")
    for field in schema:
        own = df.schema[field.name].dataType
        if own != field.dataType and not _widens(own, field.dataType):
            raise ValueError(f"{table}.{field.name} is {field.dataType.simpleString()}, not {own.simpleString()}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def _widens(own: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(own, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return own.scale <= wanted.scale and own.precision - own.scale <= wanted.precision - wanted.scale
    for widths in ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.NullType, type(wanted))):
        if type(own) in widths and type(wanted) in widths:
            return widths.index(type(own)) <= widths.index(type(wanted))
    return False


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {table}").collect()}


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_write(df: DataFrame, table: str, buckets: int = 0, key: str = "customer_id") -> None:
    """Replace the contents of a table; one that exists keeps its declared schema.

    The rows are written to a folder of their own beside the table. Only when all are there the table is switched to that
    folder and the old one is deleted, so a write that fails leaves the old rows. With ``buckets`` the rows are stored
    hashed and sorted by the key: tables with the same number of buckets then join without a shuffle.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        df = declared(df, table)
    database, name = table.split(".") if "." in table else (spark.catalog.currentDatabase(), table)
    number = uuid.uuid4().hex
    folder = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}-{number}"
    staged = f"{database}.{name}_{number}"
    layout = f"clustered by ({key}) sorted by ({key}) into {buckets} buckets" if buckets else ""
    # One task per bucket, so one file per bucket.
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key) if buckets else df.write
    # A table with a path keeps its files when its entry is dropped.
    try:
        writer.format("parquet").option("path", folder).saveAsTable(staged)
    except Exception:
        _delete(spark, folder)
        raise
    finally:
        spark.sql(f"drop table if exists {staged}")
    old = _described(spark, table) if exists else {}
    if exists and int(old.get("Num Buckets", 0)) == buckets:
        spark.sql(f"alter table {table} set location '{folder}'")
    else:
        # Another layout is another definition of the table.
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"drop table if exists {table}")
        spark.sql(f"create table {table} ({columns}) using parquet {layout} location '{folder}'")
    spark.catalog.refreshTable(table)
    if "Location" in old:
        _delete(spark, old["Location"])


def load_sources(tables: dict[str, DataFrame], raw: str = "raw", buckets: int = 0) -> None:
    for name, df in tables.items():
        # Keys are unique, so buckets are even. Nothing joins events by their id: they are written as they are read.
        table_write(df, f"{raw}.{name}", 0 if name == "cdr" else buckets, S.TABLE_KEYS[name])


def with_event_day(cdr: DataFrame) -> DataFrame:
    return cdr.withColumn("event_day", F.to_date("event_date"))


def table_append(cdr: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Append events, one folder per event day.

    The rows are rebalanced by day first: adaptive execution joins small days into one task and splits a large day over
    many, by measured size.
    """
    spread = with_event_day(cdr).hint("rebalance", F.col("event_day"))
    spread.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("event_day").parquet(path)


def _view_text(raw: str) -> str:
    """The wide view as SQL, which a catalog can keep; column for column as ``view360.customer_360``."""
    counts = [f"count_if(event_type = '{kind}') as {name}" for name, kind in V.COUNTS.items()]
    sums = [f"coalesce(sum(case when event_type = '{kind}' then {measure} end), 0) as {name}"
            for name, (kind, measure) in V.SUMS.items()]
    zeros = ", ".join(f"coalesce({c}, 0) as {c}" for c in (*V.COUNTS, *V.SUMS))
    own = ", ".join([*[c for c in S.CRM_COLUMNS if c != "zip_code"], *S.SERVICE_COLUMNS[1:], *S.BILLING_COLUMNS[1:]])
    segment = " ".join(f"when tenure <= {limit} then '{name}'" for name, limit in S.SEGMENT_LIMITS)
    addons = " + ".join(f"if({c} = 'Yes', 1, 0)" for c in S.ADDON_COLUMNS)
    return f"""
        with totals as (select customer_id, {', '.join([*counts, *sums])} from {raw}.cdr group by customer_id),
        wide as (select {own}, {zeros}
            from {raw}.crm join {raw}.services using (customer_id) join {raw}.billing using (customer_id)
            left join totals using (customer_id))
        select *, round(total_call_mins / nullif(tenure, 0), 2) as avg_monthly_call_mins,
            round(total_data_mb / nullif(tenure, 0), 2) as avg_monthly_data_mb,
            case {segment} else '{S.LAST_SEGMENT}' end as tenure_segment, {addons} as num_services,
            if(contract = '{S.MONTH_TO_MONTH}' and monthly_charges > {S.RISK_CHARGE}, 1, 0) as revenue_at_risk
        from wide"""


def create_view(spark: SparkSession, name: str = "analytics.customer_360", raw: str = "raw") -> DataFrame:
    """(Re)place the wide view over the source tables in the catalog, which keeps it as long as its tables, and return it."""
    spark.sql(f"create or replace view {name} as {_view_text(raw)}")
    return spark.table(name)
