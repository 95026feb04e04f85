"""Sources, sinks, tables and views."""

import uuid

from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.catalog.base import query
from holdfast.catalog.projections import _ALL_SOURCE, csv_copy
from holdfast.operators import view360
from holdfast.operators.quality import load_counts
from holdfast.session import scratch_path
from holdfast.sources import csv, warehouse

# Buckets of the customer tables, a choice of the caller; events are not bucketed.
BUCKETS = 8


@query("csv_ingest", _ALL_SOURCE.replace("cast(b.total_charges as double)", """cast(coalesce(b.total_charges,
    (select cast(quantile_cont(total_charges, 0.5) as decimal(10,2)) from billing)) as double)"""))
def _(src):
    parts = csv.csv_ingest(src.spark, csv_copy(src))
    return view360.join_sources(parts["crm"], parts["services"], parts["billing"])


def _databases(src) -> tuple[str, str]:
    """Fresh databases with the four source tables."""
    tag = uuid.uuid4().hex[:8]
    raw, analytics = f"raw_{tag}", f"analytics_{tag}"
    warehouse.create_tables(src.spark, scratch_path(src.spark, "warehouse"), raw, analytics)
    return raw, analytics


@query("create_tables", " union all ".join(
    f"select '{t}' table_name, count(*) as rows, cast({len(s)} as int) width from {t}" for t, s in S.TABLES.items()))
def _(src):
    """Create both databases and the empty tables, load them, report what the catalog then holds."""
    raw, _ = _databases(src)
    for name, df in src.tables.items():
        df.write.insertInto(f"{raw}.{name}", overwrite=True)
    stored = {name: src.spark.table(f"{raw}.{name}") for name in S.TABLES}
    width = F.create_map(*[F.lit(x) for name, df in stored.items() for x in (name, len(df.columns))])
    return load_counts(stored).withColumn("width", F.element_at(width, F.col("table_name")))


@query("table_write", _ALL_SOURCE)
def _(src):
    """Round trip through bucketed tables, which join without a shuffle."""
    raw, _ = _databases(src)
    warehouse.load_sources(src.tables, raw, BUCKETS)
    return view360.join_sources(*[src.spark.table(f"{raw}.{t}") for t in ("crm", "services", "billing")])


@query("table_append", """select event_id, customer_id, event_date, event_type, cast(duration_mins as double) duration_mins,
    cast(data_mb as double) data_mb, call_type, cast(event_date as date) event_day from cdr""")
def _(src):
    path = scratch_path(src.spark, "events")
    calls = F.col("event_type").eqNullSafe("call")
    warehouse.table_append(src.cdr.filter(calls), path)
    warehouse.table_append(src.cdr.filter(~calls), path)
    return src.spark.read.parquet(path)


@query("sql_query", """select contract, count(*) customers, sum(monthly_charges) charges from c360
    where monthly_charges > 70 and internet_service = 'Fiber optic' group by contract""")
def _(src):
    name = f"view_{uuid.uuid4().hex[:8]}"
    src.view.createOrReplaceTempView(name)
    found = warehouse.query(
        src.spark,
        f"select contract, count(*) customers, sum(monthly_charges) charges from {name} "
        "where monthly_charges > :charge and internet_service = :service group by contract",
        charge=70, service="Fiber optic",
    )
    # The plan holds the view's content by now.
    src.spark.catalog.dropTempView(name)
    return found


@query("create_view", "select * from c360")
def _(src):
    raw, analytics = _databases(src)
    warehouse.load_sources(src.tables, raw, BUCKETS)
    return warehouse.create_view(src.spark, f"{analytics}.customer_360", raw)
