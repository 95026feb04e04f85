"""CSV intake, tables and views, and the plans they give."""

import csv

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.operators import rates, view360
from holdfast.sources import csv as wide_csv
from holdfast.sources import warehouse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blank_charges_take_the_median_and_extra_columns_are_ignored(spark, tmp_path):
    headers = ["Count", *S.CSV_HEADERS, "Lat Long"]
    base = {h: "Yes" for h in headers} | {
        "Tenure Months": "5", "Monthly Charges": "20.5", "Churn Value": "1", "Churn Score": "50", "CLTV": "2000",
        "Zip Code": "00501",
    }
    path = tmp_path / "customers.csv"
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, headers)
        writer.writeheader()
        for i, total in enumerate(["10", " ", "30", "50"]):
            writer.writerow(base | {"CustomerID": f"c{i}", "Total Charges": total})
    parts = wide_csv.csv_ingest(spark, str(path))
    assert {n: df.columns for n, df in parts.items()} == {
        "crm": S.CRM_COLUMNS, "services": S.SERVICE_COLUMNS, "billing": S.BILLING_COLUMNS}
    for name, df in parts.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in S.TABLES[name]]
    assert {r["customer_id"]: float(r["total_charges"]) for r in parts["billing"].collect()} == {
        "c0": 10, "c1": 30, "c2": 30, "c3": 50}
    assert parts["crm"].first()["zip_code"] == "00501"


@pytest.fixture(scope="module")
def raw(spark, src, tmp_path_factory):
    warehouse.create_tables(spark, str(tmp_path_factory.mktemp("tables")), "raw_t", "analytics_t")
    warehouse.create_tables(spark, "ignored", "raw_t", "analytics_t")
    warehouse.load_sources(src.tables, "raw_t", buckets=4)
    return "raw_t"


def test_schemas_of_the_projection(src):
    for name, schema in S.TABLES.items():
        assert {(f.name, f.dataType) for f in src.tables[name].schema} == {(f.name, f.dataType) for f in schema}
    assert src.view.columns == view360.VIEW_COLUMNS and len(view360.VIEW_COLUMNS) == 38


def test_bucketed_tables_join_without_a_shuffle(spark, raw):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = view360.join_sources(*[spark.table(f"{raw}.{t}") for t in ("crm", "services", "billing")])
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_overwrite_replaces(spark, src, raw):
    warehouse.table_write(src.crm.limit(3), f"{raw}.copy")
    warehouse.table_write(src.crm, f"{raw}.copy")
    assert spark.table(f"{raw}.copy").count() == 150


def test_view_and_parameters(spark, raw):
    view = warehouse.create_view(spark, "customers_t", raw)
    again = warehouse.create_view(spark, "customers_t", raw)
    assert view.count() == again.count() == 150
    row = warehouse.query(spark, "select count(*) n from customers_t where churn = :churn", churn="Yes").first()
    assert row["n"] == view.filter("churn = 'Yes'").count()
    assert warehouse.query(spark, "select 1 as one").first()["one"] == 1


def test_view_is_kept_by_the_catalog(spark, raw):
    view = warehouse.create_view(spark, f"{raw}.wide", raw)
    plain = view360.customer_360(*[spark.table(f"{raw}.{t}") for t in ("crm", "services", "billing", "cdr")])
    assert view.dtypes == plain.dtypes
    assert view.exceptAll(plain).count() == plain.exceptAll(view).count() == 0
    # A temporary view would be unknown to another session.
    assert spark.newSession().table(f"{raw}.wide").count() == 150


def test_events_are_partitioned_by_day(spark, src, tmp_path):
    path = str(tmp_path / "events")
    warehouse.table_append(src.cdr, path)
    warehouse.table_append(src.cdr, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * src.cdr.count()
    assert "PartitionFilters: [isnotnull(event_day" in plan_of(stored.filter("event_day = date'2024-01-05'"))


def test_rates_do_not_read_the_events(src):
    plan = plan_of(rates.rate_by(src.view, "contract"))
    assert "events.parquet" not in plan and "customer.parquet" in plan
    assert "events.parquet" in plan_of(rates.usage_by_churn(src.view))


def test_filters_and_columns_reach_the_scan(spark, raw):
    view = warehouse.create_view(spark, "customers_p", raw)
    plan = plan_of(view.filter("contract = 'One year'").groupBy("contract").count())
    assert "EqualTo(contract,One year)" in plan
    assert "payment_method" not in plan


def test_events_are_reduced_before_the_join(src):
    plan = plan_of(src.view)
    assert plan.index("Join") < plan.index("partial_")


def test_queries_on_the_data_path_use_no_python(spark):
    import __spark_entry__ as entry

    for name in ("customer_360", "kpi_row", "segment_rollup", "activity_decline", "stratified_split", "event_ids"):
        plan = plan_of(entry.queries()[name](spark, SMALL))
        assert "Python" not in plan and "Pandas" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_files_with_another_column_order_or_without_a_column_are_refused(spark, tmp_path):
    from holdfast import schemas as S
    from holdfast.sources.csv import read_wide_csv

    names = list(S.CSV_HEADERS)
    for folder, second in (("same", names), ("swapped", [names[1], names[0], *names[2:]])):
        (tmp_path / folder).mkdir()
        for i, header in enumerate((names, second)):
            (tmp_path / folder / f"{i}.csv").write_text(",".join(header) + "\n" + ",".join(header) + "\n")
    row = read_wide_csv(spark, str(tmp_path / "same")).collect()[1]
    assert row["gender"] == next(k for k, v in S.CSV_HEADERS.items() if v == "gender")
    with pytest.raises(Exception, match="header"):
        read_wide_csv(spark, str(tmp_path / "swapped")).collect()
    (tmp_path / "short.csv").write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match="missing"):
        read_wide_csv(spark, str(tmp_path / "short.csv"))


def test_a_failed_write_leaves_the_old_rows(spark, src, tmp_path):
    raw, analytics = "raw_staged", "analytics_staged"
    warehouse.create_tables(spark, str(tmp_path), raw, analytics)
    table = f"{raw}.crm"
    warehouse.table_write(src.crm.limit(5), table)
    before = sorted(map(str, spark.table(table).collect()))
    assert len(before) == 5
    # A failure in the middle: some tasks have written their rows when one fails.
    broken = src.crm.repartition(8).withColumn("tenure", F.when(
        F.spark_partition_id() == 7, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("tenure")))
    with pytest.raises(Exception, match="lost"):
        warehouse.table_write(broken, table)
    assert sorted(map(str, spark.table(table).collect())) == before
    for wrong in (src.crm.withColumn("tenure", F.col("tenure").cast("string")), src.crm.drop("city"),
                  src.crm.withColumn("more", F.lit(1)), src.crm.withColumn("tenure", F.col("tenure").cast("bigint"))):
        with pytest.raises(ValueError):
            warehouse.table_write(wrong, table)
    assert sorted(map(str, spark.table(table).collect())) == before
    assert {t.name for t in spark.catalog.listTables(raw)} == set(S.TABLES)
    # Other order and a narrower type are put right; another layout keeps the declared columns.
    shuffled = src.crm.select(*reversed(src.crm.columns)).withColumn("tenure", F.col("tenure").cast("smallint"))
    for buckets in (0, 4, 4, 0):
        warehouse.table_write(shuffled, table, buckets)
        assert spark.table(table).schema == spark.createDataFrame([], S.TABLES["crm"]).schema
        assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, src.crm.select(spark.table(table).columns).collect()))
    spark.sql(f"drop database {raw} cascade")
