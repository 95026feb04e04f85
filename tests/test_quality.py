"""Violations are found on rows that have them."""

from datetime import datetime
from decimal import Decimal

from holdfast.operators import periods, quality


def test_duplicates_and_orphans(spark):
    crm = spark.createDataFrame([("a",), ("b",), ("b",)], "customer_id string")
    other = spark.createDataFrame([("a",)], "customer_id string")
    cdr = spark.createDataFrame([(1, "a"), (2, "x"), (3, "x"), (3, None)], "event_id bigint, customer_id string")
    tables = {"crm": crm, "services": other, "billing": other, "cdr": cdr}
    assert {tuple(r) for r in quality.pk_duplicates(tables).collect()} == {
        ("crm", 1, 1), ("services", 0, 0), ("billing", 0, 0), ("cdr", 1, 1)}
    assert {tuple(r) for r in quality.fk_orphans(tables).collect()} == {
        ("services", 0, 0), ("billing", 0, 0), ("cdr", 1, 2)}
    assert [tuple(r) for r in quality.duplicate_keys(crm, "customer_id").collect()] == [("b", 2)]


def test_rules(spark):
    at = datetime(2024, 1, 1, 12)
    night = datetime(2024, 1, 1, 3)
    rows = [
        ("call", at, Decimal("1"), Decimal("0"), "local"),
        ("call", night, Decimal("0.4"), Decimal("3"), None),
        ("sms", night, Decimal("2"), Decimal("0"), "local"),
        ("data", at, Decimal("0"), Decimal("9"), None),
        (None, at, Decimal("0"), Decimal("0"), "local"),
    ]
    cdr = spark.createDataFrame(
        rows, "event_type string, event_date timestamp, duration_mins decimal(8,2), data_mb decimal(10,2), call_type string")
    assert {r["rule"]: r["violations"] for r in quality.cdr_rule_checks(cdr).collect()} == {
        "missing_event_type": 1, "non_call_with_call_type": 2, "non_call_with_minutes": 1, "call_without_call_type": 1,
        "call_below_half_minute": 1, "non_data_with_megabytes": 1, "call_outside_hours": 1}


def test_decline_counts_quiet_periods(spark):
    rows = [("a", p, n) for p, n in ((0, 10), (1, 10), (4, 2), (5, 2))] + [("b", 3, 4)]
    usage = spark.createDataFrame(rows, "customer_id string, period int, calls bigint").selectExpr(
        "*", "0L as sms", "0L as data_sessions", "0L as complaints")
    got = {r["customer_id"]: r for r in periods.activity_decline(usage).collect()}
    assert (got["a"]["recent_mean"], got["a"]["earlier_mean"], got["a"]["ratio"], got["a"]["declining"]) == (2.0, 5.0, 0.4, 1)
    assert (got["b"]["recent_mean"], got["b"]["earlier_mean"], got["b"]["ratio"], got["b"]["declining"]) == (4.0, None, None, 0)


def test_spine_has_at_least_one_period(spark):
    crm = spark.createDataFrame([("a", 0), ("b", 3), ("c", None)], "customer_id string, tenure int")
    rows = periods.period_spine(crm, datetime(2020, 1, 1)).collect()
    assert sorted((r["customer_id"], r["period"]) for r in rows) == [("a", 0), ("b", 0), ("b", 1), ("b", 2), ("c", 0)]
    assert {r["period_start"] for r in rows if r["period"] == 2} == {datetime(2020, 3, 1)}
