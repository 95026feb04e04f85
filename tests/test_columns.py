"""Scalar expressions on edge values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.functions import columns as C


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.fixture
def tenures(spark):
    rows = [(t,) for t in (0, 12, 13, 36, 37, 60, 61, 72, 73, None, -1)]
    return spark.createDataFrame(rows, "tenure int").coalesce(1)


def test_segment_boundaries(tenures):
    assert values(tenures, C.tenure_segment()) == [
        "New", "New", "Growing", "Growing", "Loyal", "Loyal", "Champion", "Champion", "Champion", "Champion", "New",
    ]


def test_band_is_null_outside_its_range(tenures):
    assert values(tenures, C.tenure_band()) == [0, 0, 1, 1, 2, 2, 3, 3, None, None, None]


def test_band_violations(tenures):
    from holdfast.operators.quality import band_violations

    assert band_violations(tenures).first()[0] == 3


def test_risk_flag_needs_more_than_seventy(spark):
    rows = [("Month-to-month", Decimal("70.00")), ("Month-to-month", Decimal("70.01")), ("One year", Decimal("90")),
            (None, Decimal("90")), ("Month-to-month", None)]
    df = spark.createDataFrame(rows, "contract string, monthly_charges decimal(8,2)").coalesce(1)
    assert values(df, C.revenue_at_risk()) == [0, 1, 0, 0, 0]


def test_addons_count_only_yes(spark):
    df = spark.createDataFrame(
        [("Yes", "Yes", None, "No", "No internet service", "Yes")],
        "online_security string, online_backup string, device_protection string, tech_support string, "
        "streaming_tv string, streaming_movies string",
    )
    assert values(df, C.num_services()) == [3]


def test_monthly_average_rounds_half_up_and_skips_zero_tenure(spark):
    rows = [(Decimal("2.01"), 2), (Decimal("5.00"), 0), (Decimal("0.00"), 3)]
    df = spark.createDataFrame(rows, "total decimal(18,2), tenure int").coalesce(1)
    assert values(df, C.monthly_average(F.col("total"), F.col("tenure"))) == [Decimal("1.01"), None, Decimal("0.00")]


def test_blank_and_wrong_numbers_become_null(spark):
    df = spark.createDataFrame([(" ",), ("",), ("n/a",), ("12.345",), (None,), (" 7 ",)], "t string").coalesce(1)
    assert values(df, C.coerce_number("t")) == [None, None, None, Decimal("12.35"), None, Decimal("7.00")]


def test_charge_ratio(spark):
    df = spark.createDataFrame([(Decimal("50"), Decimal("99"))], "monthly_charges decimal(8,2), total_charges decimal(10,2)")
    assert values(df, C.charge_ratio()) == [0.5]


def test_binary_encoding_counts_null_as_zero_and_skips_absent_columns(spark):
    df = spark.createDataFrame([("Female", "Yes"), ("Male", None)], "gender string, partner string").coalesce(1)
    assert [tuple(r) for r in C.encode_binary(df).collect()] == [(1, 1), (0, 0)]


def test_safe_rate_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0)], "a double, b double").coalesce(1)
    assert values(df, C.safe_rate(F.col("a"), F.col("b"))) == [0.25, 0.0]


def test_formats(spark):
    df = spark.createDataFrame([(12345, 0.2567, Decimal("70.5"))], "n bigint, r double, m decimal(8,2)")
    row = df.select(
        C.as_count(F.col("n")), C.as_percent(F.col("r")), C.as_dollars(F.col("n")), C.as_dollars(F.col("m"), 2)
    ).first()
    assert tuple(row) == ("12,345", "25.7%", "$12,345", "$70.50")


def test_labels(spark):
    df = spark.createDataFrame([("total_call_mins", "Yes", 3)], "m string, c string, b int")
    row = df.select(C.title_label(F.col("m")), C.churn_label_text(F.col("c")), C.band_label_text(F.col("b"))).first()
    assert tuple(row) == ("Total Call Mins", "Churned", "Champion (61+m)")
