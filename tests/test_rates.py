"""Rates, filters and roll-ups on literal rows."""

from decimal import Decimal

import pytest

from holdfast.operators import rates, selection

SCHEMA = (
    "customer_id string, contract string, tenure_segment string, internet_service string, churn string, "
    "monthly_charges decimal(8,2), cltv int, complaint_count bigint, total_calls bigint, total_data_mb decimal(12,2), "
    "churn_reason string, tenure int, num_services int"
)


@pytest.fixture
def view(spark):
    rows = [
        ("a", "One year", "New", "DSL", "Yes", Decimal("10"), 100, 1, 4, Decimal("1"), "price", 1, 0),
        ("b", "One year", "New", "DSL", "No", Decimal("20"), 200, 0, 6, Decimal("3"), None, 2, 0),
        ("c", None, "Loyal", "No", None, Decimal("30"), 300, 0, 8, Decimal("5"), None, 40, 1),
        ("d", "Two year", "Loyal", None, "Yes", Decimal("40"), 400, 2, 2, Decimal("7"), "price", 50, 2),
        ("e", "Two year", "Loyal", "DSL", "Yes", Decimal("50"), 500, 0, 2, Decimal("9"), "network", 60, 2),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_null_keys_have_no_rate_and_null_churn_counts_as_retained(view):
    assert {r[0]: r[1] for r in rates.rate_by(view, "contract").collect()} == {"One year": 0.5, "Two year": 1.0}
    assert rates.churn_rate(view).first()[0] == 0.6
    assert {r[0]: r[1] for r in rates.rate_by(view, "tenure_segment").collect()} == {"New": 0.5, "Loyal": 2 / 3}


def test_filter_matches_null_only_when_listed(view):
    def ids(df):
        return sorted(r["customer_id"] for r in df.collect())

    assert ids(selection.segment_filter(view)) == list("abcde")
    assert ids(selection.segment_filter(view, contracts=["One year", None])) == list("abc")
    assert ids(selection.segment_filter(view, contracts=["One year"])) == list("ab")
    assert ids(selection.segment_filter(view, contracts=[None])) == ["c"]
    assert ids(selection.segment_filter(view, contracts=[])) == []


def test_nulls_sort_last_both_ways(spark):
    table = spark.createDataFrame([("x", None), ("y", 0.1), ("z", 0.9)], "k string, churn_rate double")
    assert [r["k"] for r in rates.sort_rates(table, "k").collect()] == ["z", "y", "x"]
    assert [r["k"] for r in rates.sort_rates(table, "k", descending=False).collect()] == ["y", "z", "x"]


def test_segments_without_customers_stay(view):
    rows = rates.reindex_segments(rates.rate_by(view, "tenure_segment")).collect()
    assert [(r["tenure_segment"], r["churn_rate"]) for r in rows] == [
        ("New", 0.5), ("Growing", None), ("Loyal", 2 / 3), ("Champion", None),
    ]


def test_kpis_of_no_customers(view):
    row = rates.kpi_row(view.filter("customer_id = 'none'")).first()
    assert (row["total_customers"], row["churn_rate"], row["revenue_at_risk"], row["avg_cltv"]) == (0, 0.0, 0, None)


def test_kpis(view):
    row = rates.kpi_row(view).first()
    assert (row["total_customers"], row["churned_customers"], row["revenue_at_risk"], row["avg_cltv"],
            row["high_complaints"]) == (5, 3, Decimal("100.00"), 300.0, 2)


def test_rollup_equals_single_rates(view):
    rolled = {(r["dimension"], r["value"]): (r["customers"], r["churn_rate"]) for r in rates.segment_rollup(view).collect()}
    assert rolled == {
        ("contract", "One year"): (2, 0.5), ("contract", "Two year"): (2, 1.0),
        ("tenure_segment", "New"): (2, 0.5), ("tenure_segment", "Loyal"): (3, 2 / 3),
        ("internet_service", "DSL"): (3, 2 / 3), ("internet_service", "No"): (1, 0.0),
    }


def test_absent_outcome_is_null_in_the_transposed_table(view):
    rows = rates.usage_by_churn_transposed(view.filter("churn = 'Yes'")).collect()
    assert {r["metric"]: (r["Retained"], r["Churned"]) for r in rows}["complaint_count"] == (None, 1.0)


def test_reasons_break_ties_by_name(view):
    assert [tuple(r) for r in rates.top_reasons(view, 5).collect()] == [("price", 2), ("network", 1)]
    assert rates.top_reasons(view, 1).count() == 1


def test_scores_join_by_customer(spark, view):
    scores = spark.createDataFrame([("b", 0.25), ("a", 0.75)], "customer_id string, churn_probability double")
    joined = rates.join_scores(view, scores)
    assert rates.unscored_count(joined).first()[0] == 3
    assert rates.riskiest_customer(joined).first()["customer_id"] == "a"
    top = rates.high_risk_customers(joined).collect()
    assert [(r["customer_id"], r["churn_probability"], r["monthly_charges"]) for r in top] == [("b", "25.0%", "$20.00")]
