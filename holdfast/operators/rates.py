"""Churn rates, KPI rows, roll-ups and top-k lists."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.functions import columns as C
from holdfast.operators.selection import value_domain


def rate_by(df: DataFrame, key: str) -> DataFrame:
    """Share of churned customers per value of the key; customers without a key are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(C.share_churned().alias("churn_rate"))


def sort_rates(rates: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """Order a rate table, nulls last either way, ties by key."""
    rate = F.col("churn_rate")
    return rates.orderBy(rate.desc_nulls_last() if descending else rate.asc_nulls_last(), key)


def rank_rates(rates: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """The same order as a column. Runs on the aggregated table, one row per key value."""
    rate = F.col("churn_rate")
    order = W.orderBy(rate.desc_nulls_last() if descending else rate.asc_nulls_last(), key)
    return rates.withColumn("position", F.row_number().over(order))


def reindex_segments(aggregated: DataFrame) -> DataFrame:
    """All four segments in their fixed order; a segment without customers has null measures."""
    domain = value_domain(aggregated.sparkSession, "tenure_segment", S.SEGMENTS)
    return domain.join(aggregated, "tenure_segment", "left").orderBy("ordinal")


def segment_counts(df: DataFrame) -> DataFrame:
    return reindex_segments(df.groupBy("tenure_segment").agg(F.count(F.lit(1)).alias("customers")))


def rate_by_band(df: DataFrame) -> DataFrame:
    banded = df.withColumn("tenure_band", C.tenure_band())
    return rate_by(banded, "tenure_band").withColumn("band_label", C.band_label_text(F.col("tenure_band")))


def churn_counts(df: DataFrame) -> DataFrame:
    counts = df.filter(F.col("churn").isNotNull()).groupBy("churn").agg(F.count(F.lit(1)).alias("customers"))
    everything = F.sum("customers").over(W.partitionBy())
    return counts.withColumn("share", F.col("customers") / everything.cast("double"))


def churn_rate(df: DataFrame) -> DataFrame:
    return df.agg(C.share_churned().alias("churn_rate"))


def revenue_at_risk_total(df: DataFrame) -> DataFrame:
    lost = F.sum(F.when(F.col("churn") == "Yes", F.col("monthly_charges")))
    return df.agg(F.coalesce(lost, F.lit(0)).alias("revenue_at_risk"))


def segment_rollup(df: DataFrame) -> DataFrame:
    """Rate and size by contract, by tenure segment and by internet service from a single scan."""
    keys = ["contract", "tenure_segment", "internet_service"]
    sets = df.groupingSets([[F.col(k)] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("customers"),
        C.share_churned().alias("churn_rate"),
        *[F.grouping(k).alias(f"_{k}") for k in keys],
    )
    dimension = F.coalesce(*[F.when(F.col(f"_{k}") == 0, F.lit(k)) for k in keys])
    value = F.coalesce(*keys)
    return sets.select(dimension.alias("dimension"), value.alias("value"), "customers", "churn_rate").filter(
        F.col("value").isNotNull()
    )


def kpi_row(df: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    lost = F.count_if(F.col("churn") == "Yes")
    return df.agg(
        total.alias("total_customers"),
        lost.alias("churned_customers"),
        C.safe_rate(lost.cast("double"), total.cast("double")).alias("churn_rate"),
        F.coalesce(F.sum(F.when(F.col("churn") == "Yes", F.col("monthly_charges"))), F.lit(0)).alias("revenue_at_risk"),
        C.mean_exact(F.col("cltv")).alias("avg_cltv"),
        F.count_if(F.col("complaint_count") > 0).alias("high_complaints"),
    )


def format_kpi(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        C.as_count(F.col("total_customers")).alias("total_customers"),
        C.as_count(F.col("churned_customers")).alias("churned_customers"),
        C.as_percent(F.col("churn_rate")).alias("churn_rate"),
        C.as_dollars(F.col("revenue_at_risk")).alias("revenue_at_risk"),
        C.as_dollars(F.col("avg_cltv")).alias("avg_cltv"),
    )


def insight_row(df: DataFrame) -> DataFrame:
    def rate(name: str, value: str):
        return F.avg(F.when(F.col(name) == value, C.churned()))

    def complaints(value: str):
        return C.mean_exact(F.when(F.col("churn") == value, F.col("complaint_count")))

    return df.agg(
        C.share_churned().alias("churn_rate"),
        rate("contract", S.MONTH_TO_MONTH).alias("month_to_month_rate"),
        rate("tenure_segment", S.SEGMENTS[0]).alias("new_customer_rate"),
        rate("internet_service", "Fiber optic").alias("fiber_rate"),
        complaints("Yes").alias("complaints_churned"),
        complaints("No").alias("complaints_retained"),
        F.coalesce(F.sum(F.when(F.col("churn") == "Yes", F.col("monthly_charges"))), F.lit(0)).alias("revenue_at_risk"),
    )


def usage_by_churn(df: DataFrame, metrics: list[str] | None = None, decimals: int = 1) -> DataFrame:
    """Mean usage per churn value."""
    means = [F.round(C.mean_exact(F.col(m)), decimals).alias(m) for m in metrics or S.USAGE_COLUMNS]
    return df.filter(F.col("churn").isNotNull()).groupBy("churn").agg(*means)


def usage_by_churn_transposed(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """One row per metric with a column per outcome; an outcome without customers is null."""
    metrics = metrics or ["total_calls", "total_data_mb", "complaint_count"]
    means = usage_by_churn(df, metrics, decimals=10)
    long = means.unpivot("churn", metrics, "metric", "mean")
    wide = long.groupBy("metric").pivot("churn", ["No", "Yes"]).agg(F.first("mean"))
    return wide.withColumnsRenamed({"No": "Retained", "Yes": "Churned"})


def top_reasons(df: DataFrame, n: int = 10) -> DataFrame:
    counts = (
        df.filter((F.col("churn") == "Yes") & F.col("churn_reason").isNotNull())
        .groupBy("churn_reason")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return counts.orderBy(F.desc("customers"), "churn_reason").limit(n)


def join_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach probabilities by customer; customers that were not scored keep a null."""
    return df.join(scores.select("customer_id", "churn_probability"), "customer_id", "left")


def unscored_count(joined: DataFrame) -> DataFrame:
    return joined.agg(F.count_if(F.col("churn_probability").isNull()).alias("unscored"))


HIGH_RISK_COLUMNS = [
    "customer_id", "contract", "internet_service", "monthly_charges", "tenure", "num_services", "complaint_count",
    "churn_probability",
]


def high_risk_customers(scored: DataFrame, n: int = 20, formatted: bool = True) -> DataFrame:
    """Retained customers with the highest probability to leave."""
    order = [F.desc_nulls_last("churn_probability"), F.asc("customer_id")]
    top = scored.filter(F.col("churn") == "No").select(*HIGH_RISK_COLUMNS).orderBy(*order).limit(n)
    if not formatted:
        return top
    return top.withColumns({
        "monthly_charges": C.as_dollars(F.col("monthly_charges"), 2),
        "churn_probability": C.as_percent(F.col("churn_probability")),
    })


def riskiest_customer(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.desc_nulls_last("churn_probability"), F.asc("customer_id")).limit(1)
