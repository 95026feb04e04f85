"""Usage over fixed-length periods: spine, counts, decline and complaint signals."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators.quantiles import exact_quantiles, long_values
from holdfast.operators.skew import split_heavy_join
from holdfast.session import store

PERIOD_DAYS = 30
ROWS_PER_PART = 2_000_000
KINDS = {"calls": "call", "sms": "sms", "data_sessions": "data", "complaints": "complaint"}
EVENTS = "calls + sms + data_sessions + complaints"


def _base(base: datetime) -> Column:
    return F.lit(base.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def period_spine(customers: DataFrame, base: datetime, period_days: int = PERIOD_DAYS) -> DataFrame:
    """One row per customer and period of membership, at least one, with the start of the period."""
    periods = F.sequence(F.lit(0), F.greatest(F.lit(1), F.coalesce(F.col("tenure"), F.lit(0))) - 1)
    spine = customers.select("customer_id", F.explode(periods).alias("period"))
    return spine.withColumn("period_start", C.period_start(_base(base), F.col("period"), period_days))


def usage_by_period(cdr: DataFrame, base: datetime, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Events of each type per customer and period."""
    days = F.datediff(F.col("event_date").cast("date"), _base(base).cast("date"))
    period = F.floor(days / F.lit(period_days)).cast("int")
    counts = [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in KINDS.items()]
    return cdr.groupBy("customer_id", period.alias("period")).agg(*counts)


def _recent(usage: DataFrame, periods: int) -> DataFrame:
    """Mark the last periods of each customer. A customer has at most one row per period here."""
    last = F.max("period").over(W.partitionBy("customer_id"))
    return usage.withColumn("recent", F.col("period") > last - periods)


def activity_decline(usage: DataFrame, recent_periods: int = 2, threshold: float = 0.5) -> DataFrame:
    """Mean events in the last periods over the mean before them, per customer, flagged below the threshold.

    Periods between a customer's first and last that have no events count as zero.
    """
    marked = _recent(usage, recent_periods).withColumn("events", F.expr(EVENTS))
    sums = marked.groupBy("customer_id").agg(
        F.sum(F.when(F.col("recent"), F.col("events")).otherwise(0)).alias("recent_events"),
        F.sum(F.when(~F.col("recent"), F.col("events")).otherwise(0)).alias("earlier_events"),
        (F.max("period") - F.min("period") + 1).alias("span"),
    )
    recent_span = F.least(F.col("span"), F.lit(recent_periods))
    recent_mean = F.col("recent_events").cast("double") / recent_span
    earlier_mean = F.try_divide(F.col("earlier_events").cast("double"), F.col("span") - recent_span)
    ratio = F.try_divide(F.col("recent_mean"), F.col("earlier_mean"))
    return sums.select(
        "customer_id", recent_mean.alias("recent_mean"), earlier_mean.alias("earlier_mean")
    ).withColumns({"ratio": ratio}).withColumn(
        "declining", F.when(F.col("ratio") < threshold, 1).otherwise(0)
    )


def late_complaints(usage: DataFrame, recent_periods: int = 3) -> DataFrame:
    """Complaints in the last periods of each customer."""
    marked = _recent(usage, recent_periods)
    return marked.groupBy("customer_id").agg(
        F.sum(F.when(F.col("recent"), F.col("complaints")).otherwise(0)).alias("late_complaints")
    )


def late_complaint_rates(late: DataFrame, billing: DataFrame) -> DataFrame:
    """Customers with events, their late complaints and the share who complained, per churn value."""
    joined = late.join(billing.select("customer_id", "churn"), "customer_id")
    return joined.filter(F.col("churn").isNotNull()).groupBy("churn").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("late_complaints").alias("complaints"),
        C.mean_exact(F.col("late_complaints")).alias("complaints_per_customer"),
        F.avg(F.when(F.col("late_complaints") > 0, 1.0).otherwise(0.0)).alias("share_complaining"),
    )


def calls_vs_expected(usage: DataFrame, billing: DataFrame) -> DataFrame:
    """Calls per period over the calls expected for the customer's charge level."""
    expected = billing.select("customer_id", C.expected_calls().alias("expected_calls"))
    joined = usage.select("customer_id", "period", "calls").join(expected, "customer_id")
    return joined.withColumn("ratio", F.try_divide(F.col("calls").cast("double"), F.col("expected_calls")))


def data_by_internet(cdr: DataFrame, services: DataFrame) -> DataFrame:
    """Data sessions, mean and median megabytes per internet service."""
    sessions = cdr.filter(F.col("event_type") == "data").select("customer_id", "data_mb")
    lookup = services.select("customer_id", "internet_service").filter(F.col("internet_service").isNotNull())
    joined = split_heavy_join(sessions, lookup, "customer_id")
    held = store(joined.select("internet_service", "data_mb"), "sessions")
    groups = ("internet_service",)
    medians = exact_quantiles(held, ["data_mb"], {"median_mb": 0.5}, groups, long=long_values(held, ["data_mb"], groups))
    totals = held.groupBy("internet_service").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.try_divide(F.sum("data_mb").cast("double"), F.count("data_mb")).alias("mean_mb"),
    )
    return totals.join(medians.drop("metric"), "internet_service", "left")


def call_type_mix(cdr: DataFrame) -> DataFrame:
    calls = cdr.filter((F.col("event_type") == "call") & F.col("call_type").isNotNull())
    counts = calls.groupBy("call_type").agg(F.count(F.lit(1)).alias("calls"))
    everything = F.sum("calls").over(W.partitionBy())
    return counts.withColumn("share", F.col("calls") / everything.cast("double"))


def event_ids(cdr: DataFrame, digits: int = 3, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Dense ids 1..n: customers in order of their key's hash, events of a customer in time order.

    One range sort of the rows, written once. The order runs on through event time, event id and the row's place in the
    input, so a customer with a third of all rows, or many events of one instant, is cut into as many ranges as any others.
    """
    parts = -(-cdr.count() // rows_per_part) or 1
    customer = F.coalesce("customer_id", F.lit(""))
    keyed = cdr.withColumns({
        "_bucket": F.substring(F.md5(customer), 1, digits), "_customer": customer, "_place": F.monotonically_increasing_id(),
    })
    order = ["_bucket", "_customer", "event_date", "event_id", "_place"]
    # The id's upper bits are the number of the range, the lower 33 bits the place inside it.
    sorted_rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_bucket", "_customer", "_place")
    placed = store(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "event-order").withColumn(
        "_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per range.
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_at").bitwiseAND(F.lit(2**33 - 1)) + 1).alias("event_id"),
        F.col("event_id").alias("source_event_id"),
        *[c for c in cdr.columns if c != "event_id"],
    )
