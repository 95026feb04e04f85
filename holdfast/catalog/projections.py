"""Projections, filters, scalar functions and joins."""

from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.catalog.base import query
from holdfast.functions import columns as C
from holdfast.operators import quantiles, rates, selection, view360
from holdfast.sources.csv import write_wide_csv
from holdfast.session import scratch_path

_ALL_SOURCE = """select c.*, s.* exclude (customer_id), b.* exclude (customer_id, monthly_charges, total_charges),
    cast(b.monthly_charges as double) monthly_charges, cast(b.total_charges as double) total_charges
    from crm c join services s using (customer_id) join billing b using (customer_id)"""


def _headers(src):
    """The sources as one wide frame under the headers of the customer file."""
    wide = view360.join_sources(src.crm, src.services, src.billing)
    return wide.withColumnsRenamed({v: k for k, v in S.CSV_HEADERS.items()})


@query("rename_columns", _ALL_SOURCE)
def _(src):
    return selection.rename_columns(_headers(src))


@query("split_sources", """select 'crm' source, count(*) as rows, count(distinct customer_id) customers,
        cast(9 as int) width from crm union all
    select 'services', count(*), count(distinct customer_id), 10 from services union all
    select 'billing', count(*), count(distinct customer_id), 11 from billing""")
def _(src):
    parts = selection.split_sources(view360.join_sources(src.crm, src.services, src.billing))
    sized = [
        df.agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"),
            F.countDistinct("customer_id").alias("customers"), F.lit(len(df.columns)).alias("width"),
        )
        for name, df in parts.items()
    ]
    return sized[0].unionByName(sized[1]).unionByName(sized[2])


@query("select_star", "select * from c360")
def _(src):
    return src.view.select("*")


@query("filter_eq", """select customer_id, contract, tenure_segment, internet_service, monthly_charges from c360
    where churn = 'Yes' and contract = 'Month-to-month' and internet_service = 'Fiber optic'""")
def _(src):
    kept = selection.filter_eq(src.view, churn="Yes", contract="Month-to-month", internet_service="Fiber optic")
    return kept.select("customer_id", "contract", "tenure_segment", "internet_service", "monthly_charges")


@query("segment_filter", """select customer_id, contract, tenure_segment, internet_service from c360
    where (contract in ('Month-to-month', 'One year') or contract is null)
        and tenure_segment in ('New', 'Loyal') and internet_service in ('DSL', 'Fiber optic')""")
def _(src):
    kept = selection.segment_filter(
        src.view, ["Month-to-month", "One year", None], ["New", "Loyal"], ["DSL", "Fiber optic"]
    )
    return kept.select("customer_id", "contract", "tenure_segment", "internet_service")


@query("drop_null_reason", "select customer_id, churn_reason from c360 where churn_reason is not null")
def _(src):
    return src.view.select("customer_id", "churn_reason").na.drop(subset=["churn_reason"])


@query("column_guard", "select customer_id, contract, tenure from c360")
def _(src):
    return selection.column_guard(src.view, ["customer_id", "contract", "no_such_column", "tenure"])


@query("head_rows", "select customer_id, contract, monthly_charges, churn from c360 order by customer_id limit 3")
def _(src):
    return selection.head_rows(
        src.view.select("customer_id", "contract", "monthly_charges", "churn"), 3, "customer_id"
    )


@query("label_encode_target",
       "select customer_id, churn, case when churn = 'Yes' then 1 else 0 end churn_label from c360")
def _(src):
    return C.label_target(src.billing.select("customer_id", "churn"))


# --- joins -------------------------------------------------------------------------------------------------------


@query("join_sources", _ALL_SOURCE)
def _(src):
    return view360.join_sources(src.crm, src.services, src.billing)


@query("join_profile", "select customer_id, tenure, monthly_charges, internet_service, churn from c360")
def _(src):
    return view360.join_profile(src.crm, src.services, src.billing)


@query("join_usage", """select customer_id, total_calls, total_sms, total_data_sessions, complaint_count,
    total_call_mins, total_data_mb from c360""")
def _(src):
    return view360.join_usage(src.crm.select("customer_id"), view360.usage_totals(src.cdr))


def known_score(src):
    """A probability that needs no model: the recorded churn score over 100, for customers with a contract."""
    return src.billing.filter(F.col("contract").isNotNull()).select(
        "customer_id", (F.col("churn_score") / F.lit(100.0)).alias("churn_probability")
    )


_SCORED = """, scored as (select c360.*, case when contract is not null then churn_score / 100.0::double end
    churn_probability from c360) """


@query("join_scores", _SCORED + """select customer_id, churn, churn_probability,
    count(*) filter (where churn_probability is null) over () unscored from scored""")
def _(src):
    joined = rates.join_scores(src.view.select("customer_id", "churn"), known_score(src))
    return joined.withColumn("unscored", rates.unscored_count(joined).scalar())


@query("fill_median", """select customer_id, cast(coalesce(total_charges, (select cast(quantile_cont(total_charges, 0.5)
    as decimal(10,2)) from billing)) as double) total_charges from billing""")
def _(src):
    return quantiles.fill_median(src.billing.select("customer_id", "total_charges"), "total_charges")


@query("reindex_segments", """select cast(o as int) ordinal, s tenure_segment, r churn_rate
    from (values (0, 'New'), (1, 'Growing'), (2, 'Loyal'), (3, 'Champion')) d(o, s)
    left join (select tenure_segment, round(avg(case when churn = 'Yes' then 1.0::double else 0 end), 6) r from c360
        where contract = 'Two year' and tenure > 12 group by 1) x on x.tenure_segment = d.s""")
def _(src):
    later = src.view.filter((F.col("contract") == "Two year") & (F.col("tenure") > 12))
    rate = rates.rate_by(later, "tenure_segment").withColumn("churn_rate", F.round("churn_rate", 6))
    return rates.reindex_segments(rate)


# --- scalar functions --------------------------------------------------------------------------------------------


@query("tenure_segment", "select customer_id, tenure, tenure_segment from c360")
def _(src):
    return src.crm.select("customer_id", "tenure", C.tenure_segment().alias("tenure_segment"))


@query("tenure_band", """select customer_id, tenure, case when tenure < 0 then null when tenure < 13 then 0
    when tenure < 37 then 1 when tenure < 61 then 2 when tenure < 73 then 3 end tenure_band from crm""")
def _(src):
    return src.crm.select("customer_id", "tenure", C.tenure_band().alias("tenure_band"))


@query("num_services", "select customer_id, num_services from c360")
def _(src):
    return src.services.select("customer_id", C.num_services().alias("num_services"))


@query("revenue_at_risk_flag", "select customer_id, contract, monthly_charges, revenue_at_risk from c360")
def _(src):
    return src.billing.select("customer_id", "contract", "monthly_charges", C.revenue_at_risk().alias("revenue_at_risk"))


@query("charge_ratio", """select customer_id, round(monthly_charges / (total_charges + 1), 6) ratio from c360""")
def _(src):
    return src.billing.select("customer_id", F.round(C.charge_ratio(), 6).alias("ratio"))


@query("encode_binary", """select customer_id, case when gender = 'Female' then 1 else 0 end gender,
    case when senior_citizen = 'Yes' then 1 else 0 end senior_citizen,
    case when partner = 'Yes' then 1 else 0 end partner, case when dependents = 'Yes' then 1 else 0 end dependents,
    case when phone_service = 'Yes' then 1 else 0 end phone_service,
    case when paperless_billing = 'Yes' then 1 else 0 end paperless_billing from c360""")
def _(src):
    wide = view360.join_sources(src.crm, src.services, src.billing)
    return C.encode_binary(wide.select("customer_id", *S.BINARY_COLUMNS))


@query("coerce_number", """select customer_id, coalesce(cast(total_charges as varchar), ' ') charges_text,
    cast(total_charges as double) charges from billing""")
def _(src):
    text = F.coalesce(F.col("total_charges").cast("string"), F.lit(" "))
    return src.billing.select("customer_id", text.alias("charges_text")).withColumn(
        "charges", C.coerce_number("charges_text")
    )


@query("cast_money", """select o_orderkey, cast(cast(cast(o_totalprice as varchar) as decimal(10,2)) as double) total,
    cast(cast(cast(o_totalprice / 100 as varchar) as decimal(8,2)) as double) scaled from orders""")
def _(src):
    """Doubles to money by their decimal digits, half up."""
    price = F.col("o_totalprice")
    return src.raw("orders").select(
        "o_orderkey", C.cast_money(price, 10).alias("total"), C.cast_money(price / 100, 8).alias("scaled")
    )


@query("map_labels", """select customer_id, case churn when 'Yes' then 'Churned' when 'No' then 'Retained' end outcome,
    case when tenure <= 12 then 'New (0-12m)' when tenure <= 36 then 'Growing (13-36m)'
        when tenure <= 60 then 'Loyal (37-60m)' else 'Champion (61+m)' end band_label from c360""")
def _(src):
    return src.view.select(
        "customer_id", C.churn_label_text(F.col("churn")).alias("outcome"),
        C.band_label_text(C.tenure_band()).alias("band_label"),
    )


@query("expected_calls", """select customer_id, greatest(5, cast(floor(monthly_charges / 6) as int)) expected_calls
    from billing""")
def _(src):
    return src.billing.select("customer_id", C.expected_calls().alias("expected_calls"))


@query("period_start", """select customer_id, timestamp '2020-01-01' + to_days(cast(30 * tenure as int)) period_start,
    timestamp '2020-01-01' + to_days(cast(30 * tenure + tenure % 30 as int)) + to_hours(7 + tenure % 16) event_time
    from crm""")
def _(src):
    base = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    start = C.period_start(base, F.col("tenure"), 30)
    return src.crm.select(
        "customer_id", start.alias("period_start"),
        C.event_time(start, F.col("tenure") % 30, F.col("tenure") % 16 + 7).alias("event_time"),
    )


def csv_copy(src) -> str:
    """The customer file of the given tables, with five further columns that readers ignore."""
    wide = view360.join_sources(src.crm, src.services, src.billing)
    text = wide.withColumn("total_charges", F.coalesce(F.col("total_charges").cast("string"), F.lit(" ")))
    extra = text.withColumns({
        "Count": F.lit(1), "Country": F.lit("United States"), "Lat Long": F.lit("0, 0"),
        "Latitude": F.lit(0.0), "Longitude": F.lit(0.0),
    })
    return write_wide_csv(extra, scratch_path(src.spark, "csv"))
