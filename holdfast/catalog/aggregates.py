"""View, rates, KPI rows, roll-ups, top-k lists and quality checks."""

from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.catalog.base import query, rounded
from holdfast.catalog.projections import _SCORED, known_score
from holdfast.functions import columns as C
from holdfast.operators import quality, rates, selection, view360

_RATE = "round(avg(case when churn = 'Yes' then 1.0::double else 0 end), 6)"


def _rate_sql(key: str) -> str:
    return f"select {key}, {_RATE} churn_rate from c360 where {key} is not null group by {key}"


def _rate(df, key):
    return rounded(rates.rate_by(df, key), "churn_rate")


@query("usage_counts", "select customer_id, total_calls, total_sms, total_data_sessions, complaint_count from usage")
def _(src):
    return view360.usage_counts(src.cdr)


@query("usage_sums", """select customer_id, call_cents::double / 100 total_call_mins, data_cents::double / 100
    total_data_mb from usage""")
def _(src):
    return view360.usage_sums(src.cdr)


@query("usage_monthly_avg", """select customer_id, tenure, avg_monthly_call_mins, avg_monthly_data_mb,
    round(total_call_mins / nullif(tenure, 0), 6) exact_call_mins,
    round(total_data_mb / nullif(tenure, 0), 6) exact_data_mb from c360""")
def _(src):
    """Monthly averages as the view rounds them, and unrounded."""
    months = F.nullif(F.col("tenure"), F.lit(0))
    exact = [
        F.round(F.col(c).cast("double") / months, 6).alias(n)
        for c, n in (("total_call_mins", "exact_call_mins"), ("total_data_mb", "exact_data_mb"))
    ]
    return src.view.select("customer_id", "tenure", "avg_monthly_call_mins", "avg_monthly_data_mb", *exact)


@query("customer_360", "select * from c360")
def _(src):
    return src.view


@query("churn_counts", """select churn, count(*) customers, round(count(*) / sum(count(*)) over (), 6) as share
    from c360 group by churn""")
def _(src):
    return rounded(rates.churn_counts(src.view), "share")


@query("churn_rate", f"select {_RATE} churn_rate from c360")
def _(src):
    return rounded(rates.churn_rate(src.view), "churn_rate")


@query("revenue_at_risk_total",
       "select coalesce(sum(monthly_charges) filter (where churn = 'Yes'), 0) revenue_at_risk from c360")
def _(src):
    return rates.revenue_at_risk_total(src.view)


@query("rate_by_contract", _rate_sql("contract"))
def _(src):
    return _rate(src.view, "contract")


@query("rate_by_internet", _rate_sql("internet_service"))
def _(src):
    return _rate(src.view, "internet_service")


_SEGMENT_DOMAIN = "(values (0, 'New'), (1, 'Growing'), (2, 'Loyal'), (3, 'Champion')) d(o, s)"


@query("rate_by_segment", f"""select cast(o as int) ordinal, s tenure_segment, r churn_rate from {_SEGMENT_DOMAIN}
    left join (select tenure_segment, {_RATE} r from c360 group by 1) x on x.tenure_segment = d.s""")
def _(src):
    return rates.reindex_segments(_rate(src.view, "tenure_segment"))


@query("segment_counts", f"""select cast(o as int) ordinal, s tenure_segment, n customers from {_SEGMENT_DOMAIN}
    left join (select tenure_segment, count(*) n from c360 group by 1) x on x.tenure_segment = d.s""")
def _(src):
    return rates.segment_counts(src.view)


@query("rate_by_num_services", _rate_sql("num_services"))
def _(src):
    return _rate(src.view, "num_services")


@query("rate_by_tenure_band", f"""select case when tenure <= 12 then 0 when tenure <= 36 then 1 when tenure <= 60 then 2
    else 3 end tenure_band, {_RATE} churn_rate, case when tenure <= 12 then 'New (0-12m)'
    when tenure <= 36 then 'Growing (13-36m)' when tenure <= 60 then 'Loyal (37-60m)' else 'Champion (61+m)' end band_label
    from c360 group by 1, 3""")
def _(src):
    return rounded(rates.rate_by_band(src.view), "churn_rate")


@query("rate_by_risk_flag", _rate_sql("revenue_at_risk"))
def _(src):
    return _rate(src.view, "revenue_at_risk")


@query("segment_rollup", " union all ".join(
    f"select '{k}' dimension, {k} as value, count(*) customers, {_RATE} churn_rate from c360 where {k} is not null group by {k}"
    for k in ("contract", "tenure_segment", "internet_service")))
def _(src):
    return rounded(rates.segment_rollup(src.view), "churn_rate")


def _mean_sql(metrics):
    return ", ".join(f"round(avg(cast({m} as double)), 6) {m}" for m in metrics)


@query("usage_by_churn", f"select churn, {_mean_sql(S.USAGE_COLUMNS)} from c360 group by churn")
def _(src):
    return rates.usage_by_churn(src.view, decimals=6)


@query("usage_by_churn_transposed", " union all ".join(
    f"""select '{m}' metric, round(avg(cast({m} as double)) filter (where churn = 'No'), 6) "Retained",
    round(avg(cast({m} as double)) filter (where churn = 'Yes'), 6) "Churned" from c360"""
    for m in ("total_calls", "total_data_mb", "complaint_count")))
def _(src):
    return rounded(rates.usage_by_churn_transposed(src.view), "Retained", "Churned")


@query("kpi_row", f"""select count(*) total_customers, count(*) filter (where churn = 'Yes') churned_customers,
    {_RATE} churn_rate, sum(monthly_charges) filter (where churn = 'Yes') revenue_at_risk,
    round(avg(cltv), 6) avg_cltv, count(*) filter (where complaint_count > 0) high_complaints from c360
    where (contract in ('Month-to-month', 'One year') or contract is null) and tenure_segment in ('New', 'Growing')""")
def _(src):
    shown = selection.segment_filter(src.view, ["Month-to-month", "One year", None], ["New", "Growing"])
    return rounded(rates.kpi_row(shown), "churn_rate", "avg_cltv")


@query("format_kpi", """select format('{:,}', count(*)) total_customers,
    format('{:,}', count(*) filter (where churn = 'Yes')) churned_customers,
    printf('%.1f%%', 100 * avg(case when churn = 'Yes' then 1.0::double else 0 end)) churn_rate,
    '$' || format('{:,}', cast(sum(monthly_charges) filter (where churn = 'Yes') as bigint)) revenue_at_risk,
    '$' || format('{:,}', cast(round_even(avg(cltv), 0) as bigint)) avg_cltv from c360""")
def _(src):
    """Display strings; whole dollars round half to even."""
    return rates.format_kpi(rates.kpi_row(src.view))


def _rate_where(test: str) -> str:
    return f"round(avg(case when churn = 'Yes' then 1.0::double else 0 end) filter (where {test}), 6)"


@query("insight_row", f"""select {_RATE} churn_rate,
    {_rate_where("contract = 'Month-to-month'")} month_to_month_rate,
    {_rate_where("tenure_segment = 'New'")} new_customer_rate,
    {_rate_where("internet_service = 'Fiber optic'")} fiber_rate,
    round(avg(complaint_count) filter (where churn = 'Yes'), 6) complaints_churned,
    round(avg(complaint_count) filter (where churn = 'No'), 6) complaints_retained,
    sum(monthly_charges) filter (where churn = 'Yes') revenue_at_risk from c360""")
def _(src):
    measures = ["churn_rate", "month_to_month_rate", "new_customer_rate", "fiber_rate", "complaints_churned",
                "complaints_retained"]
    return rounded(rates.insight_row(src.view), *measures)


@query("distinct_options", "select distinct contract from c360")
def _(src):
    return selection.distinct_options(src.view, "contract")


@query("sort_rates", f"""select contract, churn_rate,
    cast(row_number() over (order by churn_rate desc nulls last, contract) as int) as position
    from ({_rate_sql('contract')})""")
def _(src):
    """The ordered rate table with its position as a column."""
    return rates.sort_rates(rates.rank_rates(_rate(src.view, "contract"), "contract"), "contract")


_REASONS = """select churn_reason, count(*) customers from c360 where churn = 'Yes' and churn_reason is not null
    group by 1 order by customers desc, churn_reason"""


@query("top_reasons", _REASONS + " limit 10")
def _(src):
    return rates.top_reasons(src.view, 10)


@query("top_reasons_filtered", _REASONS.replace("where", "where internet_service = 'Fiber optic' and") + " limit 8")
def _(src):
    """The dashboard's shorter list over a filtered view."""
    return rates.top_reasons(selection.segment_filter(src.view, internet=["Fiber optic"]), 8)


_RISK_COLUMNS = "customer_id, contract, internet_service, {charges} monthly_charges, tenure, num_services, complaint_count"


@query("high_risk_customers", _SCORED + "select " + _RISK_COLUMNS.format(charges="'$' || printf('%.2f', monthly_charges)")
       + """, printf('%.1f%%', churn_probability * 100) churn_probability from
    (select * from scored where churn = 'No' order by churn_probability desc nulls last, customer_id limit 20)""")
def _(src):
    return rates.high_risk_customers(rates.join_scores(src.view, known_score(src)))


@query("riskiest_customer", _SCORED + """select customer_id, churn, churn_probability from scored
    order by churn_probability desc nulls last, customer_id limit 1""")
def _(src):
    scored = rates.join_scores(src.view, known_score(src))
    return rates.riskiest_customer(scored.select("customer_id", "churn", "churn_probability"))


@query("title_labels", "select distinct metric, label from (" + " union all ".join(
    f"select '{m}' metric, '{m.replace('_', ' ').title()}' as label, avg({m}) from c360" for m in S.USAGE_COLUMNS) + ")")
def _(src):
    """Display names of the usage metrics that the view holds."""
    means = rates.usage_by_churn(src.view).unpivot("churn", S.USAGE_COLUMNS, "metric", "mean")
    return means.select("metric", C.title_label(F.col("metric")).alias("label")).distinct()


# --- quality -----------------------------------------------------------------------------------------------------


@query("pk_duplicates", " union all ".join(
    f"""select '{t}' table_name, count(*) duplicate_keys, cast(coalesce(sum(n - 1), 0) as bigint) extra_rows
    from (select count(*) n from {t} group by {k} having count(*) > 1)""" for t, k in S.TABLE_KEYS.items()))
def _(src):
    return quality.pk_duplicates(src.tables)


@query("fk_orphans", " union all ".join(
    f"""select '{t}' table_name, count(distinct customer_id) orphan_keys, count(*) orphan_rows
    from {t} where customer_id not in (select customer_id from crm)""" for t in ("services", "billing", "cdr")))
def _(src):
    return quality.fk_orphans(src.tables)


@query("load_counts", " union all ".join(
    f"select '{t}' table_name, count(*) as rows from {t}" for t in S.TABLES))
def _(src):
    return quality.load_counts(src.tables)


@query("cdr_rule_checks", """select 'missing_event_type' as rule, count(*) violations from cdr
        where event_type is null union all
    select 'non_call_with_call_type', count(*) from cdr
        where event_type is distinct from 'call' and call_type is not null union all
    select 'non_call_with_minutes', count(*) from cdr where event_type is distinct from 'call' and duration_mins <> 0 union all
    select 'call_without_call_type', count(*) from cdr where event_type = 'call' and call_type is null union all
    select 'call_below_half_minute', count(*) from cdr where event_type = 'call' and duration_mins < 0.5 union all
    select 'non_data_with_megabytes', count(*) from cdr where event_type is distinct from 'data' and data_mb <> 0 union all
    select 'call_outside_hours', count(*) from cdr where event_type = 'call' and hour(event_date) not between 7 and 22""")
def _(src):
    return quality.cdr_rule_checks(src.cdr)


@query("band_violations", "select count(*) violations from crm where tenure is null or tenure < 0 or tenure > 72")
def _(src):
    return quality.band_violations(src.crm)
