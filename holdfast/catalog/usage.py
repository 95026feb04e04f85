"""Period usage, decline and complaint signals, event ids, streams."""

from datetime import datetime

from pyspark.sql import functions as F

from holdfast.catalog.base import query, rounded
from holdfast.operators import periods
from holdfast.session import scratch_path
from holdfast.streaming import events

BASE = datetime(2024, 1, 1)
DAYS = 3

_PERIODS = f""", periods as (select customer_id,
        cast(floor(date_diff('day', date '2024-01-01', cast(event_date as date)) / {DAYS}) as int) period,
        count(*) filter (where event_type = 'call') calls, count(*) filter (where event_type = 'sms') sms,
        count(*) filter (where event_type = 'data') data_sessions,
        count(*) filter (where event_type = 'complaint') complaints
    from cdr group by all),
marked as (select *, calls + sms + data_sessions + complaints n, max(period) over (partition by customer_id) last
    from periods) """


@query("period_spine", """select customer_id, cast(k as int) period,
    timestamp '2020-01-01' + to_days(cast(30 * k as int)) period_start
    from (select customer_id, unnest(range(greatest(1, tenure))) k from crm)""")
def _(src):
    return periods.period_spine(src.crm, datetime(2020, 1, 1))


@query("usage_by_period", _PERIODS + "select * from periods")
def _(src):
    return periods.usage_by_period(src.cdr, BASE, DAYS)


@query("activity_decline", _PERIODS + """, sums as (select customer_id,
        sum(case when period > last - 2 then n else 0 end) recent, sum(case when period > last - 2 then 0 else n end) earlier,
        max(period) - min(period) + 1 span from marked group by customer_id),
    means as (select customer_id, recent::double / least(span, 2) recent_mean,
        case when span > 2 then earlier::double / (span - 2) end earlier_mean from sums)
    select customer_id, round(recent_mean, 6) recent_mean, round(earlier_mean, 6) earlier_mean,
        round(case when earlier_mean <> 0 then recent_mean / earlier_mean end, 6) ratio,
        case when earlier_mean <> 0 and recent_mean / earlier_mean < 0.5 then 1 else 0 end declining from means""")
def _(src):
    decline = periods.activity_decline(periods.usage_by_period(src.cdr, BASE, DAYS))
    return rounded(decline, "recent_mean", "earlier_mean", "ratio")


_LATE = _PERIODS + """, late as (select customer_id,
    cast(sum(case when period > last - 3 then complaints else 0 end) as bigint) late_complaints
    from marked group by customer_id) """


@query("late_complaints", _LATE + "select * from late")
def _(src):
    return periods.late_complaints(periods.usage_by_period(src.cdr, BASE, DAYS))


@query("late_complaint_rates", _LATE + """select churn, count(*) customers, cast(sum(late_complaints) as bigint) complaints,
    round(avg(late_complaints), 6) complaints_per_customer,
    round(avg(case when late_complaints > 0 then 1.0::double else 0 end), 6) share_complaining
    from late join billing using (customer_id) group by churn""")
def _(src):
    late = periods.late_complaints(periods.usage_by_period(src.cdr, BASE, DAYS))
    return rounded(periods.late_complaint_rates(late, src.billing), "complaints_per_customer", "share_complaining")


@query("calls_vs_expected", _PERIODS + """select customer_id, period, calls,
    greatest(5, cast(floor(monthly_charges / 6) as int)) expected_calls,
    round(calls::double / greatest(5, floor(monthly_charges / 6)), 6) ratio from periods join billing using (customer_id)""")
def _(src):
    return rounded(periods.calls_vs_expected(periods.usage_by_period(src.cdr, BASE, DAYS), src.billing), "ratio")


@query("data_by_internet", """select internet_service, count(*) sessions, round(avg(cast(data_mb as double)), 6) mean_mb,
    round(quantile_cont(cast(data_mb as double), 0.5), 6) median_mb
    from cdr join services using (customer_id) where event_type = 'data' group by internet_service""")
def _(src):
    return rounded(periods.data_by_internet(src.cdr, src.services), "mean_mb", "median_mb")


@query("call_type_mix", """select call_type, count(*) calls, round(count(*) / sum(count(*)) over (), 6) as share
    from cdr where event_type = 'call' and call_type is not null group by call_type""")
def _(src):
    return rounded(periods.call_type_mix(src.cdr), "share")


_CDR = """event_date, event_type, cast(duration_mins as double) duration_mins, cast(data_mb as double) data_mb, call_type"""


@query("event_ids", f"""select row_number() over (order by substring(md5(customer_id), 1, 3), customer_id, event_date,
    event_id) event_id, event_id source_event_id, customer_id, {_CDR} from cdr""")
def _(src):
    return periods.event_ids(src.cdr)


def _sent_twice(src) -> str:
    """The events as two deliveries of the same rows."""
    feed = scratch_path(src.spark, "feed")
    for delivery in ("first", "second"):
        src.cdr.write.parquet(f"{feed}/{delivery}")
    return feed


@query("stream_ingest", f"select event_id, customer_id, {_CDR} from cdr")
def _(src):
    target = scratch_path(src.spark, "stream")
    events.stream_ingest(src.spark, _sent_twice(src), target, scratch_path(src.spark, "stream-state"))
    return events.ingested(src.spark, target)


@query("stream_usage_totals", """select customer_id, total_calls, total_sms, total_data_sessions, complaint_count,
    call_cents::double / 100 total_call_mins, data_cents::double / 100 total_data_mb from usage""")
def _(src):
    feed, target = scratch_path(src.spark, "feed"), scratch_path(src.spark, "totals")
    src.cdr.write.parquet(feed)
    events.stream_usage_totals(src.spark, feed, target, scratch_path(src.spark, "totals-state"))
    return events.latest_totals(src.spark, target)
