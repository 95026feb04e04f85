"""Registration of queries with their checking SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import schemas as S
from holdfast.sources.projection import PROJECTIONS, SourceTables, projection_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SEGMENT = (
    "case "
    + " ".join(f"when c.tenure <= {limit} then '{name}'" for name, limit in S.SEGMENT_LIMITS)
    + f" else '{S.LAST_SEGMENT}' end"
)
_ADDONS = " + ".join(f"cast(coalesce(s.{c} = 'Yes', false) as int)" for c in S.ADDON_COLUMNS)


def _prefixed(alias: str, columns: list[str]) -> str:
    return ", ".join(f"{alias}.{c}" for c in columns)


# Usage sums are kept in hundredths, so that the monthly averages round half up in whole numbers.
CTES = (
    "with "
    + ",\n".join(f"{name} as ({projection_text(name)})" for name in PROJECTIONS)
    + f""",
usage as (
    select customer_id,
        count(*) filter (where event_type = 'call') total_calls,
        count(*) filter (where event_type = 'sms') total_sms,
        count(*) filter (where event_type = 'data') total_data_sessions,
        count(*) filter (where event_type = 'complaint') complaint_count,
        cast(coalesce(sum(duration_mins) filter (where event_type = 'call'), 0) * 100 as bigint) call_cents,
        cast(coalesce(sum(data_mb) filter (where event_type = 'data'), 0) * 100 as bigint) data_cents
    from cdr group by customer_id),
c360 as (
    select {_prefixed('c', [c for c in S.CRM_COLUMNS if c != 'zip_code'])}, {_prefixed('s', S.SERVICE_COLUMNS[1:])},
        b.contract, b.paperless_billing, b.payment_method, cast(b.monthly_charges as double) monthly_charges,
        cast(b.total_charges as double) total_charges, b.churn, b.churn_value, b.churn_score, b.cltv, b.churn_reason,
        coalesce(u.total_calls, 0) total_calls, coalesce(u.total_sms, 0) total_sms,
        coalesce(u.total_data_sessions, 0) total_data_sessions, coalesce(u.complaint_count, 0) complaint_count,
        cast(coalesce(u.call_cents, 0) as double) / 100 total_call_mins,
        cast(coalesce(u.data_cents, 0) as double) / 100 total_data_mb,
        case when c.tenure > 0 then cast((2 * coalesce(u.call_cents, 0) + c.tenure) // (2 * c.tenure) as double) / 100 end
            avg_monthly_call_mins,
        case when c.tenure > 0 then cast((2 * coalesce(u.data_cents, 0) + c.tenure) // (2 * c.tenure) as double) / 100 end
            avg_monthly_data_mb,
        {_SEGMENT} tenure_segment, {_ADDONS} num_services,
        cast(coalesce(b.contract = '{S.MONTH_TO_MONTH}' and b.monthly_charges > {S.RISK_CHARGE}, false) as int)
            revenue_at_risk
    from crm c join services s using (customer_id) join billing b using (customer_id)
        left join usage u using (customer_id)),
filled as (
    select c360.* replace (coalesce(total_charges, (select cast(cast(quantile_cont(total_charges, 0.5)
        as decimal(10,2)) as double) from billing)) as total_charges) from c360),
model as (
    select *, monthly_charges / (total_charges + 1) charge_per_month_ratio,
        cast(coalesce(churn = 'Yes', false) as int) as label from filled),
split_rows as (
    select *, case when row_number() over (partition by label order by md5(customer_id || '|42'), customer_id)
        <= floor(count(*) over (partition by label) * 0.2 + 0.5) then 'test' else 'train' end split from model)
"""
)


def query(name: str, sql: str | None = None):
    """Register a function of the source tables; ``sql`` continues the shared CTEs, or stands alone as ``select``."""

    def register(fn: Callable[[SourceTables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(SourceTables(spark, str(folder))))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            ORACLES[name] = CTES + (text if text.startswith(",") else " " + text)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one numeric type both engines agree on."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})
