"""Column expressions: segments, flags, safe arithmetic, casts and labels."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schemas as S


def flag(name: str, value: str = "Yes") -> Column:
    """1 where the column equals the value, otherwise 0; null counts as 0."""
    return F.when(F.col(name) == value, 1).otherwise(0)


def churned(name: str = "churn") -> Column:
    return flag(name).cast("double")


def share_churned(name: str = "churn") -> Column:
    """Churned rows over all rows; rows without a churn value count as retained. Null when there are no rows."""
    return F.try_divide(F.sum(flag(name)).cast("double"), F.count(F.lit(1)))


def mean_exact(value: Column) -> Column:
    """Sum in the column's own (exact) type, then one floating division."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def tenure_segment(tenure: str = "tenure") -> Column:
    months = F.col(tenure)
    chain = reduce(
        lambda branch, limit: branch.when(months <= limit[1], limit[0]),
        S.SEGMENT_LIMITS[1:],
        F.when(months <= S.SEGMENT_LIMITS[0][1], S.SEGMENT_LIMITS[0][0]),
    )
    return chain.otherwise(S.LAST_SEGMENT)


def tenure_band(tenure: str = "tenure") -> Column:
    """Ordinal 0..3, closed on the right; null outside 0..72 months."""
    months = F.col(tenure)
    limits = [limit for _, limit in S.SEGMENT_LIMITS] + [S.LAST_BAND_LIMIT]
    above = reduce(add, [F.when(months > limit, 1).otherwise(0) for limit in limits[:-1]])
    return F.when(months.between(0, limits[-1]), above)


def num_services() -> Column:
    return reduce(add, [flag(c) for c in S.ADDON_COLUMNS])


def revenue_at_risk() -> Column:
    at_risk = (F.col("contract") == S.MONTH_TO_MONTH) & (F.col("monthly_charges") > S.RISK_CHARGE)
    return F.when(at_risk, 1).otherwise(0)


def charge_ratio() -> Column:
    return F.col("monthly_charges").cast("double") / (F.col("total_charges").cast("double") + F.lit(1.0))


def monthly_average(total: Column, tenure: Column) -> Column:
    """Total over months of tenure, two decimals; null for a tenure of zero."""
    return F.round(total / F.nullif(tenure, F.lit(0)), 2)


def safe_rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def coerce_number(text: str, sql_type: str = "decimal(10,2)") -> Column:
    """Text to number; blank or non-numeric text becomes null instead of failing."""
    return F.expr(f"try_cast(trim(`{text}`) as {sql_type})")


def cast_money(value: Column, precision: int = 8) -> Column:
    return value.cast(f"decimal({precision},2)")


def encode_binary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace two-valued text columns by 0/1; columns that are absent are skipped."""
    present = [c for c in (columns or S.BINARY_COLUMNS) if c in df.columns]
    return df.withColumns({c: flag(c, "Female" if c == "gender" else "Yes") for c in present})


def label_target(df: DataFrame) -> DataFrame:
    return df.withColumn("churn_label", flag("churn"))


def title_label(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def churn_label_text(churn: Column) -> Column:
    return F.when(churn == "Yes", "Churned").when(churn == "No", "Retained")


def band_label_text(band: Column) -> Column:
    return F.get(F.array(*[F.lit(text) for text in S.BAND_LABELS]), band)


def as_percent(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate * 100)


def as_count(value: Column) -> Column:
    return F.format_number(value, 0)


def as_dollars(value: Column, decimals: int = 0) -> Column:
    """Whole dollars with thousands separators, or plain dollars and cents."""
    if decimals == 0:
        return F.concat(F.lit("$"), F.format_number(value, 0))
    return F.concat(F.lit("$"), F.format_string(f"%.{decimals}f", value.cast("double")))


def expected_calls(monthly_charges: str = "monthly_charges") -> Column:
    """Calls a customer of this charge level normally makes in one period."""
    return F.greatest(F.lit(5), (F.col(monthly_charges) / 6).cast("int"))


def period_start(base: Column, index: Column, days: int) -> Column:
    return F.timestamp_add("DAY", index * days, base)


def event_time(start: Column, days: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, F.timestamp_add("DAY", days, start))
