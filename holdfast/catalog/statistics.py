"""Summary, distribution and correlation tables."""

from itertools import combinations

from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.catalog.base import query, rounded
from holdfast.operators import quantiles, stats
from holdfast.operators.view360 import VIEW_COLUMNS


def _each(columns, template):
    return " union all ".join(template.format(c=c) for c in columns)


@query("numeric_summary", _each(S.SUMMARY_COLUMNS, """select '{c}' metric, count({c}) as count,
    round(avg(cast({c} as double)), 6) mean, round(stddev_samp(cast({c} as double)), 6) std,
    round(cast(min({c}) as double), 6) as min, round(quantile_cont(cast({c} as double), 0.25), 6) q1,
    round(quantile_cont(cast({c} as double), 0.5), 6) median, round(quantile_cont(cast({c} as double), 0.75), 6) q3,
    round(cast(max({c}) as double), 6) as max from c360"""))
def _(src):
    return stats.numeric_summary(src.view, decimals=6)


_NULLABLE = [c for c in (*S.CRM_COLUMNS[:-1], *S.SERVICE_COLUMNS[1:], *S.BILLING_COLUMNS[1:],
                         "avg_monthly_call_mins", "avg_monthly_data_mb")]


@query("null_profile", "select * from (" + _each(
    _NULLABLE, "select '{c}' column_name, count(*) - count({c}) nulls from c360") + ") where nulls > 0")
def _(src):
    return stats.null_profile(src.view)


# The types of the view in column order.
_TYPES = (
    ["string"] * 5 + ["int"] + ["string"] * 14 + ["decimal(8,2)", "decimal(10,2)", "string", "int", "int", "int", "string"]
    + ["bigint"] * 4 + ["decimal(18,2)", "decimal(20,2)", "decimal(19,2)", "decimal(21,2)", "string", "int", "int"]
)


@query("schema_profile", "select cast(p as int) as position, c column_name, t data_type, (select count(*) from c360) row_count"
       " from (values " + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(zip(VIEW_COLUMNS, _TYPES))) + ") v(p, c, t)")
def _(src):
    return stats.schema_profile(src.view)


@query("correlation", " union all ".join(
    f"select '{y}' x, '{x}' y, round(corr(cast({x} as double), cast({y} as double)), 6) r from c360"
    for x, y in combinations(S.CORRELATION_COLUMNS, 2)))
def _(src):
    return rounded(stats.correlation(src.view), "r")


@query("histogram", _each(S.DISTRIBUTION_COLUMNS, """select metric, bin, round(low + bin * (high - low) / 10, 6) bin_start,
    round(low + (bin + 1) * (high - low) / 10, 6) bin_end, count(*) as rows
    from (select '{c}' metric, low, high, cast(least(floor((v - low) / (high - low) * 10), 9) as int) bin
        from (select cast({c} as double) v, min(cast({c} as double)) over () low, max(cast({c} as double)) over () high
            from c360) where v is not null)
    group by metric, bin, low, high"""))
def _(src):
    return rounded(stats.histogram(src.view, bins=10), "bin_start", "bin_end")


_SUBSETS = " union all ".join(
    f"select 'all' subset, '{c}' metric, cast({c} as double) v from c360 where {c} is not null union all "
    f"select churn, '{c}', cast({c} as double) from c360 where {c} is not null and churn is not null"
    for c in S.DISTRIBUTION_COLUMNS)


@query("density", f""", weighted as (select subset, metric, v, count(*) n from ({_SUBSETS}) group by all),
    shape as (select subset, metric, count(*) total, min(v) low, max(v) high,
        stddev_samp(v) * power(count(*), -0.2) h from ({_SUBSETS}) group by all),
    grid as (select *, low - 3 * h start, (high - low + 6 * h) / 199 step, unnest(range(200)) point from shape)
    select subset, metric, cast(point as int) point, round(start + point * step, 6) x,
        round(sum(n * exp(-0.5 * power((start + point * step - v) / h, 2))) / (total * h * sqrt(2 * pi())), 9) density
    from grid join weighted using (subset, metric) group by subset, metric, point, start, step, total, h""")
def _(src):
    dense = stats.density(src.view)
    return dense.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


def _box_sql(groups: str, metric: str, internet: str) -> str:
    return f"""select {internet} internet_service, churn, '{metric}' metric, count(*) as count, q1, median, q3,
        min(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) whisker_low,
        max(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) whisker_high,
        count(*) filter (where v not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) outliers
    from (select {groups}, cast({metric} as double) v, quantile_cont(cast({metric} as double), 0.25) over w q1,
            quantile_cont(cast({metric} as double), 0.5) over w median,
            quantile_cont(cast({metric} as double), 0.75) over w q3
        from c360 window w as (partition by {groups}))
    group by {groups}, q1, median, q3"""


@query("box_stats", ", boxes as (" + _box_sql("internet_service, churn", "monthly_charges", "internet_service") + " union all "
       + " union all ".join(_box_sql("churn", m, "'all'") for m in S.USAGE_COLUMNS) + """)
    select internet_service, churn, metric, count, round(q1, 6) q1, round(median, 6) median, round(q3, 6) q3,
    round(whisker_low, 6) whisker_low, round(whisker_high, 6) whisker_high, outliers from boxes""")
def _(src):
    charges = stats.box_stats(src.view, ["monthly_charges"], ("internet_service", "churn"))
    usage = stats.box_stats(src.view, S.USAGE_COLUMNS, ("churn",)).withColumn("internet_service", F.lit("all"))
    return rounded(charges.unionByName(usage), "q1", "median", "q3", "whisker_low", "whisker_high")


@query("median_exact", "select round(quantile_cont(cast(total_charges as double), 0.5), 6) median from billing")
def _(src):
    return rounded(quantiles.median_exact(src.billing, "total_charges"), "median")
