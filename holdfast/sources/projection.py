"""The four source tables, projected from the given star-schema and event tables.

The SQL is plain enough to mean the same in Spark and in the checking engine, so both sides see the same rows.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from holdfast.operators.view360 import customer_360


def _addon(multiplier: int) -> str:
    return (
        "case when c_custkey % 4 = 0 then 'No internet service' "
        f"when (c_custkey * {multiplier}) % 11 < 5 then 'Yes' else 'No' end"
    )


PROJECTIONS = {
    "crm": """
        select cast(c.c_custkey as varchar(20)) customer_id,
            case when c.c_custkey % 2 = 0 then 'Female' else 'Male' end gender,
            case when c.c_custkey % 7 = 0 then 'Yes' else 'No' end senior_citizen,
            case when c.c_custkey % 3 = 0 then 'Yes' else 'No' end partner,
            case when c.c_custkey % 5 = 0 then 'Yes' else 'No' end dependents,
            cast((c.c_custkey * 31) % 73 as int) tenure, n.n_name city, r.r_name state,
            cast(10000 + c.c_custkey % 90000 as varchar(20)) zip_code
        from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
            join {region} r on n.n_regionkey = r.r_regionkey""",
    "services": f"""
        select cast(c_custkey as varchar(20)) customer_id,
            case when c_custkey % 10 = 0 then 'No' else 'Yes' end phone_service,
            case when c_custkey % 10 = 0 then 'No phone service'
                when (c_custkey * 3) % 8 < 4 then 'Yes' else 'No' end multiple_lines,
            case when c_custkey % 4 = 0 then 'No' when c_custkey % 4 = 1 then 'DSL'
                else 'Fiber optic' end internet_service,
            {_addon(2)} online_security, {_addon(3)} online_backup, {_addon(5)} device_protection,
            {_addon(7)} tech_support, {_addon(9)} streaming_tv, {_addon(10)} streaming_movies
        from {{customer}}""",
    "billing": """
        select cast(c_custkey as varchar(20)) customer_id, contract,
            case when c_custkey % 5 < 3 then 'Yes' else 'No' end paperless_billing,
            case c_custkey % 4 when 0 then 'Electronic check' when 1 then 'Mailed check'
                when 2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end payment_method,
            m monthly_charges, case when t = 0 then null else cast(m * t as decimal(10,2)) end total_charges,
            case when cv = 1 then 'Yes' else 'No' end churn, cv churn_value,
            cast((c_custkey * 17) % 60 + 40 * cv as int) churn_score,
            cast(2000 + (c_custkey * 13) % 4500 as int) cltv,
            case when cv = 1 then concat('Reason ', cast(c_custkey % 13 as varchar(20))) end churn_reason
        from (select b.*, case when c_acctbal < case when contract = 'Month-to-month' then 4000
                when contract = 'One year' then 1000 else 0 end then 1 else 0 end cv
            from (select c_custkey, c_acctbal, (c_custkey * 31) % 73 t,
                    cast(18 + (c_custkey * 37) % 101 as decimal(8,2)) m,
                    case when c_custkey % 97 = 0 then null
                        when c_mktsegment in ('AUTOMOBILE','BUILDING') then 'Two year'
                        when c_mktsegment = 'FURNITURE' then 'One year' else 'Month-to-month' end contract
                from {customer}) b) l""",
    "cdr": """
        select event_id, cast(user_id as varchar(20)) customer_id, ts event_date,
            case event_type when 'view' then 'data' when 'click' then 'call' when 'purchase' then 'call'
                when 'signup' then 'sms' else 'complaint' end event_type,
            cast(case when event_type in ('click','purchase') then value else 0 end as decimal(8,2)) duration_mins,
            cast(case when event_type = 'view' then value else 0 end as decimal(10,2)) data_mb,
            case when event_type not in ('click','purchase') then null when event_id % 20 < 17 then 'local'
                when event_id % 20 < 19 then 'international' else 'roaming' end call_type
        from {events}""",
}

BASE_TABLES = ("customer", "nation", "region", "events")


def projection_text(name: str) -> str:
    """The projection with plain table names, for an engine that has them as views."""
    return PROJECTIONS[name].format(**{t: t for t in BASE_TABLES})


def project(name: str, spark: SparkSession, base: Callable[[str], DataFrame]) -> DataFrame:
    text = PROJECTIONS[name]
    return spark.sql(text, **{t: base(t) for t in BASE_TABLES if "{" + t + "}" in text})


# Footers are read once per session for the given tables, which do not change.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


@dataclass
class SourceTables:
    """Lazy handles on the source tables of one data folder."""

    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {"crm": self.crm, "services": self.services, "billing": self.billing, "cdr": self.cdr}

    @cached_property
    def crm(self) -> DataFrame:
        return project("crm", self.spark, self.raw)

    @cached_property
    def services(self) -> DataFrame:
        return project("services", self.spark, self.raw)

    @cached_property
    def billing(self) -> DataFrame:
        return project("billing", self.spark, self.raw)

    @cached_property
    def cdr(self) -> DataFrame:
        return project("cdr", self.spark, self.raw)

    @cached_property
    def view(self) -> DataFrame:
        return customer_360(self.crm, self.services, self.billing, self.cdr)
