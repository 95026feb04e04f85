"""Filters, projections and small row-set operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.session import small_table


def filter_eq(df: DataFrame, **wanted: object) -> DataFrame:
    for name, value in wanted.items():
        df = df.filter(F.col(name) == value)
    return df


def _member(name: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    test = F.col(name).isin(known) if known else F.lit(False)
    return test | F.col(name).isNull() if None in values else test


def segment_filter(
    df: DataFrame,
    contracts: list | None = None,
    segments: list | None = None,
    internet: list | None = None,
) -> DataFrame:
    """Three value lists, all of which must match. No list means no restriction; ``None`` in a list matches null."""
    for name, values in (("contract", contracts), ("tenure_segment", segments), ("internet_service", internet)):
        if values is not None:
            df = df.filter(_member(name, values))
    return df


def column_guard(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def head_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.CSV_HEADERS)


def split_sources(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "crm": df.select(*S.CRM_COLUMNS),
        "services": df.select(*S.SERVICE_COLUMNS),
        "billing": df.select(*S.BILLING_COLUMNS),
    }


def distinct_options(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def value_domain(spark: SparkSession, name: str, values: list) -> DataFrame:
    """A fixed list of values with their positions."""
    kind = "int" if values and isinstance(values[0], int) else "string"
    columns = {"ordinal": list(range(len(values))), name: values}
    return small_table(spark, columns, f"ordinal int, {name} {kind}")
