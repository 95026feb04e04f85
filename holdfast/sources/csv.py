"""Wide customer CSV: read, clean, split into the three source tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import schemas as S
from holdfast.functions.columns import coerce_number
from holdfast.operators.quantiles import fill_median
from holdfast.operators.selection import rename_columns, split_sources

WHOLE_NUMBERS = ("tenure", "churn_value", "churn_score", "cltv")


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, picked by header; headers that are not needed never leave the reader.

    Every file has to have the same columns in the same order: the reader checks each file's header and fails on another
    one, since Spark would take the values by position. A missing column is an error as well.
    """
    columns = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if missing := [c for c in S.CSV_HEADERS if c not in columns]:
        raise ValueError(f"columns missing from {path}: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rename_columns(rows.select(*[F.col(f"`{c}`") for c in columns if c in S.CSV_HEADERS]))


def clean(wide: DataFrame, fill: bool = True) -> DataFrame:
    """Typed columns; unreadable total charges are null and then take the median of all customers."""
    typed = wide.withColumns({
        **{c: coerce_number(c, "int") for c in WHOLE_NUMBERS},
        "monthly_charges": coerce_number("monthly_charges", "decimal(8,2)"),
        "total_charges": coerce_number("total_charges", "decimal(10,2)"),
    })
    return fill_median(typed, "total_charges") if fill else typed


def csv_ingest(spark: SparkSession, path: str, fill: bool = True) -> dict[str, DataFrame]:
    return split_sources(clean(read_wide_csv(spark, path), fill))


def write_wide_csv(df: DataFrame, path: str) -> str:
    """The inverse of the reader's renaming, for exchange and tests."""
    back = {v: k for k, v in S.CSV_HEADERS.items()}
    columns = [F.col(c).cast(T.StringType()).alias(back.get(c, c)) for c in df.columns]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)
    return path
