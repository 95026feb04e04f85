"""Key, reference and rule checks over the source tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schemas as S


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with the number of copies."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def pk_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: key values in use more than once and the rows too many."""
    parts = [
        duplicate_keys(df, S.TABLE_KEYS[name]).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys of the child that the parent lacks, with their row counts.

    The child is reduced to its distinct keys first, so a key with very many rows is one row in the join.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(key), key, "left_anti")


def fk_orphans(tables: dict[str, DataFrame], parent: str = "crm") -> DataFrame:
    parts = [
        orphan_keys(df, tables[parent]).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
        )
        for name, df in tables.items()
        if name != parent
    ]
    return reduce(DataFrame.unionByName, parts)


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def cdr_rules() -> dict[str, Column]:
    kind, minutes, megabytes = F.col("event_type"), F.col("duration_mins"), F.col("data_mb")
    is_call = kind.eqNullSafe("call")
    return {
        "missing_event_type": kind.isNull(),
        "non_call_with_call_type": ~is_call & F.col("call_type").isNotNull(),
        "non_call_with_minutes": ~is_call & (minutes != 0),
        "call_without_call_type": is_call & F.col("call_type").isNull(),
        "call_below_half_minute": is_call & (minutes < 0.5),
        "non_data_with_megabytes": ~kind.eqNullSafe("data") & (megabytes != 0),
        "call_outside_hours": is_call & ~F.hour("event_date").between(7, 22),
    }


def cdr_rule_checks(cdr: DataFrame) -> DataFrame:
    """Violations per rule, all rules in one pass."""
    rules = cdr_rules()
    counts = cdr.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def band_violations(df: DataFrame, tenure: str = "tenure") -> DataFrame:
    """Customers whose tenure fits no band."""
    fits = F.coalesce(F.col(tenure).between(0, S.LAST_BAND_LIMIT), F.lit(False))
    return df.agg(F.count_if(~fits).alias("violations"))
