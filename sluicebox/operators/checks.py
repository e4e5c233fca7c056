"""Data-quality checks. Each gives the violating rows; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.catalog import GOOD_STATUSES
from sluicebox.functions.geo import SOURCE, SWAPPED, inconsistent
from sluicebox.functions.text import sql_trim


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def unique_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs are equal to each other."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Unexpected values with their counts; NULL is left to ``not_null``."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def coverage(
    df: DataFrame, whole: Column, part: Column, floor: float, names: tuple[str, str] = ("whole_rows", "part_rows")
) -> DataFrame:
    """One row if fewer than ``floor`` of the ``whole`` rows are ``part`` rows. With no such rows it passes."""
    n_whole, n_part = names
    counted = df.agg(F.count_if(whole).alias(n_whole), F.count_if(part).alias(n_part))
    return counted.withColumn("ratio", F.try_divide(F.col(n_part).cast("double"), F.col(n_whole))).filter(
        F.col("ratio") < floor
    )


def coverages(df: DataFrame, rules: Mapping[str, tuple[Column, Column, float]]) -> DataFrame:
    """One row for each of the named ``(whole, part, floor)`` rules that fails, all from one reading."""
    counted = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(whole).alias("whole_rows"),
            F.count_if(part).alias("part_rows"),
            F.lit(floor).alias("floor"),
        )
        for name, (whole, part, floor) in rules.items()
    ]
    each = df.agg(F.array(*counted).alias("each")).select(F.inline("each"))
    ratio = F.try_divide(F.col("part_rows").cast("double"), F.col("whole_rows"))
    return each.withColumn("ratio", ratio).filter(F.col("ratio") < F.col("floor")).drop("floor")


def source_parts(lat: str = "lat", lon: str = "lon") -> tuple[Column, Column]:
    """Rows with a published coordinate pair, and rows that show it."""
    return F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.col("geo_source").isin(SOURCE, SWAPPED)


def lookup_parts(address: str = "address") -> tuple[Column, Column]:
    """Rows with an address, and those of them with a coordinate."""
    addressed = F.nullif(sql_trim(F.col(address)), F.lit("")).isNotNull()
    return addressed, addressed & F.col("geo_lat").isNotNull()


def source_coverage(df: DataFrame, floor: float = 0.95, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Published coordinate pairs that made it onto the map."""
    return coverage(df, *source_parts(lat, lon), floor, ("source_rows", "adopted_rows"))


def lookup_coverage(df: DataFrame, floor: float = 0.90, address: str = "address") -> DataFrame:
    """Rows with an address that have a coordinate."""
    return coverage(df, *lookup_parts(address), floor, ("address_rows", "located_rows"))


def geo_consistency(df: DataFrame, **names: str) -> DataFrame:
    return df.filter(inconsistent(**names))


def every_file_ingested(log: DataFrame) -> DataFrame:
    return log.filter(~F.col("status").isin(*GOOD_STATUSES)).select(
        "schema_name", "dataset_id", "dataset_title", "status", "reason", "row_count"
    )


def none_unresolved(log: DataFrame, column: str = "unresolved_months") -> DataFrame:
    return log.filter(F.size(column) > 0)


def not_empty(df: DataFrame) -> DataFrame:
    """One row if the table has none."""
    return df.agg(F.count("*").alias("n")).filter(F.col("n") == 0)


def component_sum(
    df: DataFrame, by: Sequence[str], kind: str, value: str, parts: Sequence[str], total: str
) -> DataFrame:
    """Groups in which the parts do not add up to the stated total."""
    amount = F.col(value)
    sums = df.groupBy(*by).agg(
        F.sum(F.when(F.col(kind).isin(*parts), amount)).alias("parts_sum"),
        F.sum(F.when(F.col(kind) == total, amount)).alias("stated_total"),
    )
    return sums.filter(F.col("parts_sum") != F.col("stated_total"))


def cross_total(left: DataFrame, right: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Groups whose totals differ between two tables, or that only one of them has."""
    a = left.groupBy(*on).agg(F.sum(value).alias("left_total"))
    b = right.groupBy(*on).agg(F.sum(value).alias("right_total"))
    return a.join(b, list(on), "full").filter(~F.col("left_total").eqNullSafe(F.col("right_total")))


def period_gaps(df: DataFrame, month: str) -> DataFrame:
    """Months inside the covered span that have no rows."""
    present = df.select(F.trunc(month, "month").alias(month)).filter(F.col(month).isNotNull()).distinct()
    span = present.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    every = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias(month)
    )
    return every.join(present, month, "left_anti")


def tally(checks: Mapping[str, DataFrame]) -> DataFrame:
    """``(check, violations)`` for all checks in one job."""
    counts = [
        violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, violations in checks.items()
    ]
    united = counts[0]
    for more in counts[1:]:
        united = united.unionByName(more)
    return united
