"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def cents(column: str) -> Column:
    """Money as a whole number, so that sums do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("bigint")


def grouped(number: Column) -> Column:
    """A whole number as text with thousands separators."""
    return F.format_number(number, 0)


def choose(key: Column, *choices: Column | str | None) -> Column:
    """The choice at ``key`` modulo their number."""
    if not any(isinstance(choice, Column) for choice in choices):
        return F.get(F.array(*[F.lit(choice) for choice in choices]), (key % len(choices)).cast("int"))
    picked = F.lit(None).cast("string")
    for n, choice in enumerate(choices):
        value = F.lit(choice) if choice is None or isinstance(choice, str) else choice
        picked = F.when(key % len(choices) == n, value).otherwise(picked)
    return picked
