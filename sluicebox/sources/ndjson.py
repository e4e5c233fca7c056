"""Newline-delimited JSON with a declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def text_schema(columns: Iterable[str]) -> StructType:
    """All columns as text, the shape of every raw table."""
    schema = StructType()
    for name in columns:
        schema.add(name, StringType())
    return schema


def read_ndjson(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Absent keys read as NULL, undeclared keys are ignored, a malformed line fails, a zero-byte file has no rows."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_ndjson_ordered(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """As ``read_ndjson``, with ``line``, a sortable position that follows the order of the lines."""
    return read_ndjson(spark, path, schema).select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("serial"),
        ).alias("line"),
    )


def last_wins(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """One row per key, the last in ``order``. Each task keeps one row per key before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    latest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("nth", F.row_number().over(latest)).filter(F.col("nth") == 1).drop("nth")


def load_cache(
    spark: SparkSession, path: str | list[str], schema: StructType | str, key: str = "address"
) -> DataFrame:
    """A lookup cache, one record per key, the last line winning; a missing file is an empty cache."""
    try:
        lines = read_ndjson_ordered(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return last_wins(lines.filter(F.col(key).isNotNull()), key, "line").drop("line")


def write_ndjson(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write one folder of files, or one per value of ``by``; NULLs are left out of the objects."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).json(path)


def write_sorted(df: DataFrame, path: str, by: str) -> None:
    """Write files whose names and lines follow the order of ``by``."""
    df.repartitionByRange(F.col(by).asc_nulls_last()).sortWithinPartitions(F.col(by).asc_nulls_last()).write.mode(
        "errorifexists"
    ).json(path)
