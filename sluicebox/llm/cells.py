"""Cells of bounded size for work within a group: a large group is dealt out as pairs of its chunks.

A group of at most ``limit`` rows is one cell. A larger one is cut into chunks by a hash of the row, and every two
chunks meet in one cell (a chunk also meets itself), so any two rows of a group still meet somewhere, no cell holds
more than about two chunks, and no pair of rows is ever written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deal(rows: DataFrame, keys: list[str], spread: Column, limit: int) -> DataFrame:
    """``rows`` with ``cell_i`` and ``cell_j`` added: rows of one cell agree in ``keys`` and both numbers.

    Only groups of two rows or more are returned; ``rows`` is read twice, so write it to a table first.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("cell_rows")).where("cell_rows > 1")
    sized = rows.join(sizes, keys)
    parts = F.ceil(F.col("cell_rows") / F.lit(limit)).cast("int")
    chunk = F.pmod(F.xxhash64(spread), parts).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda k: F.struct(F.least(k, chunk).alias("i"), F.greatest(k, chunk).alias("j")),
    )
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = sized.withColumn("cell", F.explode(F.when(parts == 1, single).otherwise(others)))
    return dealt.select(*rows.columns, F.col("cell.i").alias("cell_i"), F.col("cell.j").alias("cell_j"))
