"""Address lookup: which addresses are in use, which the cache misses, and what the answers are worth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.catalog import LOOKUP_DETAILS
from sluicebox.functions.geo import REJECTED_LEVELS
from sluicebox.functions.text import clean_text, query_form, sql_trim
from sluicebox.sources.ndjson import last_wins


def distinct_addresses(tables: Sequence[DataFrame], address: str = "address") -> DataFrame:
    """Every non-blank address of the tables, once, stripped."""
    texts = [table.select(clean_text(F.col(address).cast("string")).alias("address")) for table in tables]
    united = texts[0]
    for more in texts[1:]:
        united = united.unionByName(more)
    return united.filter(F.col("address") != "").distinct()


def enrich(df: DataFrame, lookup: DataFrame, address: str = "address", columns: Sequence[str] | None = None) -> DataFrame:
    """Left join on the trimmed address. ``lookup`` must be unique on ``address`` and comes as ``looked_up_*``."""
    names = [name for name in (columns or lookup.columns) if name != "address"]
    answers = lookup.select(
        F.col("address").alias("lookup_address"), *[F.col(name).alias(f"looked_up_{name}") for name in names]
    )
    return df.join(answers, sql_trim(F.col(address)) == F.col("lookup_address"), "left").drop("lookup_address")


def misses(in_use: DataFrame, cache: DataFrame, address: str = "address") -> DataFrame:
    return in_use.join(cache.select(address), address, "left_anti")


def current(in_use: DataFrame, cache: DataFrame, address: str = "address") -> DataFrame:
    """Cache records of the addresses in use; the cache itself keeps its history."""
    return in_use.select(address).join(cache, address, "inner")


def upsert(cache: DataFrame, new: DataFrame, key: str = "address") -> DataFrame:
    """``new`` overrides and adds."""
    return cache.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def accept(level: Column, lat: Column, lon: Column, rejected: Sequence[str] = REJECTED_LEVELS) -> dict[str, Column]:
    """Coordinate of an answer, dropped if too coarse; ``abr_level`` keeps the level that was returned."""
    returned = F.coalesce(F.nullif(level, F.lit("")), F.lit("unknown"))
    usable = ~returned.isin(*rejected) & lat.isNotNull()
    return {
        "geo_lat": F.when(usable, lat),
        "geo_lon": F.when(usable, lon),
        "geo_level": F.when(usable, returned),
        "abr_level": returned,
    }


def attach(
    missed: DataFrame, results: DataFrame, order: str | None = None, details: Sequence[str] = LOOKUP_DETAILS
) -> DataFrame:
    """Answers for ``missed`` ``(address, query)``.

    ``results`` is ``(input, coordinate_level, lat, lon, …)``; both sides are compared in query form. Of several
    answers to one text the last in ``order`` counts. An unanswered address stays, with every other column NULL.
    """
    held = [name for name in details if name in results.columns]
    kept = ["coordinate_level", "lat", "lon", *held]
    answers = results.select(query_form(F.col("input")).alias("text"), *kept, *([order] if order else []))
    if order:
        answers = last_wins(answers, "text", order).drop(order)
    asked = missed.select("address", query_form(F.col("query")).alias("text"))
    answered = F.col("answered").isNotNull()
    verdict = accept(F.col("coordinate_level"), F.col("lat"), F.col("lon"))
    return asked.join(answers.withColumn("answered", F.lit(True)), "text", "left").select(
        "address",
        *[F.when(answered, column).alias(name) for name, column in verdict.items()],
        *held,
    )


def level_histogram(lookup: DataFrame, level: str = "geo_level", none: str = "none") -> DataFrame:
    """``(level, n, share)``, most common first."""
    counts = lookup.groupBy(F.coalesce(F.nullif(level, F.lit("")), F.lit(none)).alias("level")).agg(
        F.count("*").alias("n")
    )
    # Only the counts, one row per level, meet in one task.
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "level", "n", F.try_divide(F.col("n").cast("double"), total).alias("share")
    ).orderBy(F.col("n").desc(), "level")
