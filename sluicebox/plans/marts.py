"""Raw text tables -> typed stage -> published mart, all lazy.

Stage and mart are views over the raw table. Where a mart is filtered often, write its stage as a table: a filter on a
cleaned column reaches a parquet scan only if the cleaned column is stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from sluicebox import catalog
from sluicebox.functions import clean, geo
from sluicebox.operators.lookup import enrich
from sluicebox.sources.ndjson import text_schema

SERIES_PROVENANCE = ("_source_url", "_source_page", "_fetched_at")
GEO_COLUMNS = ("geo_lat", "geo_lon", "geo_source", "geo_level", "geometry")


def series_schema(layout: str) -> StructType:
    return text_schema([*catalog.LAYOUTS[layout].columns.values(), *SERIES_PROVENANCE])


def facility_schema(source: catalog.FacilitySource) -> StructType:
    tagged = ["category"] if source.category else []
    return text_schema([*tagged, *source.columns, "_extras", *catalog.PROVENANCE])


def lookup_schema() -> StructType:
    schema = StructType().add("address", StringType()).add("geo_lat", DoubleType()).add("geo_lon", DoubleType())
    for name in ("geo_level", *catalog.LOOKUP_DETAILS):
        schema.add(name, StringType())
    return schema


def log_schema() -> StructType:
    """The ingest log as written by either kind of job; a key one of them lacks reads as NULL."""
    schema = text_schema(["dataset_id", "dataset_title", "category", "status", "reason", "encoding"])
    schema.add("row_count", LongType()).add("dropped_rows", LongType())
    schema.add("resolved_months", ArrayType(StringType())).add("unresolved_months", ArrayType(StringType()))
    for name in ("file_label", "url", "page", "fetched_at"):
        schema.add(name, StringType())
    return schema


def _published(df: DataFrame, cleaned: dict) -> DataFrame:
    """Apply ``cleaned`` and publish the provenance columns without their underscore."""
    typed = df.withColumns(cleaned).drop("_fetched_at")
    return typed.withColumnsRenamed({name: name[1:] for name in typed.columns if name.startswith("_")})


def summary(raw: DataFrame) -> DataFrame:
    """One row per month, item and category."""
    return _published(
        raw,
        {
            "survey_month": clean.lenient_date(F.col("survey_month")),
            "category": clean.blank_to_null(F.col("category")),
            "value": clean.count_number(F.col("value")),
        },
    ).select("survey_month", "item", "category", "value", "unit", "source_url", "source_page")


def by_town(raw: DataFrame) -> DataFrame:
    """One row per month and town, with subtotal rows; ``area_level`` tells them apart."""
    counts = catalog.LAYOUTS["by_town"].value
    return _published(
        raw,
        {
            "survey_month": clean.lenient_date(F.col("survey_month")),
            "town_name": clean.blank_to_null(F.col("town_name")),
            "chome": clean.blank_to_null(F.col("chome")),
            "chome_number": clean.wide_number(F.col("chome")),
            **{name: clean.count_number(F.col(name)) for name in counts},
        },
    ).select(
        "survey_month", "town", "area_level", "town_name", "chome", "chome_number", *counts,
        "source_url", "source_page",
    )


def by_age(raw: DataFrame) -> DataFrame:
    """One row per month, age and sex, with total rows; ``is_total`` tells them apart."""
    return _published(
        raw,
        {
            "survey_month": clean.lenient_date(F.col("survey_month")),
            "is_total": clean.is_total(F.col("age")),
            "age_years": clean.spaced_number(F.col("age")),
            "value": clean.count_number(F.col("value")),
        },
    ).select(
        "survey_month", "age", "age_years", "is_total", "sex", "value", "unit", "source_url", "source_page"
    )


SERIES_MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {"summary": summary, "by_town": by_town, "by_age": by_age}


def facility_columns(source: catalog.FacilitySource) -> list[str]:
    """Columns of a facility mart: the map coordinate follows the published one, particulars the postal code."""
    standard = [name for name in source.columns if name in catalog.STANDARD_FACILITY]
    particular = [name for name in source.columns if name not in catalog.STANDARD_FACILITY]
    columns = ["category"] if source.category else []
    for name in standard:
        columns.append(name)
        if name == "lon":
            columns.extend(GEO_COLUMNS)
        if name == "postal_code":
            columns.extend(particular)
    return [*columns, "extras", "source_title", "source_url", "source_page"]


def facility(raw: DataFrame, lookup: DataFrame, source: catalog.FacilitySource) -> DataFrame:
    """Facilities with the coordinate to show. ``lookup`` is unique on ``address``."""
    numbers = [name for name in ("lat", "lon", "elevation") if name in source.columns]
    located = enrich(raw, lookup, columns=["geo_lat", "geo_lon", "geo_level"]).withColumns(
        {name: clean.real_number(F.col(name)) for name in numbers} | clean.flags(source.flags)
    )
    chosen = located.withColumns(
        geo.select_geo(
            F.col("lat"),
            F.col("lon"),
            F.col("looked_up_geo_lat"),
            F.col("looked_up_geo_lon"),
            F.col("looked_up_geo_level"),
        )
    )
    return _published(chosen, {"geometry": geo.point(F.col("geo_lat"), F.col("geo_lon"))}).select(
        *facility_columns(source)
    )


def source_files(series_log: DataFrame, facility_log: DataFrame) -> DataFrame:
    """One row per file that was tried, from both kinds of job; what a log lacks is NULL."""
    declared = log_schema()

    def padded(log: DataFrame, schema_name: str) -> DataFrame:
        missing = {f.name: F.lit(None).cast(f.dataType) for f in declared if f.name not in log.columns}
        return log.withColumns(missing).withColumn("schema_name", F.lit(schema_name))

    united = padded(series_log, "population").unionByName(padded(facility_log, "bosai"))
    return united.withColumn("fetched_at", clean.lenient_timestamp(F.col("fetched_at"))).select(
        "schema_name", *declared.fieldNames()
    )


def facility_sources() -> dict[str, catalog.FacilitySource]:
    """One declaration per facility table; several lists may share it."""
    return {source.dataset_id: source for source in reversed(catalog.FACILITIES)}
