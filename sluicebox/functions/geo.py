"""Choosing a map coordinate by priority, with its origin recorded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Extent:
    """Accepted ranges, ends included. They must not overlap, or a swapped pair could not be told apart."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# The extent of Japan and the vocabularies of the published columns.
JAPAN = Extent(lat_min=20.0, lat_max=46.0, lon_min=122.0, lon_max=154.5)
SOURCE = "source"
SWAPPED = "source_swapped"
FALLBACK = "abr"
ACCEPTED_LEVELS = ("residential_detail", "residential_block", "machiaza_detail", "machiaza")
REJECTED_LEVELS = ("city", "prefecture", "unknown")


def in_range(lat: Column, lon: Column, extent: Extent = JAPAN) -> Column:
    return lat.between(extent.lat_min, extent.lat_max) & lon.between(extent.lon_min, extent.lon_max)


def select_geo(
    lat: Column,
    lon: Column,
    fallback_lat: Column | None = None,
    fallback_lon: Column | None = None,
    fallback_level: Column | None = None,
    extent: Extent = JAPAN,
) -> dict[str, Column]:
    """Coordinate to show: as published, else published with the axes swapped, else the looked-up one.

    Without fallback columns the last choice is switched off. The result feeds ``withColumns``.
    """
    as_is = in_range(lat, lon, extent)
    swapped = in_range(lon, lat, extent)
    none = F.lit(None)
    other_lat = none.cast("double") if fallback_lat is None else fallback_lat
    other_lon = none.cast("double") if fallback_lon is None else fallback_lon
    other_level = none.cast("string") if fallback_level is None else fallback_level
    return {
        "geo_lat": F.when(as_is, lat).when(swapped, lon).otherwise(other_lat),
        "geo_lon": F.when(as_is, lon).when(swapped, lat).otherwise(other_lon),
        "geo_source": F.when(as_is, SOURCE).when(swapped, SWAPPED).when(other_lat.isNotNull(), FALLBACK),
        "geo_level": F.when(as_is | swapped, SOURCE).otherwise(other_level),
    }


def point(lat: Column, lon: Column) -> Column:
    """Point with x = longitude and y = latitude; NULL, not an empty point, when there is no latitude."""
    return F.when(lat.isNotNull(), F.struct(lon.alias("x"), lat.alias("y")))


def inconsistent(
    lat: str = "lat",
    lon: str = "lon",
    geometry: str = "geometry",
    levels: Sequence[str] = ACCEPTED_LEVELS,
    extent: Extent = JAPAN,
) -> Column:
    """True for a row whose coordinate columns contradict each other or leave the accepted ranges."""
    source_lat, source_lon = F.col(lat), F.col(lon)
    geo_lat, geo_lon = F.col("geo_lat"), F.col("geo_lon")
    origin, level, shape = F.col("geo_source"), F.col("geo_level"), F.col(geometry)
    x, y = shape.getField("x"), shape.getField("y")
    absent = geo_lat.isNull()
    published = origin.isin(SOURCE, SWAPPED)

    out_of_range = (
        ~geo_lat.between(extent.lat_min, extent.lat_max)
        | ~geo_lon.between(extent.lon_min, extent.lon_max)
        | ~x.between(extent.lon_min, extent.lon_max)
        | ~y.between(extent.lat_min, extent.lat_max)
    )
    half_present = (
        (geo_lon.isNull() != absent)
        | (origin.isNull() != absent)
        | (level.isNull() != absent)
        | (shape.isNull() != absent)
    )
    unknown_word = ~origin.isin(SOURCE, SWAPPED, FALLBACK) | ~level.isin(SOURCE, *levels)
    mislabelled = (
        (published != (level == SOURCE))
        | ((origin == SOURCE) & ~(geo_lat.eqNullSafe(source_lat) & geo_lon.eqNullSafe(source_lon)))
        | ((origin == SWAPPED) & ~(geo_lat.eqNullSafe(source_lon) & geo_lon.eqNullSafe(source_lat)))
    )
    needless_lookup = (origin == FALLBACK) & (
        in_range(source_lat, source_lon, extent) | in_range(source_lon, source_lat, extent)
    )
    return out_of_range | half_present | unknown_word | mislabelled | needless_lookup
