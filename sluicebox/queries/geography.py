"""Coordinates, built from ``customer`` as facilities and ``supplier`` as looked-up addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions import clean, geo
from sluicebox.functions.geo import ACCEPTED_LEVELS
from sluicebox.operators import checks
from sluicebox.operators.lookup import enrich
from sluicebox.queries.common import choose, table, text


def _decimal(whole: Column, hundredths: Column) -> Column:
    return F.concat(text(whole), F.lit("."), F.lpad(text(hundredths), 2, "0"))


def coordinate_texts(key: Column) -> dict[str, Column]:
    """Valid twice, swapped, absent, out of range, unreadable."""
    lat, lon = _decimal(key % 26 + 20, key % 100), _decimal(key % 32 + 122, key * 7 % 100)
    return {
        "lat": choose(key, lat, lat, lon, "", "95.10", F.concat(lat, F.lit("d"))),
        "lon": choose(key, lon, lon, lat, None, lon, lon),
    }


def address_text(key: Column) -> Column:
    plain = F.concat(F.lit("住所"), text(key % 150))
    return F.when(key % 17 == 0, F.lit(None)).otherwise(choose(key, plain, F.concat(F.lit(" "), plain, F.lit("　"))))


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    texts = {"address": address_text(key), **coordinate_texts(key)}
    return table(spark, sf_dir, "customer").select("c_custkey", *[c.alias(name) for name, c in texts.items()])


def lookup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per address; every fifth address was not found."""
    key = F.col("s_suppkey")
    found = key % 5 != 4
    lat, lon = _decimal(key % 10 + 30, F.lit(50)), _decimal(key % 10 + 130, F.lit(25))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("住所"), text(key)).alias("address"),
        F.when(found, lat).cast("double").alias("geo_lat"),
        F.when(found, lon).cast("double").alias("geo_lon"),
        F.when(found, choose(key, *ACCEPTED_LEVELS)).alias("geo_level"),
    )


ADDRESS_SQL = """case when c_custkey % 17 = 0 then null when c_custkey % 2 = 0 then '住所' || (c_custkey % 150)
  else ' 住所' || (c_custkey % 150) || '　' end"""

# Where every facility has to come out, by the kind of its coordinates (as ``coordinate_texts`` lists them) and the
# number of the address it asks for; ``found`` is the address that answers for coordinates that are of no use.
PLACED_SQL = """
with k as (
  select c_custkey, c_custkey % 6 as kind, case when c_custkey % 17 <> 0 then c_custkey % 150 end as asked,
    ((c_custkey % 26 + 20) * 100 + c_custkey % 100) / 100 as own_lat,
    ((c_custkey % 32 + 122) * 100 + c_custkey * 7 % 100) / 100 as own_lon
  from customer
), a as (
  select k.*, s_suppkey as found from k left join supplier on s_suppkey = asked and s_suppkey % 5 <> 4 and kind > 2
)
select c_custkey, kind, asked, kind < 3 as published, kind < 3 or found is not null as placed,
  (case kind when 0 then own_lat when 1 then own_lat when 2 then own_lon when 4 then 95.1 end)::double as lat,
  (case kind when 2 then own_lat when 3 then null else own_lon end)::double as lon,
  (case when kind < 3 then own_lat else found % 10 + 30.5 end)::double as geo_lat,
  (case when kind < 3 then own_lon else found % 10 + 130.25 end)::double as geo_lon,
  case when kind < 2 then 'source' when kind = 2 then 'source_swapped' when found is not null then 'abr' end as geo_source,
  case when kind < 3 then 'source'
    else ['residential_detail', 'residential_block', 'machiaza_detail', 'machiaza'][found % 4 + 1] end as geo_level
from a
"""


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facilities(spark, sf_dir).withColumns({name: clean.real_number(F.col(name)) for name in ("lat", "lon")})


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with the coordinate to show and its point."""
    enriched = enrich(_typed(spark, sf_dir), lookup_table(spark, sf_dir))
    answer = [F.col(f"looked_up_{name}") for name in ("geo_lat", "geo_lon", "geo_level")]
    chosen = enriched.withColumns(geo.select_geo(F.col("lat"), F.col("lon"), *answer))
    return chosen.withColumn("geometry", geo.point(F.col("geo_lat"), F.col("geo_lon")))


SHOWN = ["c_custkey", "geo_lat", "geo_lon", "geo_source", "geo_level"]


def geo_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a lookup: as published, swapped, or nothing."""
    chosen = _typed(spark, sf_dir).withColumns(geo.select_geo(F.col("lat"), F.col("lon")))
    chosen = chosen.withColumn("geometry", geo.point(F.col("geo_lat"), F.col("geo_lon")))
    return chosen.select(*SHOWN, "geometry.x", "geometry.y")


def geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(spark, sf_dir).select(*SHOWN, "geometry.x", "geometry.y")


def _damaged(df: DataFrame) -> DataFrame:
    """The same rows with five kinds of mistakes in them."""
    key = F.col("c_custkey")
    hurt = df.withColumns(
        {
            "geo_lat": F.when(key % 31 == 0, F.lit(None)).otherwise(F.col("geo_lat")),
            "geo_source": F.when(key % 37 == 0, "guess").when(key % 41 == 0, "abr").otherwise(F.col("geo_source")),
            "geo_level": F.when(key % 43 == 0, "city").otherwise(F.col("geo_level")),
        }
    )
    backwards = F.struct(F.col("geometry.y").alias("x"), F.col("geometry.x").alias("y"))
    return hurt.withColumn(
        "geometry", F.when((key % 47 == 0) & F.col("geometry").isNotNull(), backwards).otherwise(F.col("geometry"))
    )


def geo_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.geo_consistency(_damaged(located(spark, sf_dir))).select(*SHOWN, "lat", "lon")


# A changed source or level always shows, but for a looked-up row that is called looked up; a lost latitude or a point
# turned round shows only where there was one.
CONSISTENCY_SQL = f"""
select c_custkey, case when c_custkey % 31 <> 0 then geo_lat end as geo_lat, geo_lon,
  case when c_custkey % 37 = 0 then 'guess' when c_custkey % 41 = 0 then 'abr' else geo_source end as geo_source,
  case when c_custkey % 43 = 0 then 'city' else geo_level end as geo_level, lat, lon
from ({PLACED_SQL})
where c_custkey % 37 = 0 or c_custkey % 43 = 0 or (c_custkey % 41 = 0 and (published or not placed))
  or (placed and (c_custkey % 31 = 0 or c_custkey % 47 = 0))
"""


def check_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both coverage checks with a floor that cannot be met, and once with one that is."""
    source, lookup = checks.source_parts(), checks.lookup_parts()
    rules = {"source": (*source, 0.999), "lookup": (*lookup, 1.0), "passing": (*source, 0.01)}
    return checks.coverages(located(spark, sf_dir), rules)


# "passing" meets its floor and has no row.
COVERAGE_SQL = f"""
with p as (select * from ({PLACED_SQL})), counted as (
  select 'source' as check_name, count(*) filter (where kind in (0, 1, 2, 4)) as whole_rows,
    count(*) filter (where published) as part_rows from p
  union all select 'lookup', count(asked), count(asked) filter (where placed) from p
)
select *, part_rows / whole_rows as ratio from counted
"""

QUERIES = {
    "geo_select": geo_select,
    "geo_enrich": geo_enrich,
    "geo_consistency": geo_consistency,
    "check_coverage": check_coverage,
}
_POINT_SQL = "geo_lon as x, geo_lat as y"
_ALONE_SQL = ", ".join(f"case when published then {name} end as {name}" for name in SHOWN[1:])
SQL = {
    "geo_select": f"select c_custkey, {_ALONE_SQL}, case when published then geo_lon end as x, case when published then geo_lat end as y from ({PLACED_SQL})",
    "geo_enrich": f"select {', '.join(SHOWN)}, {_POINT_SQL} from ({PLACED_SQL})",
    "geo_consistency": CONSISTENCY_SQL,
    "check_coverage": COVERAGE_SQL,
}
