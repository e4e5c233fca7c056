"""Address lookup: addresses from ``customer`` and ``supplier``, a cache and answers from ``part`` and ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions.clean import complete_address
from sluicebox.functions.geo import ACCEPTED_LEVELS, REJECTED_LEVELS
from sluicebox.operators import lookup
from sluicebox.plans import addresses
from sluicebox.queries.common import choose, table, text
from sluicebox.session import scratch_path
from sluicebox.sources.ndjson import load_cache, write_sorted


def _name(key: str) -> Column:
    return F.concat(F.lit("住所"), text(F.col(key)))


def in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    spaced = F.concat(F.lit("　住所"), text(key % 400), F.lit(" "))
    customers = table(spark, sf_dir, "customer").select(
        choose(key, F.concat(F.lit("住所"), text(key % 400)), spaced, " ", None).alias("address")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("住所"), text(F.col("s_suppkey") * 3)).alias("address"))
    return lookup.distinct_addresses([customers, suppliers])


IN_USE_SQL = """
select distinct trim(address) as address from (
  select case c_custkey % 4 when 0 then '住所' || (c_custkey % 400) when 1 then '　住所' || (c_custkey % 400) || ' '
    when 2 then ' ' end as address from customer
  union all select '住所' || (s_suppkey * 3) from supplier
) where trim(address) <> ''
"""


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known addresses: those of the smaller parts."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").filter(F.col("p_size") <= 25).select(
        _name("p_partkey").alias("address"),
        F.when(key % 7 != 0, choose(F.floor(key / 2), *ACCEPTED_LEVELS)).alias("geo_level"),
        (key % 10 + 30).cast("double").alias("geo_lat"),
    )


_LEVELS = """case {k} % 4 when 0 then 'residential_detail' when 1 then 'residential_block'
  when 2 then 'machiaza_detail' when 3 then 'machiaza' end"""
CACHE_SQL = f"""
select '住所' || p_partkey as address, case when p_partkey % 7 <> 0 then {_LEVELS.format(k="(p_partkey // 2)")} end as geo_level,
  (p_partkey % 10 + 30)::double as geo_lat
from part where p_size <= 25
"""


def distinct_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_use(spark, sf_dir).select(
        "address", complete_address(F.col("address"), "東京都", "中央区").alias("query")
    )


def lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.misses(in_use(spark, sf_dir), cache(spark, sf_dir))


def lookup_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.current(in_use(spark, sf_dir), cache(spark, sf_dir))


def lookup_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' answers override and extend the cache."""
    new = table(spark, sf_dir, "supplier").select(
        _name("s_suppkey").alias("address"),
        F.lit("machiaza").alias("geo_level"),
        F.lit(1.0).alias("geo_lat"),
    )
    return lookup.upsert(cache(spark, sf_dir), new)


def lookup_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    level = choose(key, *ACCEPTED_LEVELS, *REJECTED_LEVELS, None)
    lat = F.when(key % 5 != 0, (key % 10 + 30).cast("double"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        *[c.alias(name) for name, c in lookup.accept(level, lat, F.lit(139.5)).items()],
    )


CONFIDENCE_SQL = """
with r as (select p_partkey, case p_partkey % 8 when 0 then 'residential_detail' when 1 then 'residential_block'
    when 2 then 'machiaza_detail' when 3 then 'machiaza' when 4 then 'city' when 5 then 'prefecture'
    else 'unknown' end as level,
  case when p_partkey % 5 <> 0 then (p_partkey % 10 + 30)::double end as lat from part),
u as (select *, level not in ('city', 'prefecture', 'unknown') and lat is not null as usable from r)
select p_partkey, case when usable then lat end as geo_lat, case when usable then 139.5::double end as geo_lon,
  case when usable then level end as geo_level, level as abr_level from u
"""


def lookup_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers joined on normalised text; a text answered twice takes the last answer, some get none."""
    key = F.col("c_custkey")
    missed = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), text(key)).alias("address"),
        F.concat(F.lit(" Tokyo   A"), text(key), F.lit("\t")).alias("query"),
    )
    number = F.col("o_custkey")
    results = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.concat(F.lit("Tokyo A"), text(number)).alias("input"),
        choose(F.col("o_orderkey"), *ACCEPTED_LEVELS, "city").alias("coordinate_level"),
        (F.col("o_orderkey") % 10 + 30).cast("double").alias("lat"),
        F.lit(139.5).alias("lon"),
        text(F.col("o_orderkey") % 100).alias("match_level"),
        F.col("o_orderkey").alias("line"),
    )
    return lookup.attach(missed, results, order="line")


ATTACH_SQL = """
with r as (select o_custkey, max(o_orderkey) as k from orders where o_orderstatus <> 'P' group by 1),
a as (select c_custkey, k, case k % 5 when 0 then 'residential_detail' when 1 then 'residential_block'
    when 2 then 'machiaza_detail' when 3 then 'machiaza' when 4 then 'city' end as level
  from customer left join r on o_custkey = c_custkey)
select 'A' || c_custkey as address, case when level <> 'city' then (k % 10 + 30)::double end as geo_lat,
  case when level <> 'city' then 139.5::double end as geo_lon, nullif(level, 'city') as geo_level, level as abr_level,
  (k % 100)::varchar as match_level
from a
"""


def cache_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache file with many lines per address, read back by line order."""
    path = scratch_path(spark, "cache")
    lines = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("U"), text("user_id")).alias("address"),
        F.col("event_type").alias("geo_level"),
        text("event_id").alias("match_level"),
    )
    write_sorted(lines, path, "event_id")
    return load_cache(spark, path, "address string, geo_level string, match_level string")


LAST_SQL = """
select 'U' || user_id as address, arg_max(event_type, event_id) as geo_level, max(event_id)::varchar as match_level
from events group by 1
"""


def level_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.level_histogram(lookup_current(spark, sf_dir))


def lookup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole round: addresses in use, cache misses, answers for some of them, and the current records."""
    key = F.col("p_partkey")
    results = table(spark, sf_dir, "part").filter(F.col("p_size") > 25).select(
        F.concat(F.lit("東京都中央区住所"), text(key)).alias("input"),
        choose(key, *ACCEPTED_LEVELS, *REJECTED_LEVELS).alias("coordinate_level"),
        (key % 10 + 30).cast("double").alias("lat"),
        F.lit(139.5).alias("lon"),
        key.alias("line"),
    )
    tables = [in_use(spark, sf_dir), in_use(spark, sf_dir).filter(F.length("address") > 4)]
    done = addresses.refresh(tables, cache(spark, sf_dir), results, "東京都", "中央区", "line")
    return done.current.select("address", "geo_level", "geo_lat")


REFRESH_SQL = f"""
with answers as (select '住所' || p_partkey as address, (p_partkey % 10 + 30)::double as lat,
    case p_partkey % 7 when 0 then 'residential_detail' when 1 then 'residential_block' when 2 then 'machiaza_detail'
      when 3 then 'machiaza' end as level
  from part where p_size > 25)
select u.address, coalesce(c.geo_level, a.level) as geo_level,
  coalesce(c.geo_lat, case when a.level is not null then a.lat end) as geo_lat
from ({IN_USE_SQL}) u left join ({CACHE_SQL}) c on c.address = u.address left join answers a on a.address = u.address
"""

QUERIES = {
    "distinct_addresses": distinct_addresses,
    "lookup_misses": lookup_misses,
    "lookup_current": lookup_current,
    "lookup_upsert": lookup_upsert,
    "lookup_confidence": lookup_confidence,
    "lookup_attach": lookup_attach,
    "cache_last_wins": cache_last_wins,
    "level_histogram": level_histogram,
    "lookup_refresh": lookup_refresh,
}
_CURRENT_SQL = f"select c.* from ({IN_USE_SQL}) u join ({CACHE_SQL}) c on c.address = u.address"
SQL = {
    "distinct_addresses": f"select address, '東京都中央区' || address as query from ({IN_USE_SQL})",
    "lookup_misses": f"select address from ({IN_USE_SQL}) where address not in (select address from ({CACHE_SQL}))",
    "lookup_current": _CURRENT_SQL,
    "lookup_upsert": f"""select * from ({CACHE_SQL}) where address not in (select '住所' || s_suppkey from supplier)
      union all select '住所' || s_suppkey, 'machiaza', 1.0::double from supplier""",
    "lookup_confidence": CONFIDENCE_SQL,
    "lookup_attach": ATTACH_SQL,
    "cache_last_wins": LAST_SQL,
    "lookup_refresh": REFRESH_SQL,
    "level_histogram": f"""select coalesce(nullif(geo_level, ''), 'none') as level, count(*) as n,
      count(*)::double / sum(count(*)) over () as share from ({_CURRENT_SQL}) group by 1""",
}
