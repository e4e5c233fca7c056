"""The eight published marts and the publication step, over raw rows derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox import catalog
from sluicebox.functions.clean import FLAG_FALSE, FLAG_TRUE
from sluicebox.operators import checks
from sluicebox.plans import marts
from sluicebox.plans import publish as publication
from sluicebox.queries import geography
from sluicebox.queries.common import cents, choose, grouped, table, text
from sluicebox.queries.timelines import AGE_MART_SQL, TOWN_MART_SQL, age_rows, town_rows
from sluicebox.session import scratch_path

FLAG_WORDS = (*FLAG_TRUE, *FLAG_FALSE, "?", "")


def mart_by_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_town(town_rows(spark, sf_dir)).withColumn("survey_month", text("survey_month"))


def mart_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_age(age_rows(spark, sf_dir)).withColumn("survey_month", text("survey_month"))


def mart_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        F.date_format(F.to_date("o_orderdate"), "yyyy/M/d").alias("survey_month"),
        choose(key, "世帯数", "総人口", "日本人の人口", "外国人の人口").alias("item"),
        choose(key, "", "男", "女", "計").alias("category"),
        grouped(F.floor("o_totalprice")).alias("value"),
        F.lit("[人]").alias("unit"),
        F.concat(F.lit("https://example.org/"), text(key), F.lit(".csv")).alias("_source_url"),
        F.lit("https://example.org/summary.html").alias("_source_page"),
        F.lit("2026-01-01T00:00:00+00:00").alias("_fetched_at"),
    )
    return marts.summary(raw).withColumn("survey_month", text("survey_month"))


SUMMARY_SQL = """
select o_orderdate::date::varchar as survey_month,
  case o_orderkey % 4 when 0 then '世帯数' when 1 then '総人口' when 2 then '日本人の人口' else '外国人の人口' end as item,
  case o_orderkey % 4 when 1 then '男' when 2 then '女' when 3 then '計' end as category,
  floor(o_totalprice)::bigint as value, '[人]' as unit, 'https://example.org/' || o_orderkey || '.csv' as source_url,
  'https://example.org/summary.html' as source_page
from orders
"""


def _raw_facility(spark: SparkSession, sf_dir: str, source: catalog.FacilitySource) -> DataFrame:
    """Facility rows from customers: every text column NULL for some of them, flags through their vocabulary."""
    key = F.col("c_custkey")
    special: dict[str, Column] = {
        "category": choose(key, "民間", "学校"),
        "name": F.col("c_name"),
        "address": geography.address_text(key),
        **geography.coordinate_texts(key),
        "elevation": F.concat(text(key % 60), F.lit(".5")),
        **{name: choose(key + n, *FLAG_WORDS) for n, name in enumerate(source.flags)},
    }
    columns = []
    for n, name in enumerate(marts.facility_schema(source).fieldNames()):
        plain = F.when(key % (n + 2) != 0, F.concat(F.lit(f"{name}-"), text(key)))
        columns.append(special.get(name, plain).alias(name))
    return table(spark, sf_dir, "customer").select(*columns)


def _facility_sql(source: catalog.FacilitySource) -> str:
    n_words, n_true, n_known = len(FLAG_WORDS), len(FLAG_TRUE), len(FLAG_TRUE + FLAG_FALSE)
    exact = {
        "category": "case c_custkey % 2 when 0 then '民間' else '学校' end",
        "name": "c_name",
        "address": geography.ADDRESS_SQL,
        "elevation": "(c_custkey % 60 + 0.5)::double",
    }
    for n, name in enumerate(source.flags):
        word = f"(c_custkey + {n}) % {n_words}"
        exact[name] = f"case when {word} < {n_true} then true when {word} < {n_known} then false end"
    number = {name: n for n, name in enumerate(marts.facility_schema(source).fieldNames())}
    out = []
    for name in marts.facility_columns(source):
        raw = f"_{name}" if name == "extras" or name.startswith("source_") else name
        if name == "geometry":
            out.append("geo_lon as x, geo_lat as y")
        elif name in ("lat", "lon", *geography.SHOWN):
            out.append(name)
        elif name in exact:
            out.append(f"{exact[name]} as {name}")
        else:
            out.append(f"case when c_custkey % {number[raw] + 2} <> 0 then '{raw}-' || c_custkey end as {name}")
    return f"select {', '.join(out)} from customer join ({geography.PLACED_SQL}) using (c_custkey)"


def _facility_query(dataset_id: str) -> Callable[[SparkSession, str], DataFrame]:
    source = marts.facility_sources()[dataset_id]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, lookup = _raw_facility(spark, sf_dir, source), geography.lookup_table(spark, sf_dir)
        mart = marts.facility(raw, lookup, source)
        return mart.select("*", "geometry.x", "geometry.y").drop("geometry")

    return query


def _logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ingest logs: an order each for the monthly series, a customer each for the facilities."""
    key = F.col("o_orderkey")
    months = F.array(F.date_format("o_orderdate", "yyyy-MM-dd"))
    series_log = table(spark, sf_dir, "orders").select(
        text(key).alias("dataset_id"),
        F.lit("世帯と人口").alias("dataset_title"),
        choose(key, "ok", "degraded", "skipped", "failed").alias("status"),
        choose(key, None, "duplicate_months_unresolved: []", "header_mismatch", "fetch_error: 404").alias("reason"),
        choose(key, "utf-8-sig", "cp932").alias("encoding"),
        key.alias("row_count"),
        (key % 3).alias("dropped_rows"),
        F.when(key % 2 == 0, months).alias("resolved_months"),
        F.when(key % 2 == 1, months).alias("unresolved_months"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("fetched_at"),
    )
    key = F.col("c_custkey")
    facility_log = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("dataset_id"),
        F.lit("防災井戸").alias("dataset_title"),
        choose(key, "民間", "学校").alias("category"),
        choose(key, "ok", "skipped").alias("status"),
        key.alias("row_count"),
        F.lit("いつか").alias("fetched_at"),
    )
    return series_log, facility_log


def mart_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.source_files(*_logs(spark, sf_dir))
    return mart.withColumns(
        {
            "resolved_months": F.array_join("resolved_months", ","),
            "unresolved_months": F.array_join("unresolved_months", ","),
            "fetched_at": F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"),
        }
    ).drop("file_label", "url", "page")


SOURCE_FILES_SQL = """
select 'population' as schema_name, o_orderkey::varchar as dataset_id, '世帯と人口' as dataset_title, null as category,
  case o_orderkey % 4 when 0 then 'ok' when 1 then 'degraded' when 2 then 'skipped' else 'failed' end as status,
  case o_orderkey % 4 when 1 then 'duplicate_months_unresolved: []' when 2 then 'header_mismatch'
    when 3 then 'fetch_error: 404' end as reason,
  case o_orderkey % 2 when 0 then 'utf-8-sig' else 'cp932' end as encoding, o_orderkey as row_count,
  o_orderkey % 3 as dropped_rows,
  case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') end as resolved_months,
  case when o_orderkey % 2 = 1 then strftime(o_orderdate, '%Y-%m-%d') end as unresolved_months,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as fetched_at
from orders
union all
select 'bosai', c_name, '防災井戸', case c_custkey % 2 when 0 then '民間' else '学校' end,
  case c_custkey % 2 when 0 then 'ok' else 'skipped' end, null, null, c_custkey, null, null, null, null
from customer
"""


def union_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both logs in one table: what only one of them has is NULL for the other."""
    return (
        marts.source_files(*_logs(spark, sf_dir))
        .groupBy("schema_name", "status")
        .agg(
            F.count("*").alias("n"),
            F.count("category").alias("n_category"),
            F.sum("row_count").alias("row_count"),
            F.sum("dropped_rows").alias("dropped_rows"),
            F.count("fetched_at").alias("n_fetched_at"),
            F.count("url").alias("n_url"),
        )
    )


UNION_LOG_SQL = f"""
select schema_name, status, count(*) as n, count(category) as n_category, sum(row_count)::bigint as row_count,
  sum(dropped_rows)::bigint as dropped_rows, count(fetched_at) as n_fetched_at, 0::bigint as n_url
from ({SOURCE_FILES_SQL}) group by 1, 2
"""


def layered_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table, lazy stage and mart views, and an analyst's SQL over them."""
    raw = publication.materialise(town_rows(spark, sf_dir), scratch_path(spark, "raw_by_town"))
    publication.view(marts.by_town(raw), "stg_by_town")
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("T"), text("c_custkey")).alias("town"), F.col("c_mktsegment").alias("segment")
    )
    publication.view(customers, "town_segment")
    return spark.sql(
        """
        SELECT segment, area_level, count(*) AS n, sum(total) AS people, max(households) AS largest
        FROM stg_by_town JOIN town_segment USING (town)
        GROUP BY segment, area_level
        """
    )


LAYERED_SQL = f"""
select c_mktsegment as segment, area_level, count(*) as n, sum(total)::bigint as people, max(households) as largest
from ({TOWN_MART_SQL}) join customer on town = 'T' || c_custkey group by 1, 2
"""


def audited_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good version is published, a second one with repeated keys is refused, and readers still see the first."""
    root = scratch_path(spark, "published")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", cents("o_totalprice").alias("cents"))

    def audit(written):
        return {
            "not_empty": checks.not_empty(written["orders"]),
            "not_null": checks.not_null(written["orders"], "o_orderstatus"),
            "unique_key": checks.unique_key(written["orders"], ["o_orderkey"]),
        }

    good = publication.publish({"orders": orders}, audit, root)
    bad = publication.publish({"orders": orders.union(orders)}, audit, root)
    return (
        publication.published(spark, root, "orders")
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
        .select(
            "*",
            F.lit(good.published).alias("first_published"),
            F.lit(bad.published).alias("second_published"),
            F.lit(",".join(bad.failed)).alias("second_failed"),
        )
    )


PUBLISH_SQL = """
select o_orderstatus, count(*) as n, sum(round(o_totalprice * 100)::bigint)::bigint as cents,
  true as first_published, false as second_published, 'unique_key' as second_failed
from orders group by 1
"""

_FACILITIES = ("evacuation_base", "homecoming_support_station", "emergency_water_station", "disaster_well")
QUERIES = {
    "mart_summary": mart_summary,
    "mart_by_town": mart_by_town,
    "mart_by_age": mart_by_age,
    **{f"mart_{name}": _facility_query(name) for name in _FACILITIES},
    "mart_source_files": mart_source_files,
    "union_log": union_log,
    "layered_marts": layered_marts,
    "audited_publish": audited_publish,
}
SQL = {
    "mart_summary": SUMMARY_SQL,
    "mart_by_town": f"select * replace (survey_month::varchar as survey_month) from ({TOWN_MART_SQL})",
    "mart_by_age": f"select * replace (survey_month::varchar as survey_month) from ({AGE_MART_SQL})",
    **{f"mart_{name}": _facility_sql(marts.facility_sources()[name]) for name in _FACILITIES},
    "mart_source_files": SOURCE_FILES_SQL,
    "union_log": UNION_LOG_SQL,
    "layered_marts": LAYERED_SQL,
    "audited_publish": PUBLISH_SQL,
}
