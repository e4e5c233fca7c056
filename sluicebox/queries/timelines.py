"""Monthly series with subtotal rows, built from ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions import clean
from sluicebox.operators import checks, series
from sluicebox.operators.evidence import wide_to_long
from sluicebox.plans import marts
from sluicebox.queries.common import cents, choose, grouped, table, text
from sluicebox.session import scratch_path, spool
from sluicebox.sources.ndjson import read_ndjson, write_ndjson


def town_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the town layout: one order each, written the way such files are written."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    amount = F.floor("o_totalprice")
    digit = F.substring(F.lit(clean.WIDE_DIGITS), (key % 10 + 1).cast("int"), F.lit(1))
    return table(spark, sf_dir, "orders").select(
        choose(
            key,
            F.date_format(day, "yyyy-MM-dd"),
            F.date_format(day, "yyyy/M/d"),
            F.date_format(day, "yyyy.M.d"),
            "4月頃",
        ).alias("survey_month"),
        F.concat(F.lit("T"), text("o_custkey")).alias("town"),
        F.when(key % 20 == 0, "総数").when(key % 20 == 1, "町域計").otherwise("丁目").alias("area_level"),
        F.when(key % 20 < 2, "").otherwise(F.concat(F.lit("町"), text(F.col("o_custkey") % 50))).alias("town_name"),
        F.when(key % 20 < 2, "").otherwise(digit).alias("chome"),
        grouped(key).alias("households"),
        grouped(amount % 1000).alias("male"),
        text(amount % 7919).alias("female"),
        F.when(key % 13 == 0, "-").otherwise(grouped(amount)).alias("total"),
        F.lit("https://example.org/towns.csv").alias("_source_url"),
        F.lit("https://example.org/towns.html").alias("_source_page"),
        F.lit("2026-01-01T00:00:00+00:00").alias("_fetched_at"),
    )


TOWN_SQL = """
select
  case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%Y-%m-%d')
    when 1 then strftime(o_orderdate, '%Y/%-m/%-d')
    when 2 then strftime(o_orderdate, '%Y.%-m.%-d')
    else '4月頃' end as survey_month,
  'T' || o_custkey as town,
  case o_orderkey % 20 when 0 then '総数' when 1 then '町域計' else '丁目' end as area_level,
  case when o_orderkey % 20 < 2 then '' else '町' || (o_custkey % 50) end as town_name,
  case when o_orderkey % 20 < 2 then '' else substr('０１２３４５６７８９', (o_orderkey % 10 + 1)::int, 1) end as chome,
  format('{:,}', o_orderkey) as households,
  format('{:,}', floor(o_totalprice)::bigint % 1000) as male,
  (floor(o_totalprice)::bigint % 7919)::varchar as female,
  case when o_orderkey % 13 = 0 then '-' else format('{:,}', floor(o_totalprice)::bigint) end as total,
  'https://example.org/towns.csv' as _source_url,
  'https://example.org/towns.html' as _source_page
from orders
"""
# What every field is worth, from the order it was written from.
TOWN_MART_SQL = """
select case when o_orderkey % 4 < 3 then o_orderdate::date end as survey_month, 'T' || o_custkey as town,
  case o_orderkey % 20 when 0 then '総数' when 1 then '町域計' else '丁目' end as area_level,
  case when o_orderkey % 20 >= 2 then '町' || (o_custkey % 50) end as town_name,
  case when o_orderkey % 20 >= 2 then substr('０１２３４５６７８９', (o_orderkey % 10 + 1)::int, 1) end as chome,
  case when o_orderkey % 20 >= 2 then (o_orderkey % 10)::integer end as chome_number,
  o_orderkey as households, floor(o_totalprice)::bigint % 1000 as male, floor(o_totalprice)::bigint % 7919 as female,
  case when o_orderkey % 13 <> 0 then floor(o_totalprice)::bigint end as total,
  'https://example.org/towns.csv' as source_url, 'https://example.org/towns.html' as source_page
from orders
"""


def latest_period_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON with a declared schema -> cleaned series, stored -> the ten largest towns of the latest month."""
    path = scratch_path(spark, "towns")
    write_ndjson(town_rows(spark, sf_dir), path)
    mart = marts.by_town(read_ndjson(spark, path, marts.series_schema("by_town")))
    stored = spool(mart.withColumn("month", F.trunc("survey_month", "month")))
    detail = series.detail_rows(stored, "area_level", "丁目")
    top = series.latest_top(detail, "month", "total", 10, ties=["households"])
    return top.select(text("month").alias("survey_month"), "town", "town_name", "chome", "households", "total")


LATEST_SQL = f"""
with detail as (
  select *, date_trunc('month', survey_month)::date as month from ({TOWN_MART_SQL}) where area_level = '丁目'
)
select month::varchar as survey_month, town, town_name, chome, households, total
from detail where month = (select max(month) from detail)
order by total desc nulls last, households limit 10
"""


def series_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total of every month, in order; unreadable months come last."""
    mart = marts.by_town(town_rows(spark, sf_dir))
    monthly = mart.groupBy(F.trunc("survey_month", "month").alias("month")).agg(F.sum("total").alias("population"))
    return series.trend(monthly, "month", "population").select(text("month").alias("survey_month"), "population")


TREND_SQL = f"""
select date_trunc('month', survey_month)::date::varchar as survey_month, sum(total)::bigint as population
from ({TOWN_MART_SQL}) group by 1 order by 1 nulls last
"""


def age_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the age layout: one order each."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        choose(key, F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy/M/d")).alias("survey_month"),
        F.when(key % 11 == 0, "総　数")
        .when(key % 11 == 1, "総 数")
        .when(key % 11 == 2, "総数")
        .when(key % 11 == 3, "不詳")
        .when(key % 11 == 4, F.concat(F.lit(" "), text(key % 100)))
        .otherwise(text(key % 100))
        .alias("age"),
        choose(key, "合計", "男性", "女性").alias("sex"),
        grouped(F.floor("o_totalprice")).alias("value"),
        F.lit("人").alias("unit"),
        F.lit("https://example.org/ages.csv").alias("_source_url"),
        F.lit("https://example.org/ages.html").alias("_source_page"),
        F.lit("2026-01-01T00:00:00+00:00").alias("_fetched_at"),
    )


AGE_MART_SQL = """
select o_orderdate::date as survey_month,
  case o_orderkey % 11 when 0 then '総　数' when 1 then '総 数' when 2 then '総数' when 3 then '不詳'
    when 4 then ' ' || (o_orderkey % 100) else (o_orderkey % 100)::varchar end as age,
  case when o_orderkey % 11 > 3 then (o_orderkey % 100)::integer end as age_years, o_orderkey % 11 < 3 as is_total,
  case o_orderkey % 3 when 0 then '合計' when 1 then '男性' else '女性' end as sex,
  floor(o_totalprice)::bigint as value, '人' as unit,
  'https://example.org/ages.csv' as source_url, 'https://example.org/ages.html' as source_page
from orders
"""


def subtotal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages without the total rows, however these are spaced, summed by sex."""
    mart = marts.by_age(age_rows(spark, sf_dir))
    return (
        mart.filter(~F.col("is_total"))
        .groupBy("sex")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("age_years").isNull()).alias("n_unknown"),
            F.sum("value").alias("people"),
        )
    )


SUBTOTAL_SQL = f"""
select sex, count(*) as n, count(*) filter (where age_years is null) as n_unknown, sum(value)::bigint as people
from ({AGE_MART_SQL}) where not is_total group by sex
"""


def wide_to_long_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly totals of three measures, one row per month and measure."""
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.date_format("l_shipdate", "yyyyMM").alias("year_month"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(cents("l_extendedprice")).alias("price"),
            F.sum(cents("l_tax")).alias("tax"),
        )
    )
    labels = {"quantity": "数量", "price": "価格", "tax": "税"}
    return wide_to_long(wide, ["year_month"], labels, "measure", "total")


WIDE_SQL = """
with wide as (
  select strftime(l_shipdate, '%Y%m') as year_month, sum(l_quantity::bigint)::bigint as "数量",
    sum(round(l_extendedprice * 100)::bigint)::bigint as "価格", sum(round(l_tax * 100)::bigint)::bigint as "税"
  from lineitem group by 1
)
select year_month, measure, total from (unpivot wide on "数量", "価格", "税" into name measure value total)
"""


def fiscal_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month text to ``YYYYMM`` and fiscal year; text without a month has neither."""
    month = clean.year_month(F.col("survey_month"))
    return (
        town_rows(spark, sf_dir)
        .select(month.alias("year_month"), clean.fiscal_year(month).alias("fiscal_year"))
        .groupBy("year_month", "fiscal_year")
        .agg(F.count("*").alias("n"))
    )


FISCAL_SQL = """
select case when o_orderkey % 4 < 3 then strftime(o_orderdate, '%Y%m') end as year_month,
  case when o_orderkey % 4 < 3 then (year(o_orderdate) - (month(o_orderdate) < 4)::int)::integer end as fiscal_year,
  count(*) as n
from orders group by 1, 2
"""


def fiscal_archive_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order month with its fiscal year's archive; of two archives of a year the first on the page counts."""
    orders = table(spark, sf_dir, "orders")
    months = orders.select(F.date_format("o_orderdate", "yyyyMM").alias("year_month")).distinct()
    years = orders.select(clean.fiscal_year(F.date_format("o_orderdate", "yyyyMM")).alias("year"), "o_orderkey")
    links = (
        years.filter(F.col("year") != 1999)
        .groupBy("year", (F.col("o_orderkey") % 2).alias("copy"))
        .agg(F.min("o_orderkey").alias("pos"))
        .select(
            F.lit("towns.html").alias("page"),
            "pos",
            F.concat(text("year"), F.lit("towns.zip")).alias("name"),
            F.concat(F.lit("https://example.org/"), text("copy"), F.lit("/"), text("year"), F.lit("towns.zip")).alias("url"),
        )
    )
    archives = series.archive_listing(links, r"(\d{4})towns\.zip")
    return series.archives_for(months, archives).select("year_month", "fiscal_year", "url")


ARCHIVE_SQL = """
with keyed as (
  select o_orderkey, strftime(o_orderdate, '%Y%m') as year_month,
    year(o_orderdate) - (month(o_orderdate) < 4)::int as fiscal_year
  from orders
), first_key as (
  select fiscal_year, min(o_orderkey) as pos from keyed where fiscal_year <> 1999 group by 1
)
select distinct year_month, k.fiscal_year,
  'https://example.org/' || (f.pos % 2) || '/' || f.fiscal_year || 'towns.zip' as url
from keyed k left join first_key f on f.fiscal_year = k.fiscal_year
"""


def union_same_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists of one shape in one table, tagged by origin."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), cents("c_acctbal").alias("cents")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), cents("s_acctbal").alias("cents")
    )
    united = series.union_tagged({"民間": customers, "学校": suppliers}, "category")
    return united.groupBy("category", "nation").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"), F.max("name").alias("last_name")
    )


UNION_SQL = """
select category, nation, count(*) as n, sum(cents)::bigint as cents, max(name) as last_name from (
  select '民間' as category, c_name as name, c_nationkey as nation, round(c_acctbal * 100)::bigint as cents from customer
  union all
  select '学校', s_name, s_nationkey, round(s_acctbal * 100)::bigint from supplier
) group by 1, 2
"""


def component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Men, women and their stated total per month; the total of every seventh month is off by one."""
    month, sex = F.date_format("o_orderdate", "yyyy-MM"), choose(F.col("o_orderkey"), "男", "女")
    parts = table(spark, sf_dir, "orders").groupBy(month.alias("month"), sex.alias("category")).agg(
        F.sum(cents("o_totalprice")).alias("value")
    )
    wrong = F.substring("month", 6, 2).cast("int") % 7 == 0
    totals = parts.groupBy("month").agg(F.sum("value").alias("value")).select(
        "month", F.lit("計").alias("category"), (F.col("value") + F.when(wrong, 1).otherwise(0)).alias("value")
    )
    return parts.unionByName(totals)


def check_component_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.component_sum(component_rows(spark, sf_dir), ["month"], "category", "value", ["男", "女"], "計")


COMPONENT_SQL = """
select strftime(o_orderdate, '%Y-%m') as month, sum(round(o_totalprice * 100)::bigint)::bigint as parts_sum,
  sum(round(o_totalprice * 100)::bigint)::bigint + 1 as stated_total
from orders where month(o_orderdate) % 7 = 0 group by 1
"""


def check_cross_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered against shipped quantities per month: months that differ, or that one table lacks."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), (F.col("o_orderkey") % 50).alias("value")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_quantity").cast("bigint").alias("value")
    )
    return checks.cross_total(orders, lines, ["month"], "value")


CROSS_SQL = """
with a as (select strftime(o_orderdate, '%Y-%m') as month, sum(o_orderkey % 50)::bigint as left_total from orders group by 1),
b as (select strftime(l_shipdate, '%Y-%m') as month, sum(l_quantity::bigint)::bigint as right_total from lineitem group by 1)
select coalesce(a.month, b.month) as month, left_total, right_total
from a full join b on a.month = b.month where left_total is distinct from right_total
"""


def period_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders outside the last month of each quarter: those last months are the gaps."""
    days = table(spark, sf_dir, "orders").filter(F.month("o_orderdate") % 3 != 0).select(
        F.to_date("o_orderdate").alias("day")
    )
    return checks.period_gaps(days, "day").select(text("day").alias("month"))


GAPS_SQL = """
with m as (select distinct date_trunc('month', o_orderdate)::date as month from orders where month(o_orderdate) % 3 <> 0),
span as (select unnest(generate_series(min(month), max(month), interval 1 month))::date as month from m)
select month::varchar as month from span where month not in (select month from m)
"""

QUERIES = {
    "latest_period_top": latest_period_top,
    "series_trend": series_trend,
    "subtotal_filter": subtotal_filter,
    "wide_to_long": wide_to_long_totals,
    "fiscal_year": fiscal_year,
    "fiscal_archive_join": fiscal_archive_join,
    "union_same_shape": union_same_shape,
    "check_component_sum": check_component_sum,
    "check_cross_total": check_cross_total,
    "period_gaps": period_gaps,
}
SQL = {
    "latest_period_top": LATEST_SQL,
    "series_trend": TREND_SQL,
    "subtotal_filter": SUBTOTAL_SQL,
    "wide_to_long": WIDE_SQL,
    "fiscal_year": FISCAL_SQL,
    "fiscal_archive_join": ARCHIVE_SQL,
    "union_same_shape": UNION_SQL,
    "check_component_sum": COMPONENT_SQL,
    "check_cross_total": CROSS_SQL,
    "period_gaps": GAPS_SQL,
}
