"""Duplicate resolution over ``orders``: a month's orders are its keys, prices their values.

Six months of 1998 hold every row twice. January's copies differ and the evidence names the originals; February's are
identical; March has no evidence; in April the evidence holds a third value for some keys; in May it names the copies;
in June it lacks the smaller orders. Keys are written with full-width letters and values with separators, unlike the evidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions.clean import year_month
from sluicebox.operators import resolve as operators
from sluicebox.queries.common import cents, grouped, table, text

KEY, VALUE = ["town"], ["value"]


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("o_orderdate", "month")
    number = F.when(F.year(month) == 1998, F.month(month))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month.alias("month"), number.alias("nth"), cents("o_totalprice").alias("cents")
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, base = F.col("o_orderkey"), _base(spark, sf_dir)
    copies = F.when(F.col("nth") <= 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = base.withColumn("copy", F.explode(copies))
    changed = F.when((F.col("copy") == 1) & (F.col("nth") != 2), 1).otherwise(0)
    return both.select(
        (key * 2 + F.col("copy")).alias("row_no"),
        F.date_format("month", "yyyy-MM-dd").alias("survey_month"),
        F.concat(F.lit("Ｔ"), text(key)).alias("town"),
        grouped(F.col("cents") + changed).alias("value"),
    )


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nth = F.col("o_orderkey"), F.col("nth")
    true = F.col("cents") + F.when((nth == 4) & (key % 10 == 0), 5).when(nth == 5, 1).otherwise(0)
    held = nth.isNull() | ((nth != 3) & ~((nth == 6) & (F.col("cents") < 5_000_000)))
    return _base(spark, sf_dir).filter(held).select(
        F.date_format("month", "yyyyMM").alias("survey_month"),
        F.concat(F.lit("T"), text(key)).alias("town"),
        text(true).alias("value"),
    )


def _resolution(spark: SparkSession, sf_dir: str) -> operators.Resolution:
    return operators.resolve(
        records(spark, sf_dir),
        lambda _groups: evidence(spark, sf_dir),
        "survey_month",
        KEY,
        VALUE,
        "row_no",
        evidence_group=year_month,
    )


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.duplicate_groups(records(spark, sf_dir), "survey_month", KEY)


def resolve_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution(spark, sf_dir).kept.orderBy(F.col("survey_month").desc())


def resolve_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = operators.summarise(
        _resolution(spark, sf_dir).outcomes, "survey_month", records(spark, sf_dir).count()
    )
    return told.select(
        F.array_join("resolved_months", ",").alias("resolved"),
        F.array_join("unresolved_months", ",").alias("unresolved"),
        "dropped_rows",
        "row_count",
    )


_SETUP = """
with base as (
  select o_orderkey as k, date_trunc('month', o_orderdate)::date as month,
    case when year(o_orderdate) = 1998 then month(o_orderdate) end as nth, round(o_totalprice * 100)::bigint as cents
  from orders
), records as (
  select k * 2 + copy as row_no, month::varchar as survey_month, 'Ｔ' || k as town,
    format('{:,}', cents + case when copy = 1 and nth <> 2 then 1 else 0 end) as value,
    strftime(month, '%Y%m') as ym, 'T' || k as nk,
    (cents + case when copy = 1 and nth <> 2 then 1 else 0 end)::varchar as nv
  from base, (values (0), (1)) c(copy) where copy = 0 or nth <= 6
), evidence as (
  select distinct strftime(month, '%Y%m') as ym, 'T' || k as nk,
    (cents + case when nth = 4 and k % 10 = 0 then 5 when nth = 5 then 1 else 0 end)::varchar as nv
  from base where nth is null or (nth <> 3 and not (nth = 6 and cents < 5000000))
), dup as (
  select survey_month, ym, count(*) as n_rows, count(distinct nk) as n_keys from records group by 1, 2
  having count(*) > count(distinct nk)
), picked as (
  select r.*, row_number() over (partition by r.survey_month, r.nk, r.nv order by row_no) as nth_copy
  from records r join evidence e on e.ym = r.ym and e.nk = r.nk and e.nv = r.nv
  where r.survey_month in (select survey_month from dup)
), counts as (
  select survey_month, count(*) as n_picked, count(distinct nk) as n_picked_keys from picked where nth_copy = 1 group by 1
), facts as (select ym, count(*) as n_evidence from evidence group by 1),
verdict as (
  select d.survey_month, d.n_rows, coalesce(n_picked, 0) as n_picked,
    coalesce(n_picked, 0) > 0 and n_picked = n_picked_keys and n_picked = coalesce(n_evidence, 0) as resolved
  from dup d left join counts c on c.survey_month = d.survey_month left join facts f on f.ym = d.ym
)
"""

QUERIES = {
    "duplicate_groups": duplicate_groups,
    "resolve_duplicates": resolve_duplicates,
    "resolve_outcomes": resolve_outcomes,
}
SQL = {
    "duplicate_groups": _SETUP + "select survey_month, n_rows, n_keys from dup",
    "resolve_duplicates": _SETUP
    + """select row_no, survey_month, town, value from records
      where survey_month not in (select survey_month from verdict where resolved)
      union all
      select row_no, survey_month, town, value from picked
      where nth_copy = 1 and survey_month in (select survey_month from verdict where resolved)""",
    "resolve_outcomes": _SETUP
    + """select coalesce(string_agg(survey_month, ',' order by survey_month) filter (where resolved), '') as resolved,
      coalesce(string_agg(survey_month, ',' order by survey_month) filter (where not resolved), '') as unresolved,
      coalesce(sum(n_rows - n_picked) filter (where resolved), 0)::bigint as dropped_rows,
      (select count(*) from records) - coalesce(sum(n_rows - n_picked) filter (where resolved), 0)::bigint as row_count
      from verdict""",
}
