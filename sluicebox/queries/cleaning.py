"""Lenient typed cleaning of text derived from keys and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions import clean
from sluicebox.functions import text as forms
from sluicebox.queries.common import choose, grouped, table, text


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    written = choose(
        key,
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy/M/d"),
        F.date_format(day, "yyyy.M.d"),
        F.date_format(day, "yyyy-MM"),
        "令和8年4月",
        "",
        F.date_format(day, "yyyy-M-d"),
    )
    raw = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    return raw.withColumn("day", text(clean.lenient_date(F.col("written"))))


# The day itself, where its spelling is one that is read.
DATES_SQL = """
select o_orderkey, case o_orderkey % 7
    when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y/%-m/%-d')
    when 2 then strftime(o_orderdate, '%Y.%-m.%-d') when 3 then strftime(o_orderdate, '%Y-%m')
    when 4 then '令和8年4月' when 5 then '' else strftime(o_orderdate, '%Y-%-m-%-d') end as written,
  case when o_orderkey % 7 in (0, 1, 2, 6) then strftime(o_orderdate, '%Y-%m-%d') end as day
from orders
"""


def clean_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ("1", "○", "〇", "有", "0", "×", "無", "", "要確認", None)
    marked = table(spark, sf_dir, "orders").select(
        choose(F.col("o_orderkey"), *words).alias("for_flood"), choose(F.col("o_custkey"), *words).alias("for_tsunami")
    )
    return marked.withColumns(clean.flags(["for_flood", "for_tsunami"])).groupBy("for_flood", "for_tsunami").agg(
        F.count("*").alias("n")
    )


_FLAG_CASE = """case {c} % 10 when 0 then '1' when 1 then '○' when 2 then '〇' when 3 then '有' when 4 then '0'
  when 5 then '×' when 6 then '無' when 7 then '' when 8 then '要確認' end"""
_FLAG = "case when {c} in ('1', '○', '〇', '有') then true when {c} in ('0', '×', '無') then false end"
FLAGS_SQL = f"""
with m as (select {_FLAG_CASE.format(c="o_orderkey")} as a, {_FLAG_CASE.format(c="o_custkey")} as b from orders)
select {_FLAG.format(c="a")} as for_flood, {_FLAG.format(c="b")} as for_tsunami, count(*) as n from m group by 1, 2
"""


def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    number = F.floor("l_extendedprice")
    counted = choose(
        key, grouped(number), text(number), F.concat(text(number), F.lit(".5")), "-", "", "1e19", "1e30", "-1e30"
    )
    degrees = choose(
        key,
        F.concat(text(key % 90), F.lit("."), F.lpad(text(key % 100), 2, "0")),
        F.concat(text(key % 90), F.lit("d")),
        "1e2",
        "北緯35度",
    )
    digits = F.substring(F.lit(clean.WIDE_DIGITS), (key % 10 + 1).cast("int"), F.lit(1))
    raw = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        counted.alias("counted"),
        degrees.alias("degrees"),
        F.when(key % 6 == 0, "丁目").otherwise(F.concat(digits, digits)).alias("chome"),
        F.concat(F.lit(" "), text(key % 100), F.lit("　")).alias("age"),
        choose(key, "", "x", None).alias("named"),
    )
    cleaned = raw.select(
        "l_returnflag",
        clean.count_number(F.col("counted")).alias("counted"),
        clean.real_number(F.col("degrees")).alias("degrees"),
        clean.wide_number(F.col("chome")).alias("chome"),
        clean.spaced_number(F.col("age")).alias("age"),
        clean.blank_to_null(F.col("named")).alias("named"),
    )
    return cleaned.groupBy("l_returnflag", "chome").agg(
        F.count("*").alias("n"),
        F.sum("counted").alias("counted"),
        F.count("degrees").alias("n_degrees"),
        F.max("degrees").alias("max_degrees"),
        F.sum("age").alias("ages"),
        F.count("named").alias("n_named"),
    )


# What each spelling is worth, from the numbers it was made of.
NUMBERS_SQL = """
with k as (select l_returnflag, l_orderkey * 7 + l_linenumber as k, floor(l_extendedprice)::bigint as v from lineitem)
select l_returnflag, case when k % 6 <> 0 then ((k % 10) * 11)::integer end as chome, count(*) as n,
  sum(case when k % 8 < 2 then v when k % 8 = 2 then v + 1 end)::bigint as counted,
  count(*) filter (where k % 4 in (0, 2)) as n_degrees,
  max(case k % 4 when 0 then (k % 90) + (k % 100) / 100.0::double when 2 then 100 end) as max_degrees,
  sum(k % 100)::bigint as ages, count(*) filter (where k % 3 = 1) as n_named
from k group by 1, 2
"""


def clean_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    written = choose(
        key,
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+00:00"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+09:00"),
        F.date_format("ts", "yyyy-MM-dd"),
        "昨日",
    )
    raw = table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    cleaned = clean.lenient_timestamp(F.col("written"))
    return raw.select("event_id", F.date_format(cleaned, "yyyy-MM-dd HH:mm:ss").alias("fetched_at"))


TIMESTAMPS_SQL = """
with w as (select event_id, case event_id % 5
    when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S')
    when 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' when 3 then strftime(ts, '%Y-%m-%d')
    else '昨日' end as written from events)
select event_id, strftime(try_cast(written as timestamp), '%Y-%m-%d %H:%M:%S') as fetched_at from w
"""


def complete_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    street = F.concat(text(key % 9 + 1), F.lit("-"), text(key))
    address = choose(
        key,
        F.concat(F.lit("旭町"), street),
        F.concat(F.lit("中央区本町"), street),
        F.concat(F.lit("東京都中央区本町"), street),
        F.concat(F.lit("山梨県北杜市"), street),
        F.concat(F.lit("　京都府京都市"), street, F.lit(" ")),
    )
    raw = table(spark, sf_dir, "customer").select("c_custkey", address.alias("address"))
    return raw.withColumn("query", clean.complete_address(F.col("address"), "東京都", "中央区"))


ADDRESS_SQL = f"""
with s as (select c_custkey, (c_custkey % 9 + 1) || '-' || c_custkey as street from customer),
a as (select c_custkey, case c_custkey % 5 when 0 then '旭町' || street when 1 then '中央区本町' || street
  when 2 then '東京都中央区本町' || street when 3 then '山梨県北杜市' || street
  else '　京都府京都市' || street || ' ' end as address from s)
select c_custkey, address, case
  when regexp_matches(trim(address), '^({"|".join(clean.PREFECTURES)})') then trim(address)
  when starts_with(trim(address), '中央区') then '東京都' || trim(address)
  else '東京都中央区' || trim(address) end as query from a
"""


def _form_digests(documents: DataFrame, written: Column) -> DataFrame:
    return documents.select(
        "doc_id",
        F.md5(forms.header_form(written)).alias("header_md5"),
        F.md5(forms.value_form(written)).alias("value_md5"),
        F.md5(forms.query_form(written)).alias("query_md5"),
    )


def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal forms of every whole document."""
    return _form_digests(table(spark, sf_dir, "documents"), F.col("text"))


def normalise_wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal forms of every whole document written in full width, between brackets, or before half-width kana."""
    body, key = F.coalesce("text", F.lit("")), F.col("doc_id")
    narrow = "".join(map(chr, range(0x21, 0x7F)))
    written = choose(
        key,
        F.translate(body, " " + narrow, "\u3000" + "".join(chr(ord(c) + 0xFEE0) for c in narrow)),
        F.concat(F.lit("㈱㍿①Ⅳ "), body, F.lit("\u3000㌔ﬁ…")),
        F.concat(F.lit("(ﾊﾞｽ ﾃﾞﾎﾟ)"), body, F.lit("㎡ｱﾞ")),
    )
    return _form_digests(table(spark, sf_dir, "documents"), written)


# White space as a pattern of this SQL.
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _forms_sql(normal: str, bare: str) -> str:
    """Digests of the forms of ``normal``; ``bare`` is what a header leaves of it."""
    return f"""
select doc_id, md5(regexp_replace({bare}, '{_SPACE}', '', 'g')) as header_md5,
  md5(coalesce(replace(regexp_replace({normal}, '{_SPACE}', '', 'g'), ',', ''), '')) as value_md5,
  md5(trim(regexp_replace({normal}, '{_SPACE}', ' ', 'g'))) as query_md5
from s
"""


_UNQUOTED = f"""trim(trim(regexp_replace(replace(whole, chr(65279), ''), '^{_SPACE}|{_SPACE}$', '', 'g'), '"'), '''')"""
# The documents hold no compatibility characters, so that composition is all there is to do.
NORMAL_SQL = f"with s as (select doc_id, nfc_normalize(text) as whole from documents) {_forms_sql('whole', _UNQUOTED)}"
# What was written wide or short, as it reads in full; quotes inside wide marks or other text are no quotes of a header.
WIDE_SQL = f"""
with d as (select doc_id, nfc_normalize(coalesce(text, '')) as body from documents),
s as (select doc_id, case doc_id % 3 when 0 then body
  when 1 then '(株)株式会社1IV ' || body || ' キロfi...' else '(バス デポ)' || body || 'm2ア' || chr(12441) end as whole from d)
{_forms_sql('whole', "replace(whole, chr(65279), '')")}
"""


QUERIES = {
    "clean_dates": clean_dates,
    "clean_flags": clean_flags,
    "clean_numbers": clean_numbers,
    "clean_timestamps": clean_timestamps,
    "complete_address": complete_address,
    "normalise_text": normalise_text,
    "normalise_wide_text": normalise_wide_text,
}
SQL = {
    "clean_dates": DATES_SQL,
    "clean_flags": FLAGS_SQL,
    "clean_numbers": NUMBERS_SQL,
    "clean_timestamps": TIMESTAMPS_SQL,
    "complete_address": ADDRESS_SQL,
    "normalise_text": NORMAL_SQL,
    "normalise_wide_text": WIDE_SQL,
}
