"""Landed files, written from the driver tables and read back: CSV, ZIP, NDJSON and HTML."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from sluicebox import catalog
from sluicebox.functions.batches import by_parts
from sluicebox.functions.clean import count_number, fiscal_year
from sluicebox.functions.text import strip
from sluicebox.operators import headers
from sluicebox.operators.checks import every_file_ingested
from sluicebox.operators.evidence import column_evidence, headerless_evidence, is_whole_number, wide_evidence
from sluicebox.operators.series import append_all, union_tagged, with_provenance
from sluicebox.plans.ingest import list_text
from sluicebox.queries.common import cents, choose, grouped, table, text
from sluicebox.session import scratch_path, spool
from sluicebox.sources.archives import archive_members
from sluicebox.sources.csvfiles import csv_chunks, csv_rows, decode_files
from sluicebox.sources.ndjson import read_ndjson, write_ndjson
from sluicebox.sources.pages import page_links, pick_link

# ---- CSV ----------------------------------------------------------------------------------------------------------


@F.arrow_udf(BinaryType())
def _encode(lines: pa.Array, encodings: pa.Array) -> pa.Array:
    return by_parts(lambda *held: [line.encode(encoding) for line, encoding in zip(*held)], pa.binary(), lines, encodings)


def _write_encoded(lines: DataFrame, path: str, encoding: str, mark: str = "") -> None:
    """Write text in an encoding the text sink does not know; each task's file starts with ``mark``."""
    first_in_task = F.monotonically_increasing_id() % (1 << 33) == 0
    marked = F.when(first_in_task, F.concat(F.lit(mark), "line")).otherwise(F.col("line"))
    separator = "UTF-16LE" if encoding == "utf-16-le" else "UTF-8"
    lines.select(_encode(marked, F.lit(encoding)).cast("string").alias("value")).write.option(
        "encoding", separator
    ).option("lineSep", "\n").text(path)


def landed_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files of four encodings, with quoted commas and line breaks, read without being told which."""
    root = scratch_path(spark, "landed")
    key = F.col("c_custkey")
    note = F.when(key % 7 == 0, '"a\nb"').otherwise('"a,b"')
    lines = table(spark, sf_dir, "customer").select(
        key, F.concat_ws(",", F.lit("顧客"), text(key), "c_name", text(cents("c_acctbal")), note).alias("line")
    )
    for n, (encoding, mark) in enumerate([("utf-8", ""), ("utf-8", "﻿"), ("utf-16-le", "﻿"), ("cp932", "")]):
        _write_encoded(lines.filter(key % 4 == n), f"{root}/{n}", encoding, mark)
    rows = csv_rows(csv_chunks(spark, root, "*.txt"))

    def cell(n: int) -> Column:
        return F.try_element_at("cells", F.lit(n))

    return rows.groupBy("encoding").agg(
        F.count("*").alias("n_rows"),
        F.count_if(cell(1) == "顧客").alias("n_labels"),
        F.sum(cell(2).cast("bigint")).alias("keys"),
        F.sum(cell(4).cast("bigint")).alias("cents"),
        F.count_if(cell(5) == "ab").alias("n_joined"),
        F.count_if(cell(5) == "a,b").alias("n_commas"),
    )


LANDED_SQL = """
select case c_custkey % 4 when 2 then 'utf-16' when 3 then 'cp932' else 'utf-8-sig' end as encoding,
  count(*) as n_rows, count(*) as n_labels, sum(c_custkey)::bigint as keys,
  sum(round(c_acctbal * 100)::bigint)::bigint as cents,
  count(*) filter (where c_custkey % 7 = 0) as n_joined, count(*) filter (where c_custkey % 7 <> 0) as n_commas
from customer group by 1
"""


def land_csv(rows: DataFrame) -> DataFrame:
    """``(file, header, encoding, cells)`` as landed files ``(path, content)``.

    Every batch of rows makes its own part of each file, so a large file is many parts below its name.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(batches):
            parts: dict[tuple[str, str, str], list[list[str]]] = {}
            for row in batch.to_pylist():
                parts.setdefault((row["file"], row["header"], row["encoding"]), []).append(row["cells"])
            out: dict[str, list] = {"path": [], "content": []}
            for (file, header, encoding), cells in parts.items():
                body = io.StringIO()
                body.write(header)
                csv.writer(body, lineterminator="\n").writerows(cells)
                out["path"].append(f"{file}/{task}-{n}.csv")
                out["content"].append(body.getvalue().encode(encoding))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))

    return spool(rows.select("file", "header", "encoding", "cells").mapInArrow(pack, "path string, content binary"))


COLUMNS = {
    "name": ("名称",),
    "address": ("所在地_連結表記", "住所"),
    "postal_code": ("郵便番号",),
    "building_name": ("建物名等(方書)",),
}


LONG_BYTES = 64 * 1024
BREAKS = "[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def long_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as quoted cells over many lines, in long files of four encodings, read by split.

    One row per document: what was read of its text, whose line breaks go.
    """
    root = scratch_path(spark, "long")
    key, body = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    plain = F.regexp_replace(body, r"[^\x00-\x7F]", "字")
    cell = F.concat(F.lit('"'), F.replace(F.when(key % 4 == 3, plain).otherwise(body), F.lit('"'), F.lit('""')), F.lit('"'))
    lines = table(spark, sf_dir, "documents").select(key, F.concat_ws(",", F.lit("文書"), text(key), cell, F.lit("x")).alias("line"))
    for n, (encoding, mark) in enumerate([("utf-8", ""), ("utf-8", "\ufeff"), ("utf-16-le", "\ufeff"), ("cp932", "")]):
        _write_encoded(lines.filter(key % 4 == n), f"{root}/{n}", encoding, mark)
    rows = csv_rows(csv_chunks(spark, root, "*.txt", whole_file_bytes=LONG_BYTES))
    cells = [F.try_element_at("cells", F.lit(n)) for n in (1, 2, 3, 4)]
    return rows.select(
        cells[1].cast("bigint").alias("doc_id"),
        "encoding",
        cells[0].alias("label"),
        F.char_length(cells[2]).alias("n_chars"),
        F.md5(cells[2].cast("binary")).alias("text_md5"),
        cells[3].alias("behind"),
    )


LONG_SQL = f"""
with d as (select doc_id, regexp_replace(case when doc_id % 4 = 3 then regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', '字', 'g')
    else coalesce(text, '') end, '{BREAKS}', '', 'g') as read from documents)
select doc_id, case doc_id % 4 when 2 then 'utf-16' when 3 then 'cp932' else 'utf-8-sig' end as encoding, '文書' as label,
  length(read) as n_chars, md5(read) as text_md5, 'x' as behind
from d
"""


def header_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in three file layouts: a losing alias, reordered and repeated headers, a title above the header."""
    key = F.col("c_custkey")
    address = F.concat(F.lit("住所"), text("c_nationkey"))
    number, cash = text(key), text(cents("c_acctbal"))
    layouts = [
        ("名称,所在地_連結表記,住所,残高\n", F.array("c_name", address, F.lit("別"), cash)),
        ("備考, 住所 ,名称,備考\n", F.array(number, address, "c_name", F.when(key % 2 == 0, cash).otherwise(""))),
        (
            "顧客一覧,,\n名称,建物名等（方書）,,所在地_連結表記,〒\n",
            F.array("c_name", F.when(key % 5 == 0, " ").otherwise(number), F.lit("無題"), address, F.lit("")),
        ),
    ]
    header = cells = F.lit(None)
    for n, (title, row) in enumerate(layouts):
        header = F.when(F.col("c_nationkey") % 3 == n, title).otherwise(header)
        cells = F.when(F.col("c_nationkey") % 3 == n, row).otherwise(cells)
    landed = land_csv(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("layout"), text(F.col("c_nationkey") % 3)).alias("file"),
            header.alias("header"),
            F.when(F.col("c_nationkey") % 2 == 0, "cp932").otherwise("utf-8").alias("encoding"),
            cells.alias("cells"),
        )
    )
    mapped = headers.map_headers(decode_files(landed), COLUMNS, ("name", "address"))
    rows = headers.mapped_rows(mapped, list(COLUMNS), "name", keep=("encoding",))
    return rows.select(
        "encoding", "name", "address", "postal_code", "building_name", F.to_json("_extras").alias("extras")
    )


HEADER_SQL = """
with c as (select *, c_nationkey % 3 as layout, round(c_acctbal * 100)::bigint as cents from customer)
select case when c_nationkey % 2 = 0 then 'cp932' else 'utf-8-sig' end as encoding, c_name as name,
  '住所' || c_nationkey as address, null::varchar as postal_code,
  case when layout = 2 and c_custkey % 5 <> 0 then c_custkey::varchar end as building_name,
  case layout when 0 then '{"住所":"別","残高":"' || cents || '"}'
    when 1 then '{"備考":"' || case when c_custkey % 2 = 0 then cents else c_custkey end || '"}' end as extras
from c
"""


def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which required columns the files of each layout lack, and how many rows that costs."""
    kind = F.col("c_custkey") % 4
    header = F.when(kind == 0, "名称,住所\n").when(kind == 1, "名称,郵便番号\n").when(kind == 2, "住所,郵便番号\n")
    landed = land_csv(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("kind"), text(kind)).alias("file"),
            header.otherwise("郵便番号,建物名等(方書)\n").alias("header"),
            F.lit("utf-8").alias("encoding"),
            F.array("c_name", text("c_custkey")).alias("cells"),
        )
    )
    mapped = headers.map_headers(decode_files(landed), COLUMNS, ("name", "address"))
    return (
        mapped.groupBy(F.substring_index("path", "/", 1).alias("file"), F.array_join("missing", ",").alias("missing"))
        .agg((F.sum(F.size("rows")) - F.count_if(F.col("first_row") == 0)).alias("n_rows"))
        .filter(F.col("missing") != "")
    )


REQUIRED_SQL = """
select 'kind' || (c_custkey % 4) as file,
  case c_custkey % 4 when 1 then 'address' when 2 then 'name' else 'name,address' end as missing, count(*) as n_rows
from customer where c_custkey % 4 <> 0 group by 1, 2
"""


def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank, short, nameless and non-numeric rows removed; the others keep their whole text."""
    key = F.col("doc_id")
    name = F.when(key % 7 == 3, " ").otherwise(F.col("source"))
    number = F.when(key % 5 == 2, "約").otherwise(grouped(F.col("n_chars")))
    cells = F.when(key % 11 == 0, F.array(F.lit(""), F.lit("　"), F.lit(""))).when(
        key % 11 == 1, F.array(name, "text")
    )
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", cells.otherwise(F.array(name, "text", number)).alias("cells")
    )
    kept = rows.filter(
        headers.long_enough(F.col("cells"), [F.lit(3)])
        & headers.has_text(F.col("cells"))
        & (strip(F.get("cells", F.lit(0))) != "")
    )
    value = F.translate(F.get("cells", F.lit(2)), ",", "")
    return (
        kept.filter(is_whole_number(value))
        .groupBy("lang")
        .agg(
            F.count("*").alias("n"),
            F.sum(value.cast("bigint")).alias("n_chars"),
            F.sum(F.char_length(F.get("cells", F.lit(1)))).alias("text_length"),
        )
    )


FILTERS_SQL = """
select lang, count(*) as n, sum(n_chars)::bigint as n_chars, sum(length(text))::bigint as text_length from documents
where doc_id % 11 not in (0, 1) and doc_id % 7 <> 3 and doc_id % 5 <> 2 and trim(source) <> '' group by 1
"""


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per day of events: good, without an address column, without a header, or with one column more.

    One log row per day, and whether the publication check would refuse it.
    """
    day = F.date_format("ts", "yyyy-MM-dd")
    kind = F.dayofmonth("ts") % 4
    header = F.when(kind == 1, "名称,メモ,郵便番号\n").when(kind == 2, "1,2,3\n").when(kind == 3, "名称,住所,メモ\n")
    landed = land_csv(
        table(spark, sf_dir, "events").select(
            day.alias("file"),
            header.otherwise("名称,住所,郵便番号\n").alias("header"),
            F.when(kind == 3, "cp932").otherwise("utf-8").alias("encoding"),
            F.array(
                F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("event_type")), text("user_id"), text("event_id")
            ).alias("cells"),
        )
    )
    chunks = decode_files(landed).withColumn("dataset_id", F.substring_index("path", "/", 1))
    mapped = spool(headers.map_headers(chunks, COLUMNS, catalog.REQUIRED_COLUMNS))
    rows = headers.mapped_rows(mapped, list(COLUMNS), "name", keep=("dataset_id",))
    counts = rows.groupBy("dataset_id").agg(F.count("*").alias("row_count"))
    reason = F.when(F.col("header").isNull(), F.lit("header_mismatch")).when(
        F.size("missing") > 0, F.concat(F.lit("required_columns_missing: "), list_text(F.col("missing")))
    )
    files = mapped.groupBy("dataset_id").agg(F.max(reason).alias("reason"), F.max("encoding").alias("encoding"))
    log = files.join(counts, "dataset_id", "left").select(
        F.lit("bosai").alias("schema_name"),
        "dataset_id",
        F.lit("イベント").alias("dataset_title"),
        F.when(F.col("reason").isNull(), "ok").otherwise("skipped").alias("status"),
        "reason",
        "encoding",
        "row_count",
    )
    refused = every_file_ingested(log).select("dataset_id", F.lit(True).alias("refused"))
    return log.join(refused, "dataset_id", "left").select(
        "dataset_id", "status", "reason", "encoding", "row_count", F.coalesce("refused", F.lit(False)).alias("refused")
    )


OUTCOMES_SQL = """
with d as (select strftime(ts, '%Y-%m-%d') as dataset_id, day(ts) % 4 as kind,
    count(*) filter (where event_id % 10 <> 0) as n from events group by 1, 2)
select dataset_id, case when kind in (1, 2) then 'skipped' else 'ok' end as status,
  case kind when 1 then 'required_columns_missing: [''address'']' when 2 then 'header_mismatch' end as reason,
  case kind when 3 then 'cp932' else 'utf-8-sig' end as encoding,
  case when kind in (0, 3) then n end as row_count, kind in (1, 2) as refused
from d
"""

# ---- ZIP ----------------------------------------------------------------------------------------------------------


def _land_archives(orders: DataFrame, head: tuple[str, ...] = ()) -> DataFrame:
    """Yearly archives of monthly CP932 files; every batch of rows makes its own archive of each year."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(batches):
            years: dict[int, dict[str, list[str]]] = {}
            for row in batch.to_pylist():
                years.setdefault(row["fiscal_year"], {}).setdefault(row["year_month"], []).append(row["line"])
            out: dict[str, list] = {"path": [], "content": []}
            for year, months in years.items():
                blob = io.BytesIO()
                with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("readme.txt", "説明")
                    for month, lines in months.items():
                        body = "\r\n".join([*head, *lines, "注記,,この表は…,"])
                        archive.writestr(f"{year}/{month}towns.csv", body.encode("cp932"))
                        archive.writestr(f"old/{month}towns.csv", "後,計,1,[人]".encode("cp932"))
                out["path"].append(f"{year}/{task}-{n}.zip")
                out["content"].append(blob.getvalue())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))

    return spool(orders.mapInArrow(pack, "path string, content binary"))


def _monthly_lines(spark: SparkSession, sf_dir: str, line: Column) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    return table(spark, sf_dir, "orders").select(
        fiscal_year(month).alias("fiscal_year"), month.alias("year_month"), line.alias("line")
    )


def archive_member_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly evidence totals read from yearly archives; a second member of a month and a broken archive give none."""
    line = F.concat(
        F.lit("注文"), text("o_orderkey"), F.lit(",計,\""), grouped(F.floor("o_totalprice")), F.lit("\",[人]")
    )
    landed = _land_archives(_monthly_lines(spark, sf_dir, line))
    broken = landed.select(F.concat("path", F.lit(".html")).alias("path"), F.lit(b"<html>busy</html>").alias("content"))
    members = archive_members(landed.unionByName(broken), r"(\d{6})towns\.csv")
    return (
        headerless_evidence(members)
        .groupBy("year_month")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("value").cast("bigint")).alias("total"),
            F.min("item").alias("first_item"),
        )
    )


ARCHIVE_SQL = """
select strftime(o_orderdate, '%Y%m') as year_month, count(*) as n, sum(floor(o_totalprice)::bigint)::bigint as total,
  min('注文' || o_orderkey) as first_item
from orders group by 1
"""


def town_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of the town layout: a title above the header, full-width letters, thousands separators."""
    key, amount = F.col("o_orderkey"), F.floor("o_totalprice")
    numbers = [F.concat(F.lit('"'), grouped(n), F.lit('"')) for n in (amount, amount % 1000, amount % 77)]
    line = F.concat_ws(",", F.concat(F.lit("Ｔ "), text(key)), *numbers, text(key % 10))
    head = ("町丁目別一覧,,,,", "町丁目,世帯数[世帯],人口（男）[人],人口（女）[人],計[人]")
    members = archive_members(_land_archives(_monthly_lines(spark, sf_dir, line), head), r"(\d{6})towns\.csv")
    facts = column_evidence(members)
    sums = [F.sum(F.col(name).cast("bigint")).alias(name) for name in ("households", "male", "female", "total")]
    return facts.groupBy("year_month").agg(F.count("*").alias("n"), F.min("town").alias("first_town"), *sums)


TOWN_EVIDENCE_SQL = """
select strftime(o_orderdate, '%Y%m') as year_month, count(*) as n, min('T' || o_orderkey) as first_town,
  sum(floor(o_totalprice)::bigint)::bigint as households, sum(floor(o_totalprice)::bigint % 1000)::bigint as male,
  sum(floor(o_totalprice)::bigint % 77)::bigint as female, sum(o_orderkey % 10)::bigint as total
from orders group by 1
"""


def age_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of the wide age layout, one row per age and sex."""
    key, amount = F.col("o_orderkey"), F.floor("o_totalprice")
    line = F.concat_ws(",", F.concat(text(key), F.lit("　")), text(amount), text(amount % 1000), text(amount % 77), F.lit("x"))
    head = ("年齢[歳],合　計[人],男性合計[人],女性合計[人],備考",)
    members = archive_members(_land_archives(_monthly_lines(spark, sf_dir, line), head), r"(\d{6})towns\.csv")
    facts = wide_evidence(members).filter(is_whole_number(F.col("value")))
    return facts.groupBy("year_month", "sex").agg(
        F.count("*").alias("n"), F.min("age").alias("first_age"), F.sum(F.col("value").cast("bigint")).alias("value")
    )


AGE_EVIDENCE_SQL = """
with w as (select strftime(o_orderdate, '%Y%m') as year_month, o_orderkey::varchar as age,
    floor(o_totalprice)::bigint as a from orders)
select year_month, sex, count(*) as n, min(age) as first_age, sum(value)::bigint as value from (
  select year_month, age, '合計' as sex, a as value from w
  union all select year_month, age, '男性', a % 1000 from w
  union all select year_month, age, '女性', a % 77 from w
) group by 1, 2
"""

# ---- NDJSON -------------------------------------------------------------------------------------------------------


def ndjson_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as NDJSON with absent and undeclared keys, read with a declared schema."""
    path = scratch_path(spark, "orders")
    key = F.col("o_orderkey")
    written = table(spark, sf_dir, "orders").select(
        text(key).alias("order"),
        F.col("o_orderstatus").alias("status"),
        grouped(cents("o_totalprice")).alias("value"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        F.lit("x").alias("undeclared"),
    )
    write_ndjson(written, path)
    schema = "order string, status string, value string, priority string, never_there string"
    return (
        read_ndjson(spark, path, schema)
        .groupBy("status")
        .agg(
            F.count("*").alias("n"),
            F.sum(count_number(F.col("value"))).alias("cents"),
            F.count("priority").alias("n_priority"),
            F.count("never_there").alias("n_never"),
        )
    )


TYPED_SQL = """
select o_orderstatus as status, count(*) as n, sum(round(o_totalprice * 100)::bigint)::bigint as cents,
  count(*) filter (where o_orderkey % 5 <> 0) as n_priority, 0::bigint as n_never
from orders group by 1
"""


def empty_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that came out empty has typed rows, none of them, and still appears in the counts."""
    orders = table(spark, sf_dir, "orders").select(text("o_orderkey").alias("order"), "o_orderstatus")
    full, empty = scratch_path(spark, "full"), scratch_path(spark, "empty")
    write_ndjson(orders, full)
    write_ndjson(orders.filter(F.col("o_orderstatus") == "no such status"), empty)
    sources = {"full": full, "empty": empty}
    counts = {
        name: read_ndjson(spark, path, "order string, o_orderstatus string").agg(
            F.count("*").alias("n"), F.max("order").alias("last_order")
        )
        for name, path in sources.items()
    }
    return union_tagged(counts, "source")


EMPTY_SQL = """
select 'full' as source, count(*) as n, max(o_orderkey::varchar) as last_order from orders
union all select 'empty', 0, null
"""


def ndjson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with provenance written as one dataset per event type and read back."""
    path = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset_id"), text("event_id").alias("event"), cents("value").alias("cents"), "props"
    )
    tagged = with_provenance(
        events,
        source_title="イベント",
        source_url=F.concat(F.lit("https://example.org/"), "dataset_id", F.lit(".csv")),
        source_page="https://example.org/events.html",
        fetched_at="2026-01-01T00:00:00+00:00",
    )
    write_ndjson(tagged.withColumn("props", F.from_json("props", "k bigint")), path, by="dataset_id")
    schema = "event string, cents bigint, props string, dataset_id string, _source_title string, _source_url string"
    back = read_ndjson(spark, path, schema)
    return back.groupBy("dataset_id", "_source_title", "_source_url").agg(
        F.count("*").alias("n"),
        F.sum("cents").alias("cents"),
        F.sum(F.from_json("props", "k bigint").getField("k")).alias("k"),
        F.max("event").alias("last_event"),
    )


ROUND_SQL = """
select event_type as dataset_id, 'イベント' as _source_title, 'https://example.org/' || event_type || '.csv' as _source_url,
  count(*) as n, sum(round(value * 100)::bigint)::bigint as cents, sum((props->>'k')::bigint)::bigint as k,
  max(event_id::varchar) as last_event
from events group by 1
"""

# ---- HTML ---------------------------------------------------------------------------------------------------------


def page_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    links = page_links(pages, page="page_id", extensions=None)
    return links.select(F.col("page").alias("page_id"), "pos", "url", "name", "label")


_LINK = r"""(?is)<a\s[^>]*href="([^"]+)"[^>]*>(.*?)</a>"""
_LINKS_SQL = f"""
with found as (
  select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as site,
    regexp_extract_all(html, '{_LINK}', 1) as hrefs, regexp_extract_all(html, '{_LINK}', 2) as labels from pages
), one as (
  select page_id, site || unnest(hrefs) as url, unnest(labels) as label, unnest(range(len(hrefs))) as pos from found
), firsts as (
  select *, row_number() over (partition by page_id, url order by pos) as nth from one
), links as (
  select page_id, pos::int as pos, url, string_split(url, '/')[-1] as name,
    trim(regexp_replace(regexp_replace(label, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) as label
  from firsts where nth = 1
)
"""


PICKED = "[a-z]{3,5}"


def page_link_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first link of each page whose whole name is three to five plain letters."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    picked = pick_link(page_links(pages, page="page_id", extensions=None), PICKED)
    return picked.select(F.col("page").alias("page_id"), "pos", "url", "name")


QUERIES = {
    "landed_csv_ingest": landed_csv_ingest,
    "long_csv_ingest": long_csv_ingest,
    "header_mapping": header_mapping,
    "required_columns": required_columns,
    "row_filters": row_filters,
    "ingest_outcomes": ingest_outcomes,
    "archive_member_scan": archive_member_scan,
    "town_evidence": town_evidence,
    "age_evidence": age_evidence,
    "ndjson_typed_scan": ndjson_typed_scan,
    "empty_source_scan": empty_source_scan,
    "ndjson_round_trip": ndjson_round_trip,
    "page_link_extract": page_link_extract,
    "page_link_pick": page_link_pick,
}
SQL = {
    "landed_csv_ingest": LANDED_SQL,
    "long_csv_ingest": LONG_SQL,
    "header_mapping": HEADER_SQL,
    "required_columns": REQUIRED_SQL,
    "row_filters": FILTERS_SQL,
    "ingest_outcomes": OUTCOMES_SQL,
    "archive_member_scan": ARCHIVE_SQL,
    "town_evidence": TOWN_EVIDENCE_SQL,
    "age_evidence": AGE_EVIDENCE_SQL,
    "ndjson_typed_scan": TYPED_SQL,
    "empty_source_scan": EMPTY_SQL,
    "ndjson_round_trip": ROUND_SQL,
    "page_link_extract": _LINKS_SQL + "select page_id, pos, url, name, label from links",
    "page_link_pick": _LINKS_SQL
    + f"""select page_id, pos, url, name from links where regexp_full_match(name, '{PICKED}')
      qualify row_number() over (partition by page_id order by pos) = 1""",
}
