"""Sharding by a reproducible shuffle: a Feistel permutation over global row numbers.

Rows are numbered by a total order of their key columns, whatever files or partitions they come in. The numbers below
``n`` lie in a grid of about sqrt(n) x sqrt(n) cells; half rounds of a Feistel network move a number along its column and
its row in turn, by an MD5 of the other coordinate. That permutes the whole grid. A number that lands on one of the few
cells beyond ``n`` (at most one row of the grid) walks on along its cycle until it is back below ``n``. The place found
this way gives the shard (place modulo ``shards``) and the slot in it (place div ``shards``): shards differ by one row
at most and slots have no gap. ``row_numbers`` goes the other way, from shard and slot to the row number.

Only the walks of the cells beyond ``n`` are a table, of at most sqrt(n) + 1 rows. Rows move once, in the sort that
numbers them. Rows equal in all key columns are interchangeable; the sort deals them over several tasks, so a third of
all rows under one key is not one task. Null keys come first. An empty table gives no rows. Input columns named
``row_number``, ``shard`` or ``slot`` are replaced. Only DataFrame functions are used.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import raw, table
from sluicebox.session import may_broadcast, settle, spool

SHARDS = 8
SEED = 11
ROUNDS = 8  # half rounds
PLACED = ("row_number", "shard", "slot")


def grid(n: int) -> tuple[int, int]:
    """Rows and columns of the least nearly square grid with ``n`` cells or more."""
    high = isqrt(max(n - 1, 0)) + 1
    return high, max(1, -(-n // high))


def _shift(other: Column, round_no: int, seed: int) -> Column:
    """What a half round adds to one coordinate, from the other one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{round_no}:"), other.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _permuted(rows: DataFrame, name: str, n: int, seed: int, back: bool = False) -> DataFrame:
    """``rows`` with the cell ``name`` replaced by the cell that the network (or its inverse) moves it to.

    Every half round is a projection of its own, so no coordinate is computed twice.
    """
    high, wide = grid(n)
    rows = rows.withColumns({"y": F.expr(f"`{name}` div {wide}"), "x": F.col(name) % wide})
    for round_no in reversed(range(ROUNDS)) if back else range(ROUNDS):
        moved, other, size = ("x", "y", wide) if round_no % 2 else ("y", "x", high)
        shift = _shift(F.col(other), round_no, seed)
        rows = rows.withColumn(moved, F.pmod(F.col(moved) - shift if back else F.col(moved) + shift, F.lit(size)))
    return rows.withColumn(name, F.col("y") * wide + F.col("x")).drop("x", "y")


def _walked(rows: DataFrame, name: str, n: int, seed: int, back: bool = False) -> DataFrame:
    """``rows`` with the number ``name`` below ``n`` replaced by its image below ``n``."""
    high, wide = grid(n)
    rows = _permuted(rows, name, n, seed, back)
    if high * wide == n:
        return rows
    cells = rows.sparkSession.range(n, high * wide).select(F.col("id").alias("beyond"), F.col("id").alias("inside"), F.col("id").alias("from"))
    # Only cells that a number below n is moved to; their cycles lead back below n, others might never.
    walks = _permuted(cells, "from", n, seed, not back).where(F.col("from") < n).drop("from")
    while True:
        step = _permuted(walks.withColumn("next", F.col("inside")), "next", n, seed, back)
        inside = F.when(F.col("inside") >= n, F.col("next")).otherwise(F.col("inside"))
        walks = settle(step.select("beyond", inside.alias("inside")))
        if walks.where(F.col("inside") >= n).isEmpty():
            break
    if may_broadcast(16 * (high * wide - n)):
        walks = F.broadcast(walks)
    joined = rows.join(walks, rows[name] == walks["beyond"], "left")
    return joined.withColumn(name, F.coalesce("inside", name)).drop("beyond", "inside")


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``(row, number)`` for every row, numbered from 0 by the columns ``order``, and how many rows there are."""
    keys = [F.col(f"`{name}`").asc_nulls_first() for name in order]
    salted = rows.withColumn("__salt", F.monotonically_increasing_id()).orderBy(*keys, "__salt").drop("__salt")
    # A sorted table's id is its partition and the place in it, so numbers only need the rows of earlier partitions.
    placed = spool(salted.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")))
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort.
    before = settle(counts.select("part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    n = before.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = placed.join(F.broadcast(before.drop("n")), part == F.col("part"))
    return joined.select("row", (F.col("before") + place).alias("number")), n


def shuffled(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``; all their columns come along."""
    counted, n = numbered(rows, order)
    placed = _walked(counted.withColumn("place", F.col("number")), "place", n, seed)
    kept = [F.col(f"row.`{name}`") for name in rows.columns if name not in PLACED]
    return placed.select(
        *kept,
        F.col("number").alias("row_number"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )


def row_numbers(places: DataFrame, n: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The ``row_number`` that stands at every ``(shard, slot)`` of a table of ``n`` rows; null where there is none."""
    place = F.col("slot").cast("long") * shards + F.col("shard")
    known = F.col("shard").between(0, shards - 1) & (F.col("slot") >= 0) & (place < n)
    cells = places.select("shard", "slot", F.when(known, place).alias("row_number"))
    return _walked(cells, "row_number", n, seed, back=True) if n else cells


def shard_documents(spark, sf_dir) -> DataFrame:
    """Every document's shard and slot, by the law ``rows``."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(raw()).alias("text_crc32"),
    )
    placed = shuffled(sized, ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def _sql_rounds(number: str) -> str:
    """The half rounds as columns that follow from one another; ``g`` holds n, high and wide."""
    columns = [f"{number} // wide as y0", f"{number} % wide as x0"]
    for r in range(ROUNDS):
        moved, other, size = ("x", "y", "wide") if r % 2 else ("y", "x", "high")
        digest = f"('0x' || md5('{SEED}:{r}:' || {other}{r})[1:8])::bigint"
        columns += [f"({moved}{r} + {digest}) % {size} as {moved}{r + 1}", f"{other}{r} as {other}{r + 1}"]
    return ", ".join(columns)


SQL = f"""
with recursive digit as (
  select list(c order by i) as crc from (select i,
    list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
  from range(256) as r(i))),
sized as (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as bytes from documents),
summed as (select doc_id, size, xor(list_reduce(list_transform(bytes, lambda b: ('0x' || b)::bigint),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as text_crc32
  from sized, digit),
counted as (select *, row_number() over (order by doc_id nulls first, size, text_crc32) - 1 as row_number from summed),
side as (select count(*) as n, ceil(sqrt(count(*)))::bigint as high from documents),
g as (select n, high, (n + high - 1) // high as wide from side),
walk as (
  select row_number, y{ROUNDS} * wide + x{ROUNDS} as place from (select row_number, wide, {_sql_rounds("row_number")} from counted, g)
  union all
  select row_number, y{ROUNDS} * wide + x{ROUNDS} as place from (select row_number, wide, {_sql_rounds("place")} from walk, g where place >= n))
select doc_id, size::bigint as size, text_crc32, 'rows' as law, (place % {SHARDS})::int as shard, place // {SHARDS} as slot,
  null::int as grown_shard, row_number
from counted join walk using (row_number), g where place < n
"""
