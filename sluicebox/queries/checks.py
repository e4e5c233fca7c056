"""Data-quality checks that find real violations in the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.functions.clean import lenient_date
from sluicebox.operators import checks
from sluicebox.queries.common import table, text
from sluicebox.queries.timelines import TOWN_SQL, town_rows


def check_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "orders"), "o_custkey")


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = town_rows(spark, sf_dir).withColumn("day", lenient_date(F.col("survey_month")))
    return checks.not_null(cleaned, "day").select("survey_month", "town", "households")


def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


def check_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows with unresolved months; an absent and an empty list both pass."""
    key = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "yyyy-MM-dd")
    log = table(spark, sf_dir, "orders").select(
        text(key).alias("dataset_id"),
        F.when(key % 3 == 0, F.array(month, F.lit("2018-10-01")))
        .when(key % 3 == 1, F.array().cast("array<string>"))
        .alias("unresolved_months"),
    )
    return checks.none_unresolved(log).select(
        "dataset_id", F.array_join("unresolved_months", ",").alias("unresolved_months")
    )


QUERIES = {
    "check_unique_key": check_unique_key,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_accepted_values": check_accepted_values,
    "check_unresolved": check_unresolved,
}
SQL = {
    "check_unique_key": """select l_orderkey, l_linenumber, count(*) as n from lineitem
      group by 1, 2 having count(*) > 1""",
    "check_unique": "select o_custkey, count(*) as n from orders where o_custkey is not null group by 1 having count(*) > 1",
    "check_not_null": f"""select survey_month, town, households from ({TOWN_SQL})
      where coalesce(try_cast(survey_month as date), try_strptime(survey_month, '%Y/%m/%d')::date,
        try_strptime(survey_month, '%Y.%m.%d')::date) is null""",
    "check_accepted_values": """select o_orderpriority, count(*) as n from orders
      where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""",
    "check_unresolved": """select o_orderkey::varchar as dataset_id,
      strftime(o_orderdate, '%Y-%m-%d') || ',2018-10-01' as unresolved_months from orders where o_orderkey % 3 = 0""",
}
