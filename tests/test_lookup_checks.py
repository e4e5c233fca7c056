"""Address lookup, data-quality checks and publication."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sluicebox.functions import geo
from sluicebox.operators import audit, checks, lookup, series
from sluicebox.operators.audit import Key, Rules
from sluicebox.plans import publish as publication


def addresses(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "address string")


def cached(spark, *texts, level="residential_block"):
    return spark.createDataFrame(
        [(t, 35.7, 139.6, level) for t in texts], "address string, geo_lat double, geo_lon double, geo_level string"
    )


def test_addresses_in_use(spark):
    tables = [addresses(spark, "旭町1", " 旭町1\t", "", None), addresses(spark, "旭町2", "　旭町1", " ")]
    assert rows(lookup.distinct_addresses(tables)) == [("旭町1",), ("旭町2",)]


def test_full_cache_has_no_misses_and_history_stays_out_of_the_output(spark):
    used, cache = addresses(spark, "A", "B"), cached(spark, "A", "B", "gone")
    assert lookup.misses(used, cache).count() == 0
    assert rows(lookup.current(used, cache), "address") == [("A",), ("B",)]
    assert rows(lookup.misses(addresses(spark, "A", "new"), cache)) == [("new",)]


def test_upsert_overrides_and_adds(spark):
    merged = lookup.upsert(cached(spark, "A", "B"), cached(spark, "B", "C", level="machiaza"))
    assert rows(merged, "address", "geo_level") == [("A", "residential_block"), ("B", "machiaza"), ("C", "machiaza")]


RESULT = "input string, coordinate_level string, lat double, lon double, line int, match_level string"


@pytest.mark.parametrize(
    ("level", "lat", "expected"),
    [
        ("residential_detail", 35.7, (35.7, 139.6, "residential_detail", "residential_detail")),
        ("city", 35.7, (None, None, None, "city")),
        ("prefecture", 35.7, (None, None, None, "prefecture")),
        ("unknown", 35.7, (None, None, None, "unknown")),
        (None, 35.7, (None, None, None, "unknown")),
        ("", 35.7, (None, None, None, "unknown")),
        ("machiaza", None, (None, None, None, "machiaza")),
    ],
)
def test_coarse_answers_lose_their_coordinate_but_not_their_level(spark, level, lat, expected):
    missed = spark.createDataFrame([("x", "東京都　中央区（本町）１")], "address string, query string")
    results = spark.createDataFrame([("東京都 中央区(本町)1", level, lat, 139.6, 1, "m")], RESULT)
    found = lookup.attach(missed, results, "line").select("geo_lat", "geo_lon", "geo_level", "abr_level")
    assert tuple(found.first()) == expected


def test_unanswered_address_stays_and_the_last_answer_counts(spark):
    missed = spark.createDataFrame([("x", "q 1"), ("y", "q 2")], "address string, query string")
    results = spark.createDataFrame(
        [("q  1", "machiaza", 1.0, 2.0, 1, "old"), ("q 1", "machiaza", 3.0, 4.0, 2, "new")], RESULT
    )
    assert rows(lookup.attach(missed, results, "line"), "address", "geo_lat", "abr_level", "match_level") == [
        ("x", 3.0, "machiaza", "new"), ("y", None, None, None),
    ]


def test_enrich_trims_and_keeps_every_row(spark):
    source = addresses(spark, " A　", "A", "B", None)
    found = lookup.enrich(source, cached(spark, "A"), columns=["geo_lat"])
    assert rows(found.groupBy("looked_up_geo_lat").count()) == [(35.7, 2), (None, 2)]


def test_histogram_most_common_first(spark):
    table = cached(spark, "A", "B").unionByName(cached(spark, "C", level=None)).unionByName(cached(spark, "D", level=""))
    table = table.unionByName(cached(spark, "E"))
    assert [tuple(r) for r in lookup.level_histogram(table).collect()] == [("residential_block", 3, 0.6), ("none", 2, 0.4)]
    shown = audit.offending({"c": table.select("address")}, 2)
    assert audit.least_offenders(shown, 2) == {"c": ['{"address":"A"}', '{"address":"B"}']}


def test_generic_checks(spark):
    table = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1), (None, 1)], "k string, v int")
    assert checks.not_null(table, "k").count() == 2
    assert rows(checks.unique(table, "k")) == [("A", 2)]
    assert rows(checks.unique_key(table, ["k", "v"])) == [(None, 1, 2)]
    assert rows(checks.accepted_values(table, "k", ["A"])) == [("B", 1)]
    assert checks.not_empty(table).count() == 0
    assert checks.not_empty(table.filter("v > 9")).count() == 1


def located(spark, *places):
    frame = spark.createDataFrame(list(places), "address string, lat double, lon double, a double, b double, c string")
    chosen = frame.withColumns(geo.select_geo(*[F.col(n) for n in ("lat", "lon", "a", "b", "c")]))
    return chosen.withColumn("geometry", geo.point(F.col("geo_lat"), F.col("geo_lon")))


PLACES = [
    ("x", 35.7, 139.6, None, None, None),
    ("x", 139.6, 35.7, None, None, None),
    ("x", None, None, 35.5, 139.5, "machiaza"),
    ("", 0.0, 0.0, None, None, None),
]


def test_what_selection_yields_is_consistent(spark):
    assert checks.geo_consistency(located(spark, *PLACES)).count() == 0


@pytest.mark.parametrize(
    ("column", "value"),
    [
        ("geo_lat", "cast(null as double)"),
        ("geo_lon", "10.0d"),
        ("geo_source", "'guess'"),
        ("geo_source", "'abr'"),
        ("geo_level", "'city'"),
        ("geometry", "cast(null as struct<x: double, y: double>)"),
        ("geometry", "struct(35.7d as x, 139.6d as y)"),
        ("lat", "35.0d"),
    ],
)
def test_each_contradiction_is_found(spark, column, value):
    assert checks.geo_consistency(located(spark, PLACES[0]).withColumn(column, F.expr(value))).count() == 1


def test_coverage(spark):
    table = located(spark, *PLACES)
    assert rows(checks.source_coverage(table)) == [(3, 2, 2 / 3)]
    assert checks.source_coverage(table, 0.5).count() == 0
    assert rows(checks.lookup_coverage(table, 1.1)) == [(3, 3, 1.0)]
    assert checks.source_coverage(table.filter("lat is null")).count() == 0


def test_log_checks(spark):
    log = spark.createDataFrame(
        [("a", "ok", None), ("b", "degraded", ["2018-10"]), ("c", "skipped", []), ("d", "failed", None)],
        "dataset_id string, status string, unresolved_months array<string>",
    ).selectExpr("'p' schema_name", "*", "'t' dataset_title", "'r' reason", "1L row_count")
    assert rows(checks.every_file_ingested(log), "dataset_id") == [("c",), ("d",)]
    assert rows(checks.none_unresolved(log), "dataset_id") == [("b",)]


def test_reconciliation_and_gaps(spark):
    table = spark.createDataFrame(
        [("1", "男", 1), ("1", "女", 2), ("1", "計", 3), ("2", "男", 1), ("2", "計", 3)], "m string, k string, v long"
    )
    assert rows(checks.component_sum(table, ["m"], "k", "v", ["男", "女"], "計")) == [("2", 1, 3)]
    left = spark.createDataFrame([("1", 3), ("2", 3), ("3", 1)], "m string, v long")
    right = spark.createDataFrame([("1", 3), ("2", 4), ("4", 1)], "m string, v long")
    assert rows(checks.cross_total(left, right, ["m"], "v")) == [("2", 3, 4), ("3", 1, None), ("4", None, 1)]
    days = spark.createDataFrame([("2021-09-05",), ("2022-01-31",), (None,)], "d string").selectExpr("cast(d as date) d")
    assert rows(checks.period_gaps(days, "d").selectExpr("cast(d as string)")) == [
        ("2021-10-01",), ("2021-11-01",), ("2021-12-01",),
    ]
    assert checks.period_gaps(days.filter("d is null"), "d").count() == 0


def test_latest_top_puts_missing_values_last(spark):
    table = spark.createDataFrame([("1", 9), ("2", None), ("2", 5), ("2", 7)], "m string, v long")
    assert [tuple(r) for r in series.latest_top(table, "m", "v", 2).collect()] == [("2", 7), ("2", 5)]


def test_refused_version_leaves_the_published_one(spark, tmp_path):
    root = str(tmp_path / "pub")
    good, bad = addresses(spark, "A"), addresses(spark, "A", "A")

    def audit(written):
        return {"unique": checks.unique(written["t"], "address"), "not_empty": checks.not_empty(written["t"])}

    assert publication.published(spark, root, "t") is None
    refused = publication.publish({"t": bad}, audit, root)
    assert (refused.published, refused.failed) == (False, {"unique": 1})
    assert publication.published(spark, root, "t") is None
    assert publication.publish({"t": good}, audit, root).published
    assert not publication.publish({"t": bad}, audit, root).published
    assert rows(publication.published(spark, root, "t")) == [("A",)]
    assert publication.publish({"t": addresses(spark, "B")}, audit, root).published
    assert rows(publication.published(spark, root, "t")) == [("B",)]


BAD = [(1, "a"), (1, "a"), (2, None), (3, "x"), (4, "z"), (5, "y"), (6, "y"), (None, "a"), (None, "a")]


def rules():
    return Rules(
        ["k", "v"],
        broken={"v.not_null": F.col("v").isNull(), "v.known": ~F.col("v").isin("a", "b")},
        ratios={"most": (F.col("k") > 0, F.col("v") == "a", 0.6), "none": (F.lit(False), F.lit(False), 1.0)},
        keys={"k.unique": Key(["k"], nulls_differ=True), "both": Key(["k", "v"])},
    )


def test_rules_are_counted_while_a_table_is_written(spark, tmp_path):
    bad = spark.createDataFrame(BAD, "k int, v string").repartition(3)
    done = publication.publish({"t": bad}, lambda written: {}, str(tmp_path), {"t": rules()})
    assert done.failed == {"t.v.not_null": 1, "t.v.known": 4, "t.most": 1, "t.k.unique": 1, "t.both": 2}
    assert done.offenders == {
        "t.v.not_null": ['{"k":2,"v":null}'],
        "t.v.known": ['{"k":3,"v":"x"}', '{"k":4,"v":"z"}', '{"k":5,"v":"y"}'],
        "t.k.unique": ['{"k":1}'],
        "t.both": ['{"k":1,"v":"a"}', '{"k":null,"v":"a"}'],
    }
    assert not done.published


def test_good_and_empty_tables_break_no_rule(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (None, "a"), (None, "b")], "k int, v string")
    for n, table in enumerate((good, good.limit(0), good.filter("k > 99"))):
        done = publication.publish({"t": table}, lambda written: {}, str(tmp_path / str(n)), {"t": rules()})
        assert (done.published, done.failed, done.offenders) == (True, {}, {})


def test_offenders_of_other_checks_are_named(spark, tmp_path):
    held = addresses(spark, "B", "A", "C", "D")
    done = publication.publish({"t": held}, lambda written: {"none": written["t"], "some": written["t"].limit(0)}, str(tmp_path))
    assert done.failed == {"none": 4}
    assert done.offenders == {"none": ['{"address":"A"}', '{"address":"B"}', '{"address":"C"}']}


def test_a_good_table_is_read_once_after_its_write(spark, tmp_path):
    """Keys take one scan and one exchange, and what is counted during the write takes none."""
    good = spark.range(1000).select("id", F.lit("a").alias("v"))
    plan = audit.repeated_keys(publication.materialise(good.withColumnRenamed("id", "k"), str(tmp_path / "t")), rules().keys)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    watched, watch = audit.observed(good.withColumnRenamed("id", "k"), rules())
    text = watched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and watch is not None
