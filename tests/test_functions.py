"""Column functions against plain Python."""

import datetime
import random
import re
import tracemalloc
import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicebox.functions import clean, geo, text
from sluicebox.functions.text import header_text


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}").coalesce(1)
    return [row["r"] for row in frame.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()]


def test_space_characters_are_those_python_strips():
    everything = [chr(n) for n in range(0x110000)]
    assert set(text.SPACES) == {c for c in everything if c.isspace()}
    assert set(text.SPACE_SEPARATORS) == {c for c in everything if unicodedata.category(c) == "Zs"}


def test_header_form(spark):
    pieces = ["\ufeff", " ", "　", "'", '"', "ﾊﾞｽ停", "（上り）", "Ｎｏ．", "名 前", "[台]", "㎡", ""]
    dice = random.Random(1)
    written = ["".join(dice.choices(pieces, k=4)) for _ in range(60)]

    def plain(text):
        bare = text.replace("\ufeff", "").strip().strip('"').strip("'")
        return re.sub(r"\s", "", unicodedata.normalize("NFKC", bare))

    assert apply(spark, text.header_form, written) == [plain(w) for w in written]
    assert [header_text(w) for w in written] == [plain(w) for w in written]


def test_value_form(spark):
    written = ["ﾊﾞ ｽ", "９９,００１", "第 Ⅳ 期\t", None, "㌔,", "北　口"]
    assert apply(spark, text.value_form, written) == ["バス", "99001", "第IV期", "", "キロ", "北口"]


def test_query_form(spark):
    assert apply(spark, text.query_form, ["\t大阪府　 北浜　２−５\n", None]) == ["大阪府 北浜 2−5", None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_forms_agree_with_python_on_any_text(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    assert apply(spark, text.header_form, values) == [header_text(v) for v in values]
    expected = ["".join(unicodedata.normalize("NFKC", v).split()).replace(",", "") for v in values]
    assert apply(spark, text.value_form, values) == expected
    assert apply(spark, text.query_form, values) == [" ".join(unicodedata.normalize("NFKC", v).split()) for v in values]


def test_lenient_date(spark):
    day = datetime.date(2026, 9, 1)
    good = ["2026-09-01", "2026-9-1", "2026/9/1", "2026/09/01", "2026.9.1", "2026-09-01T10:00:00", " 2026-09-01 "]
    assert apply(spark, clean.lenient_date, good) == [day] * len(good)
    bad = ["2026", "2026-09", "2026-09-01x", "令和8年9月1日", "4月頃", "2026-13-01", "2026/2/30", "", None]
    assert apply(spark, clean.lenient_date, bad) == [None] * len(bad)


def test_flag(spark):
    words = ["1", "○", "〇", "有", "0", "×", "無", "", "要確認", None, " 1"]
    assert apply(spark, clean.flag, words) == [True] * 4 + [False] * 3 + [None] * 4


def test_counts(spark):
    written = ["1,234", "1234", "-5", "12.7", "12.5", "-12.5", "1e3", " 5 ", "", "-", None, "12x", "9" * 20, "０"]
    assert apply(spark, clean.count_number, written) == [
        1234, 1234, -5, 13, 13, -13, 1000, 5, None, None, None, None, None, None,
    ]
    assert apply(spark, clean.count_number, ["1234567890123456.5", "0.4999999999999999"]) == [1234567890123457, 0]
    beyond = ["1e19", "1e30", "-1e30", "9223372036854775808", "1e400", "9.3e18"]
    assert apply(spark, clean.count_number, beyond) == [None] * len(beyond)
    assert apply(spark, clean.count_number, ["9223372036854775807", "-9e18"]) == [2**63 - 1, -9 * 10**18]
    assert apply(spark, clean.wide_number, ["3e9", "２１４７４８３６４７"]) == [None, 2147483647]


def test_wide_and_spaced_numbers(spark):
    assert apply(spark, clean.wide_number, ["１２", "3", "丁目", ""]) == [12, 3, None, None]
    assert apply(spark, clean.spaced_number, ["　1 0 ", "総　数", "不詳"]) == [10, None, None]
    assert apply(spark, clean.is_total, ["総 数", "総　数", "総数", "0"]) == [True, True, True, False]


def test_real_number(spark):
    written = ["35.7", " 35.7 ", "1e3", ".5", "5.", "35.7d", "3f", "nan", "北緯35度", "", None]
    assert apply(spark, clean.real_number, written) == [35.7, 35.7, 1000.0, 0.5, 5.0] + [None] * 6


def test_timestamp_keeps_the_written_time(spark):
    moment = datetime.datetime(2026, 9, 26, 10, 0)
    written = ["2026-09-26T10:00:00+00:00", "2026-09-26T10:00:00+09:00", "2026-09-26 10:00:00", "昨日", None]
    assert apply(spark, clean.lenient_timestamp, written) == [moment] * 3 + [None] * 2


def test_complete_address(spark):
    assert len(clean.PREFECTURES) == 47
    streets = ["北浜9", "西区北浜9", "大阪府西区北浜9", "京都府北浜9"] + [f" {name}某町1　" for name in clean.PREFECTURES]
    found = apply(spark, lambda c: clean.complete_address(c, "大阪府", "西区"), streets)
    assert found[:4] == ["大阪府西区北浜9"] * 3 + ["京都府北浜9"]
    assert found[4:] == [f"{name}某町1" for name in clean.PREFECTURES]


def test_months(spark):
    written = ["2018-12-01", "2026/9/1", "２０１８年１２月１日", "", "2018", None, "2018-12"]
    months = apply(spark, clean.year_month, written)
    assert months == ["201812", "202609", "201812", None, None, None, None]
    assert apply(spark, clean.fiscal_year, ["201804", "201903", "201904", None]) == [2018, 2018, 2019, None]


def select(spark, lat, lon, fallback=True):
    frame = spark.createDataFrame(
        [(lat, lon, 35.5, 139.5, "machiaza")], "lat double, lon double, a double, b double, c string"
    )
    answer = [F.col("a"), F.col("b"), F.col("c")] if fallback else []
    chosen = frame.withColumns(geo.select_geo(F.col("lat"), F.col("lon"), *answer))
    return tuple(chosen.select("geo_lat", "geo_lon", "geo_source", "geo_level").first())


def test_coordinate_priority(spark):
    assert select(spark, 35.7, 139.6) == (35.7, 139.6, "source", "source")
    assert select(spark, 139.6, 35.7) == (35.7, 139.6, "source_swapped", "source")
    assert select(spark, 20.0, 154.5) == (20.0, 154.5, "source", "source")
    assert select(spark, None, 139.6) == (35.5, 139.5, "abr", "machiaza")
    assert select(spark, 0.0, 0.0) == (35.5, 139.5, "abr", "machiaza")
    assert select(spark, None, None, fallback=False) == (None, None, None, None)


def test_point_is_longitude_first_and_null_without_latitude(spark):
    frame = spark.createDataFrame([(35.0, 139.0), (None, 139.0)], "lat double, lon double")
    points = [row["p"] for row in frame.select(geo.point(F.col("lat"), F.col("lon")).alias("p")).collect()]
    assert (points[0]["x"], points[0]["y"], points[1]) == (139.0, 35.0, None)


def test_nfkc_of_every_character_alone_and_after_others(spark):
    points = [chr(n) for n in range(1, 0x110000) if not 0xD800 <= n <= 0xDFFF and unicodedata.category(chr(n)) not in ("Cn", "Co")]
    for written in ("{}", "ｶ{}ｶﾞ{}", "한{}é{}"):
        values = ["".join(written.format(c, c) + "\n" for c in points[n : n + 50]) for n in range(0, len(points), 50)]
        singles = [written.format(c, c) for c in points[:12_000]]
        for texts in (values, singles):
            assert apply(spark, text.nfkc, texts) == [unicodedata.normalize("NFKC", v) for v in texts]


def test_only_text_that_can_change_goes_to_python(spark):
    own = ["が", "バス停", "é", "한글", "plain", "\u1680", "漢字"]
    other = ["ｶﾞ", "①", "e\u0301", "か\u3099", "\u1100\u1161", "ﬁ", "\u212b", "\u0344", "\u3000"]
    assert apply(spark, lambda c: c.rlike(text._changing()).cast("string"), own + other) == ["false"] * 7 + ["true"] * 9


def test_a_batch_of_long_texts_is_never_whole_in_python():
    """Peak of a batch of 2,000 wide texts of 30 kB: far below what they take as Python strings (40 MB and more)."""
    texts = pa.array(["Ａ" * 10_000, None] * 1_000)
    tracemalloc.start()
    normal = text._in_python.func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert normal.to_pylist() == ["A" * 10_000, None] * 1_000
    assert text._in_python.func(texts.slice(0, 0)).to_pylist() == []
    assert peak < 8 << 20
