"""Declared datasets and layouts.

An operator never looks in here by itself: layouts and facility columns are passed to it, so a new dataset is a new
entry, not new code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesLayout:
    """A monthly series: header -> column of its main file, and what identifies and confirms a row."""

    columns: Mapping[str, str]
    key: tuple[str, ...]
    value: tuple[str, ...]
    evidence: str
    group: str = "survey_month"


@dataclass(frozen=True)
class SeriesSource:
    """Where a series is published: its page, its main file and the yearly archives of monthly files."""

    dataset_id: str
    title: str
    page: str
    layout: str
    file_pattern: str
    archive_pattern: str
    monthly_pattern: str


@dataclass(frozen=True)
class FacilitySource:
    """Where a facility list is published, and the headers each of its columns may have, best first."""

    dataset_id: str
    title: str
    page: str
    file_pattern: str
    columns: Mapping[str, tuple[str, ...]]
    category: str | None = None
    flags: tuple[str, ...] = field(default=())


# Headers and output columns of the main file of each monthly series.
LAYOUTS: dict[str, SeriesLayout] = {
    "summary": SeriesLayout(
        columns={
            "調査年月": "survey_month",
            "統計項目": "item",
            "区分": "category",
            "数値": "value",
            "単位": "unit",
        },
        key=("item", "category"),
        value=("value",),
        evidence="headerless",
    ),
    "by_town": SeriesLayout(
        columns={
            "調査年月": "survey_month",
            "町丁目": "town",
            "地域階層": "area_level",
            "町名": "town_name",
            "丁目": "chome",
            "世帯数[世帯]": "households",
            "人口（男）[人]": "male",
            "人口（女）[人]": "female",
            "計[人]": "total",
        },
        key=("town",),
        value=("households", "male", "female", "total"),
        evidence="columns",
    ),
    "by_age": SeriesLayout(
        columns={
            "調査年月": "survey_month",
            "年齢": "age",
            "性別": "sex",
            "数値": "value",
            "単位": "unit",
        },
        key=("age", "sex"),
        value=("value",),
        evidence="wide",
    ),
}

# Headers of the monthly files, in normal form.
TOWN_EVIDENCE_KEY = "町丁目"
TOWN_EVIDENCE_VALUES = ("世帯数[世帯]", "人口(男)[人]", "人口(女)[人]", "計[人]")
AGE_EVIDENCE_KEY = "年齢[歳]"
AGE_EVIDENCE_COLUMNS = {"合計": "合計[人]", "男性": "男性合計[人]", "女性": "女性合計[人]"}

# Pages, titles and file-name patterns of the monthly series.
SERIES: tuple[SeriesSource, ...] = (
    SeriesSource(
        dataset_id="summary",
        title="世帯と人口（総括表）",
        page="tokei_kusei/soukatuhyou.html",
        layout="summary",
        file_pattern=r"\d{6}-\d{6}soukatu\.csv",
        archive_pattern=r"(\d{4})soukatu\.zip",
        monthly_pattern=r"(\d{6})soukatu\.csv",
    ),
    SeriesSource(
        dataset_id="by_town",
        title="世帯と人口（町丁目別）",
        page="tokei_kusei/chouchoubetu.html",
        layout="by_town",
        file_pattern=r"\d{6}-\d{6}chouchoubetu\.csv",
        archive_pattern=r"(\d{4})chouchoubetu\.zip",
        monthly_pattern=r"(\d{6})chouchoubetu\.csv",
    ),
    SeriesSource(
        dataset_id="by_age",
        title="世帯と人口（年齢別）",
        page="tokei_kusei/nenreibetu.html",
        layout="by_age",
        file_pattern=r"131202_nenreibetu_\d{6}-\d{6}\.csv",
        archive_pattern=r"(\d{4})nenreibetu\.zip",
        monthly_pattern=r"(\d{6})nenreibetu\.csv",
    ),
)

# Columns of the standard facility layout and the headers they are published under.
STANDARD_FACILITY: dict[str, tuple[str, ...]] = {
    "municipality_code": ("全国地方公共団体コード",),
    "municipality_name": ("地方公共団体名",),
    "address_municipality_code": ("所在地_全国地方公共団体コード",),
    "facility_id": ("ID",),
    "name": ("名称",),
    "name_kana": ("名称_カナ",),
    "name_en": ("名称_英字",),
    "town_id": ("町字ID",),
    "address": ("所在地_連結表記",),
    "prefecture": ("所在地_都道府県",),
    "city": ("所在地_市区町村",),
    "town": ("所在地_町字",),
    "street_number": ("所在地_番地以下",),
    "building_name": ("建物名等(方書)", "建物名等（方書）"),
    "lat": ("緯度",),
    "lon": ("経度",),
    "elevation": ("標高",),
    "phone_number": ("電話番号",),
    "extension": ("内線番号",),
    "contact_email": ("連絡先メールアドレス",),
    "contact_form_url": ("連絡先FormURL",),
    "contact_note": ("連絡先備考（その他、SNSなど）",),
    "postal_code": ("郵便番号",),
    "url": ("URL",),
    "image": ("画像",),
    "image_license": ("画像_ライセンス",),
    "notes": ("備考",),
}

# The columns particular to one kind of facility.
EVACUATION_BASE: dict[str, tuple[str, ...]] = {
    "name": ("名称",),
    "address": ("所在地",),
    "lat": ("緯度",),
    "lon": ("経度",),
}
HAZARD_FLAGS: dict[str, tuple[str, ...]] = {
    "for_flood": ("災害種別_洪水",),
    "for_landslide": ("災害種別_崖崩れ、土石流及び地滑り", "災害種別_崖崩れ・土石流及び地滑り"),
    "for_storm_surge": ("災害種別_高潮",),
    "for_earthquake": ("災害種別_地震",),
    "for_tsunami": ("災害種別_津波",),
    "for_large_fire": ("災害種別_大規模な火事",),
    "for_inland_flooding": ("災害種別_内水氾濫",),
    "for_volcano": ("災害種別_火山現象",),
    "shelter_overlap": ("指定避難所との重複",),
}
WATER_FLAGS: dict[str, tuple[str, ...]] = {
    "water_type_purification": ("種別_浄水所、給水所", "種別_浄水所・給水所"),
    "water_type_emergency_tank": ("種別_応急給水槽",),
    "water_type_small_tank": ("種別_小規模応急給水槽",),
}
WATER_VOLUME: dict[str, tuple[str, ...]] = {"secured_volume": ("確保水量",)}

# Pages, titles and file-name patterns of the facility lists.
FACILITIES: tuple[FacilitySource, ...] = (
    FacilitySource(
        dataset_id="evacuation_base",
        title="避難拠点",
        page="bosai/hinankyoten.html",
        file_pattern=r"hinankyoten\d*\.csv",
        columns=EVACUATION_BASE,
    ),
    FacilitySource(
        dataset_id="homecoming_support_station",
        title="帰宅支援ステーション",
        page="bosai/kitakusien.html",
        file_pattern=r"kitakusien\d*\.csv",
        columns=STANDARD_FACILITY | HAZARD_FLAGS,
        flags=tuple(HAZARD_FLAGS),
    ),
    FacilitySource(
        dataset_id="emergency_water_station",
        title="災害時給水ステーション",
        page="bosai/kyuusui.html",
        file_pattern=r"kyuusui\d*\.csv",
        columns=STANDARD_FACILITY | WATER_FLAGS | WATER_VOLUME,
        flags=tuple(WATER_FLAGS),
    ),
    FacilitySource(
        dataset_id="disaster_well",
        title="防災井戸",
        page="bosai/bousaiido.html",
        file_pattern=r"bousaiido\d*\.csv",
        columns=STANDARD_FACILITY,
        category="民間",
    ),
    FacilitySource(
        dataset_id="disaster_well",
        title="学校防災井戸",
        page="bosai/gakkoubousaiido.html",
        file_pattern=r"gakkoubousaiido\d*\.csv",
        columns=STANDARD_FACILITY,
        category="学校",
    ),
)

# Columns every landed facility row must have been given.
IDENTITY_COLUMN = "name"
REQUIRED_COLUMNS = ("name", "address")

# The words a published column may contain.
AREA_LEVELS = ("総数", "町域計", "丁目")
SEXES = ("合計", "男性", "女性")
WELL_CATEGORIES = ("民間", "学校")
GOOD_STATUSES = ("ok", "degraded")

# Details of a looked-up address, besides its coordinate.
LOOKUP_DETAILS = (
    "lg_code", "machiaza_id", "pref", "city", "ward", "oaza_cho", "chome", "koaza",
    "blk_num", "rsdt_num", "rsdt_num2", "match_level",
)
PROVENANCE = ("_source_title", "_source_url", "_source_page", "_fetched_at")
