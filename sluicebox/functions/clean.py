"""Lenient typed cleaning: a value that cannot be read for certain becomes NULL, never a guess."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicebox.functions.text import strip

# The flag vocabulary.
FLAG_TRUE = ("1", "○", "〇", "有")
FLAG_FALSE = ("0", "×", "無")

# Full-width digits and their plain forms.
WIDE_DIGITS = "０１２３４５６７８９"
PLAIN_DIGITS = "0123456789"

# The label of a grand-total row, and the spaces its writers put inside it.
TOTAL_LABEL = "総数"
LABEL_SPACES = "　 "

# The names of the 47 prefectures.
PREFECTURES = (
    "北海道", "青森県", "岩手県", "宮城県", "秋田県", "山形県", "福島県", "茨城県",
    "栃木県", "群馬県", "埼玉県", "千葉県", "東京都", "神奈川県", "新潟県", "富山県",
    "石川県", "福井県", "山梨県", "長野県", "岐阜県", "静岡県", "愛知県", "三重県",
    "滋賀県", "京都府", "大阪府", "兵庫県", "奈良県", "和歌山県", "鳥取県", "島根県",
    "岡山県", "広島県", "山口県", "徳島県", "香川県", "愛媛県", "高知県", "福岡県",
    "佐賀県", "長崎県", "熊本県", "大分県", "宮崎県", "鹿児島県", "沖縄県",
)

# Spark's date cast also takes a bare year or year and month, and its number casts take type suffixes; these
# patterns admit only complete dates and plain numbers. They also keep dirty text away from the casts: a cast that
# fails costs about a hundred times one that succeeds.
_FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(\s*|[ T]\d{1,2}:\d{2}.*)$"
_SLASH_DATE = r"^\s*\d{4}/\d{1,2}/\d{1,2}(\s*| \d{1,2}:\d{2}.*)$"
_DOT_DATE = r"^\s*\d{4}\.\d{1,2}\.\d{1,2}\s*$"
_TIMESTAMP = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*($|[ T]\d)"
_INTEGER = r"^\s*[+-]?\d{1,19}\s*$"
_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SMALL_EXPONENT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,2})?\s*$"


def _matching(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), text)


def lenient_date(text: Column) -> Column:
    """``YYYY-MM-DD``, ``Y/M/D`` or ``Y.M.D`` as DATE; anything else NULL."""
    slashes = F.element_at(F.split(F.trim(_matching(text, _SLASH_DATE)), " "), 1)
    return F.coalesce(
        _matching(text, _FULL_DATE).try_cast("date"),
        F.try_to_date(slashes, "yyyy/M/d"),
        F.try_to_date(F.trim(_matching(text, _DOT_DATE)), "yyyy.M.d"),
    )


def flag(text: Column, true: Sequence[str] = FLAG_TRUE, false: Sequence[str] = FLAG_FALSE) -> Column:
    """Tri-state BOOLEAN from a fixed vocabulary; a value outside it is unknown (NULL)."""
    return F.when(text.isin(*true), F.lit(True)).when(text.isin(*false), F.lit(False))


def flags(names: Iterable[str]) -> dict[str, Column]:
    """The same flag rule for several columns, ready for ``withColumns``."""
    return {name: flag(F.col(name)) for name in names}


def whole_number(text: Column, type_name: str = "bigint") -> Column:
    """Text as an integer; a fraction is rounded half away from zero. Other text and what does not fit is NULL."""
    fraction = _matching(text, _SMALL_EXPONENT)
    # Up to fifteen characters a double holds every digit; longer text goes through decimals, which are slower.
    real = fraction.try_cast("double")
    short = F.round(real, 0)
    long = F.round(fraction.try_cast("decimal(38,18)"), 0)
    rounded = F.when(F.length(text) <= 15, short.try_cast(type_name)).otherwise(long.try_cast(type_name))
    return F.coalesce(_matching(text, _INTEGER).try_cast(type_name), rounded)


def count_number(text: Column) -> Column:
    """A count that may carry thousands separators, as BIGINT."""
    return whole_number(F.replace(text, F.lit(","), F.lit("")))


def wide_number(text: Column) -> Column:
    """Full-width or plain digits as INTEGER."""
    return whole_number(F.translate(text, WIDE_DIGITS, PLAIN_DIGITS), "int")


def spaced_number(text: Column) -> Column:
    """A number written with inner spaces as INTEGER."""
    return whole_number(F.translate(text, LABEL_SPACES, ""), "int")


def real_number(text: Column) -> Column:
    """Text as DOUBLE, plain decimal or exponent notation only."""
    return _matching(text, _PLAIN_NUMBER).try_cast("double")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def lenient_timestamp(text: Column) -> Column:
    """ISO text as a zone-less timestamp; a zone offset is dropped, not applied."""
    return _matching(text, _TIMESTAMP).try_cast("timestamp_ntz")


def is_total(label: Column, total: str = TOTAL_LABEL) -> Column:
    """Whether a row label is the grand total, however it is spaced."""
    return F.translate(label, LABEL_SPACES, "") == total


def complete_address(
    address: Column, prefecture: str, ward: str, prefectures: Sequence[str] = PREFECTURES
) -> Column:
    """Put the missing prefecture and ward before an address; an address with any prefecture stays as it is."""
    bare = strip(address)
    return (
        F.when(bare.rlike("^(" + "|".join(prefectures) + ")"), bare)
        .when(bare.startswith(ward), F.concat(F.lit(prefecture), bare))
        .otherwise(F.concat(F.lit(prefecture + ward), bare))
    )


def year_month(text: Column) -> Column:
    """``YYYYMM`` from text such as ``2018-12-01`` or ``2026/9/1``; NULL unless a non-digit follows the month."""
    plain = F.translate(text, WIDE_DIGITS, PLAIN_DIGITS)
    pattern = r"^(\d{4})\D(\d{1,2})\D"
    return F.when(
        plain.rlike(pattern),
        F.concat(F.regexp_extract(plain, pattern, 1), F.lpad(F.regexp_extract(plain, pattern, 2), 2, "0")),
    )


def fiscal_year(month: Column, first_month: int = 4) -> Column:
    """Fiscal year of a ``YYYYMM`` text; the year turns in ``first_month``."""
    year = F.substring(month, 1, 4).try_cast("int")
    number = F.substring(month, 5, 2).try_cast("int")
    return year - F.when(number >= first_month, 0).otherwise(1)
