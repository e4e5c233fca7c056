"""Text normal forms used to compare headers, values and addresses written in different ways.

Unicode normalisation has no built-in function. Text none of whose characters changes alone or can meet the one before
it (a combining mark, a vowel of a Hangul syllable) is its own normal form, which one built-in search shows. Only other
text is handed, in Arrow batches, to Python, once for all forms of a column; a composition of built-in functions for it
took six times as long.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluicebox.functions.batches import by_parts

# The characters a Unicode-aware strip / ``\s`` removes.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The space separators (category Zs) an SQL trim removes; tab and newline are not among them.
SPACE_SEPARATORS = (
    " \xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
BYTE_ORDER_MARK = "\ufeff"

_ASCII_SPACES = tuple(c for c in SPACES if c.isascii())
_ASCII_RUN = "[\\x09-\\x0d\\x1c-\\x20]+"
_SPACE_RUN = "[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
_NON_ASCII = "[^\\x00-\\x7f]"


def nfkc_text(text: str) -> str:
    return unicodedata.normalize("NFKC", text)


def header_text(text: str) -> str:
    bare = text.replace(BYTE_ORDER_MARK, "").strip().strip('"').strip("'")
    return "".join(nfkc_text(bare).split())


@F.arrow_udf(StringType())
def _in_python(texts: pa.Array) -> pa.Array:
    return by_parts(lambda held: [None if text is None else nfkc_text(text) for text in held], pa.string(), texts)


def _class(characters: Iterable[str]) -> str:
    """A pattern for one of ``characters``. Ranges lie in a tree, so that a character is placed by a few looks."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, characters)):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])

    def tree(held: list[list[int]]) -> str:
        whole = f"\\x{{{held[0][0]:x}}}-\\x{{{held[-1][1]:x}}}"
        if len(held) == 1:
            return whole
        half = len(held) // 2
        return f"[{whole}&&[{tree(held[:half])}{tree(held[half:])}]]"

    return f"[{tree(ranges)}]"


@cache
def _changing() -> str:
    """A pattern for the characters that NFKC changes, alone or behind another."""
    points = [chr(n) for n in range(0x80, sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF]
    seconds = {chr(n) for n in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # Hangul vowels and finals
    for point in points:
        parts = unicodedata.decomposition(point).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            pair = "".join(chr(int(part, 16)) for part in parts)
            if unicodedata.normalize("NFC", pair) == point:
                seconds.add(pair[1])
    return _class(c for c in points if c in seconds or unicodedata.combining(c) or nfkc_text(c) != c)


def _nfkc(text: Column) -> Column:
    return F.coalesce(_in_python(F.when(text.rlike(_changing()), text)), text)


def _form(text: Column, ascii_form: Column, other_form: Callable[[Column], Column]) -> Column:
    """``ascii_form`` of ASCII text and ``other_form`` of the NFKC of any other."""
    return F.when(text.rlike(_NON_ASCII), other_form(_nfkc(text))).otherwise(ascii_form)


def _without(text: Column, characters: tuple[str, ...]) -> Column:
    """Delete a few ASCII characters; each plain search is far cheaper than a look at every character."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def nfkc(text: Column) -> Column:
    """Unicode NFKC."""
    return _nfkc(text)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(text, F.lit(SPACES))


def sql_trim(text: Column) -> Column:
    """Remove leading and trailing space separators only."""
    return F.btrim(text, F.lit(SPACE_SEPARATORS))


def squeeze(text: Column) -> Column:
    """Strip, and reduce every inner run of white space to one space."""
    return F.btrim(F.regexp_replace(text, _SPACE_RUN, " "), F.lit(" "))


def _bare(text: Column, spaces: str) -> Column:
    return F.btrim(F.btrim(F.btrim(text, F.lit(spaces)), F.lit('"')), F.lit("'"))


def header_form(text: Column) -> Column:
    """Normal form of a CSV header: no BOM, quotes or white space, NFKC."""
    plain = _bare(F.replace(text, F.lit(BYTE_ORDER_MARK), F.lit("")), SPACES)
    return _form(plain, _without(plain, _ASCII_SPACES), lambda whole: F.regexp_replace(whole, _SPACE_RUN, ""))


def value_form(text: Column) -> Column:
    """Normal form of a cell: NFKC, no white space, no thousands separators; NULL counts as empty."""

    def other(whole: Column) -> Column:
        return F.replace(F.regexp_replace(whole, _SPACE_RUN, ""), F.lit(","), F.lit(""))

    return F.coalesce(_form(text, _without(text, (*_ASCII_SPACES, ",")), other), F.lit(""))


def query_form(text: Column) -> Column:
    """Normal form of a lookup text: NFKC with single spaces."""
    return _form(text, F.btrim(F.regexp_replace(text, _ASCII_RUN, " "), F.lit(" ")), squeeze)


def clean_text(text: Column) -> Column:
    """Stripped text, with NULL as the empty string."""
    return F.coalesce(strip(text), F.lit(""))
