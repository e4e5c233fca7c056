"""Fill-in-middle: texts cut into prefix, middle and suffix at line ends and put in another order, by displacement.

A batch of texts is one byte array. Scans find its line ends, and from them the two cuts of every text. Where a byte goes
is its own place plus a shift that changes only at the border of a segment: the changes are written into a difference
array, whose running sum is the shift of every byte of the batch, and one scatter builds all outputs. Sentinels are
written into the gaps that are left. The way back finds the sentinels in an output, builds the same kind of
difference array from them, and gathers.

The cuts are drawn from a SHA-256 of the seed and the row's key, so a text is cut alike in every run and by every
executor. A text that is empty or null, or holds a sentinel, or isn't drawn for the transformation, stays ``plain``. A
null key is drawn as an empty one; equal rows are cut alike. Bytes that are no UTF-8 are moved like any other. A batch is
worked on in slices of about a megabyte of text; a longer text is a slice of its own and is never cut off. Empty tables
give no rows. Input columns named like the added one are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import bytes_of, raw, slices, table

SEED = 7
RATE, SPM_RATE = 100, 50  # of a hundred
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes in every sentinel
PLAIN, PSM, SPM = 0, 1, 2
FORMS = pa.array(["plain", "psm", "spm"])
KIND = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: binary>"
# The order of (prefix, middle, suffix) in an output, and the sentinel before each.
ORDER = {PSM: ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), SPM: ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}


def sentinels(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all sentinels in ``data`` and the letter of each."""
    at = np.flatnonzero(data[: max(len(data) - 2, 0)] == ord("<"))
    letter = data[at + 1]
    marked = (data[at + 2] == ord(">")) & ((letter == ord("P")) | (letter == ord("S")) | (letter == ord("M")))
    return at[marked], letter[marked]


def _inside(at: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the sentinels at ``at`` end within the text they begin in."""
    return at + MARK <= ends[owner]


def _spread(begins: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The shift of each of ``size`` bytes, given the shift from each border on (in order, the last of one place counts)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, np.diff(shifts, prepend=0))
    return np.cumsum(change[:size])


def displace(data: np.ndarray, at: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of a slice and where they begin. ``at`` are the borders of the texts, ``cuts`` two places in each."""
    sizes = np.diff(at)
    out_at = np.r_[0, np.cumsum(sizes + np.where(form == PLAIN, 0, 3 * MARK))]
    begins = np.c_[at[:-1], cuts]  # of prefix, middle and suffix
    lengths = np.diff(np.c_[begins, at[1:]], axis=1)
    targets = begins - at[:-1, None] + out_at[:-1, None]
    out = np.empty(out_at[-1], np.uint8)
    for kind, order in ORDER.items():
        rows = form == kind
        place = out_at[:-1][rows]
        for segment, mark in order:
            for k, byte in enumerate(mark):
                out[place + k] = byte
            place = place + MARK
            targets[rows, segment] = place
            place = place + lengths[rows, segment]
    shift = _spread(begins.ravel(), (targets - begins).ravel(), len(data))
    out[np.arange(len(data)) + shift] = data
    return out, out_at


def undo(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs were built from, and where each begins; ``at`` are the borders of the outputs."""
    marks, letters = sentinels(data)
    owner = np.searchsorted(at, marks, side="right") - 1
    kept = _inside(marks, owner, at[1:]) & (form[owner] != PLAIN)
    marks, letters, owner = marks[kept], letters[kept], owner[kept]
    found = np.zeros((len(form), 3), np.int64)
    place = np.zeros((len(form), 3), np.int64)
    for segment, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        own = owner[letters == mark[1]]
        np.add.at(found[:, segment], own, 1)
        place[own, segment] = marks[letters == mark[1]]
    # An output that isn't of its form is taken as it is.
    first, second = np.where(form == PSM, place[:, 0], place[:, 1]), np.where(form == PSM, place[:, 1], place[:, 0])
    fits = (found == 1).all(axis=1) & (first == at[:-1]) & (first < second) & (second < place[:, 2])
    form = np.where(fits, form, PLAIN)
    kept = form[owner] != PLAIN
    marks, letters, owner = marks[kept], letters[kept], owner[kept]
    sizes = np.diff(at) - np.where(form == PLAIN, 0, 3 * MARK)
    text_at = np.r_[0, np.cumsum(sizes)]
    moved = np.flatnonzero(form != PLAIN)
    begins = np.repeat(at[:-1, None], 3, axis=1)  # of prefix, middle and suffix, in the output
    ends = np.repeat(at[1:, None], 3, axis=1)
    for segment, letter in enumerate((PREFIX, MIDDLE, SUFFIX)):
        begins[owner[letters == letter[1]], segment] = marks[letters == letter[1]] + MARK
    nth = np.where(form[moved] == PSM, 0, 1)
    # A segment ends where the next sentinel begins; the middle is last and ends with the output.
    ends[moved, 0] = np.where(nth == 0, begins[moved, 2], begins[moved, 1]) - MARK
    ends[moved, 2] = np.where(nth == 0, begins[moved, 1], begins[moved, 0]) - MARK
    lengths = ends - begins
    lengths[form == PLAIN, 1:] = 0
    targets = text_at[:-1, None] + np.cumsum(lengths, axis=1) - lengths
    shift = _spread(targets.ravel(), (begins - targets).ravel(), text_at[-1])
    return data[np.arange(text_at[-1]) + shift], text_at


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _chars(data: np.ndarray) -> np.ndarray:
    """How many code points begin before every byte, and in all."""
    return np.r_[0, np.cumsum((data & 0xC0) != 0x80)]


def transform(data: np.ndarray, at: np.ndarray, draws: np.ndarray, rate: int, spm_rate: int) -> pa.StructArray:
    """The rows of ``KIND`` for the texts between the borders ``at``; ``draws`` are four numbers for each."""
    ends = at[1:]
    breaks = np.flatnonzero(data == ord("\n")) + 1
    first = np.searchsorted(breaks, at[:-1], side="right")
    whole = np.searchsorted(breaks, ends, side="right") - first
    closed = np.zeros(len(ends), bool)
    filled = ends > at[:-1]
    closed[filled] = data[ends[filled] - 1] == ord("\n")
    n = whole + (filled & ~closed)
    units = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    # After unit k a text is cut behind its k-th line break, after the last one at its end.
    known = np.r_[breaks, 0]
    nth = np.minimum(first[:, None] + units - 1, len(breaks))
    cuts = np.where(units == 0, at[:-1, None], np.where(units == n[:, None], ends[:, None], known[nth]))

    marks, _ = sentinels(data)
    owner = np.searchsorted(at, marks, side="right") - 1
    plain = ~filled | (draws[:, 2] % 100 >= rate)
    plain[owner[_inside(marks, owner, ends)]] = True
    form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < spm_rate, SPM, PSM))
    out, out_at = displace(data, at, cuts, form)
    chars = _chars(data)
    lengths = chars[cuts] - chars[np.c_[at[:-1], cuts[:, 0]]]
    return pa.StructArray.from_arrays(
        [pa.array(n), FORMS.take(pa.array(form)), pa.array(lengths[:, 0], mask=plain), pa.array(lengths[:, 1], mask=plain), _binary(out, out_at).cast(pa.binary())],
        ["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def _draw(key: str, seed: int) -> Column:
    """Four numbers below 2 ** 32 for a row, as 16 bytes in one binary value."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 32))


def _by_slice(texts: pa.Array, build) -> pa.Array:
    """``build(data, borders, low, high)`` over slices of a batch, put together."""
    data, at = bytes_of(texts)
    parts = [build(data[at[low] : at[high]], at[low : high + 1] - at[low], low, high) for low, high in slices(texts)]
    return pa.concat_arrays(parts) if parts else None


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "fim", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> DataFrame:
    """``docs`` with the struct ``name``: units, form, lengths in code points (null if plain) and the output's bytes."""

    @F.arrow_udf(KIND)
    def built(texts: pa.Array, drawn: pa.Array) -> pa.Array:
        words, starts = bytes_of(drawn)
        draws = words[starts[0] : starts[-1]].reshape(-1, 16).copy().view(">u4").astype(np.int64)
        whole = _by_slice(texts, lambda data, at, low, high: transform(data, at, draws[low:high], rate, spm_rate))
        return whole if whole is not None else transform(np.zeros(0, np.uint8), np.zeros(1, np.int64), draws, rate, spm_rate)

    return docs.withColumn(name, built.asNondeterministic()(raw(text), _draw(key, seed)))


def restored(output: Column, form: Column) -> Column:
    """The bytes of the text that an output was built from, from the output and its form alone."""

    @F.arrow_udf("binary")
    def rebuilt(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        codes = pc.index_in(forms.fill_null("plain"), FORMS).to_numpy(zero_copy_only=False)
        outputs = outputs.fill_null(b"")
        whole = _by_slice(outputs, lambda data, at, low, high: _binary(*undo(data, at, codes[low:high])).cast(pa.binary()))
        return whole if whole is not None else pa.array([], pa.binary())

    return rebuilt(output, form)


def middle_filled(spark, sf_dir) -> DataFrame:
    """Every document's form, lengths and the hashes of its output and of the text rebuilt from it."""
    built = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    return built.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = rf"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units from documents),
counted as (
  select *, len(units) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from drawn),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as c1, greatest(h1 % (n + 1), h2 % (n + 1)) as c2,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= {RATE}
      then 'plain' when h4 % 100 < {SPM_RATE} then 'spm' else 'psm' end as form from counted),
parted as (
  select *, array_to_string(units[1:c1], '') as p, array_to_string(units[c1 + 1:c2], '') as m,
    array_to_string(units[c2 + 1:], '') as s from cut)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from parted
"""
