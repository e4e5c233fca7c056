"""Repeated substrings: every byte of a string of ``length`` bytes that also starts elsewhere is removed.

The suffixes that matter are found by sampling that depends on the text only:

* Among the hashes of the ``GRAM``-byte grams inside a window of ``length`` bytes the least one, leftmost of equal ones,
  is the window's anchor. Equal windows have the same anchor at the same place, so windows are only compared below
  their anchor's hash, and each window belongs to one anchor.
* Anchors whose hash occurs once are done. For the others the bytes around the anchor (all windows that chose it) are
  its context, named by its digest. Names are counted with map-side combining, so a passage that a third of all
  documents share is one row per task; a context that occurs twice or more is repeated as a whole. Bytes are fetched
  only for hashes that have a context of their own left, one copy of each context.
* Below one hash, the suffixes that start at the anchors are sorted and form an enhanced suffix array (order and common
  prefix lengths). A stack scan yields its tree of common-prefix intervals. For every interval the left sides of all its
  occurrences are sorted too: where they differ the repeat is maximal, and every occurrence gets the longest left
  extension that it shares with any other one of the interval, not only with its neighbour in the array.
* A hash with more than ``HOT_CONTEXTS`` different contexts is not sorted in one task: its windows are counted by
  content instead, which gives the same spans.

Matches never cross documents; occurrences in the same document count, overlapping ones too. Null texts are empty;
texts shorter than ``length`` lose nothing. Rows that repeat are occurrences of each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import raw, table
from sluicebox.session import broadcast_if_small, spool

LENGTH, GRAM = 200, 32
CHUNK = 1 << 20
HOT_CONTEXTS = 50_000
OUT_BYTES = 4 * 1024 * 1024

_FACTOR = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at every position where that many follow."""
    found, factor = _BYTE[data], _FACTOR
    width = 1
    while width < GRAM:
        found = found[:-width] * np.uint64(factor) + found[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, from running minima forwards and backwards in blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor with the first and the last window that chose it."""
    parts = []
    for low in range(0, max(len(text) - length + 1, 0), CHUNK):
        piece = text[low : low + CHUNK + length - 1]
        hashes = gram_hashes(piece)
        places = np.arange(len(hashes), dtype=np.uint64)
        least = _least((hashes & ~np.uint64((1 << 24) - 1)) | places, length - GRAM + 1)
        chosen = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        begins = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        ends = np.r_[begins[1:], len(chosen)] - 1
        at = chosen[begins]
        parts.append((hashes[at].view(np.int64), at + low, begins + low, ends + low))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*parts, strict=True))


def lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(heights: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals ``(height, first, last)`` of an array; ``heights[i]`` is shared by ``i`` and ``i + 1``."""
    stack: list[tuple[int, int]] = []
    for i, height in enumerate([*heights, -1]):
        first = i
        while stack and stack[-1][0] > height:
            top, first = stack.pop()
            yield top, first, i
        if height >= 0 and (not stack or stack[-1][0] < height):
            stack.append((height, first))


def maximal_repeats(contexts: list[tuple[int, bytes]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For contexts ``(place of the anchor, bytes)`` of one anchor: the byte ranges of each that another one repeats."""
    covers: list[list[tuple[int, int]]] = [[] for _ in contexts]
    rights = [text[at:] for at, text in contexts]
    lefts = [text[:at][::-1] for at, text in contexts]
    order = sorted(range(len(contexts)), key=rights.__getitem__)
    heights = [lcp(rights[i], rights[j]) for i, j in zip(order, order[1:], strict=False)]
    for height, first, last in intervals(heights):
        if height < GRAM:
            continue
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        shared = [lcp(lefts[i], lefts[j]) for i, j in zip(members, members[1:], strict=False)]
        for k, i in enumerate(members):
            left = max(shared[k - 1] if k else 0, shared[k] if k < len(shared) else 0)
            if left + height >= length:
                at = contexts[i][0]
                covers[i].append((at - left, at + height))
    return covers


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _key() -> Column:
    """What a row is called: its id, or a hash of its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("raw"))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    with_bytes = docs.select("doc_id", raw(text).alias("raw"))
    return with_bytes.select("doc_id", _key().alias("key"), F.xxhash64("raw").alias("version"), "raw")


def _unpack(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8").reshape(-1, width)


def _sampled(batches, length: int, names: bool):
    """Anchors of each text by hash and, if wanted, by context: how often, and where the contexts start."""
    kinds = [pa.int64(), pa.int64()] if not names else [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = ["h", "n", "context_id", "key", "version", "at", "n_bytes", "starts"][: len(kinds)]
    for batch in batches:
        rows: list[tuple] = []
        for place, value in enumerate(batch.column("raw")):
            value = value.as_py()
            hashes, at, first, last = anchors(np.frombuffer(value, np.uint8), length)
            if not names:
                found, counts = np.unique(hashes, return_counts=True)
                rows += zip(found.tolist(), counts.tolist(), strict=True)
            else:
                key, version = (batch.column(k)[place].as_py() for k in ("key", "version"))
                seen: dict[bytes, list] = {}
                for h, a, f, end in zip(hashes.tolist(), at.tolist(), first.tolist(), (last + length).tolist(), strict=True):
                    name = hashlib.md5((a - f).to_bytes(2, "big") + value[f:end]).digest()
                    seen.setdefault(name, [h, a - f, end - f, []])[3].append(f)
                rows += [(h, len(f), name, key, version, a, n, np.array(f, "<u4").tobytes()) for name, (h, a, n, f) in seen.items()]
            if len(rows) > 10_000:
                yield _rows(rows, columns, kinds)
                rows = []
        if rows:
            yield _rows(rows, columns, kinds)


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT_CONTEXTS, text: str = "text") -> DataFrame:
    """``(key, version, spans)``: for each row with repeats its key, a hash of its text, and packed ``(from, to)`` pairs."""
    keyed = _keyed(docs, text).select("key", "version", "raw")
    counted = keyed.select("raw").mapInArrow(lambda batches: _sampled(batches, length, False), "h long, n long")
    twice = broadcast_if_small(spool(counted.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")))
    schema = "h long, n long, context_id binary, key long, version long, at int, n_bytes int, starts binary"
    sample = spool(keyed.mapInArrow(lambda batches: _sampled(batches, length, True), schema).join(twice, "h", "left_semi"))
    place = F.struct("key", "version", F.substring("starts", F.lit(1), F.lit(4)).alias("start"))
    contexts = spool(sample.groupBy("context_id", "h", "at", "n_bytes").agg(F.sum("n").alias("n"), F.min(place).alias("place")))
    whole = contexts.where("n > 1").select("context_id", F.lit(0).cast("long").alias("low"), F.col("n_bytes").cast("long").alias("high"))
    # Where every context of a hash is repeated as a whole, nothing is left to find.
    crowds = contexts.groupBy("h").agg(F.count("*").alias("n_contexts"), F.count_if(F.col("n") == 1).alias("n_single")).where("n_contexts > 1 and n_single > 0")
    crowded = contexts.join(crowds.select("h", "n_contexts"), "h")
    one = F.struct("context_id", "h", "n_contexts", "at", "n_bytes", F.col("place.start").alias("start"))
    asked = crowded.groupBy(F.col("place.key").alias("key"), F.col("place.version").alias("version")).agg(F.collect_list(one).alias("asked"))

    def cut_out(batches):
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for value, asked in zip(batch.column("raw"), batch.column("asked"), strict=True):
                value = value.as_py()
                for c in asked.as_py():
                    start = int.from_bytes(c["start"], "little")
                    rows.append((c["h"], c["n_contexts"], c["context_id"], c["at"], value[start : start + c["n_bytes"]]))
                    size += c["n_bytes"]
                if size > OUT_BYTES:
                    yield _rows(rows, ["h", "n_contexts", "context_id", "at", "context"], [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()])
                    rows, size = [], 0
            if rows:
                yield _rows(rows, ["h", "n_contexts", "context_id", "at", "context"], [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()])

    # Rows that repeat give the same context more than once; one is enough.
    once = keyed.join(broadcast_if_small(spool(asked)), ["key", "version"]).select("raw", "asked")
    cut = once.mapInArrow(cut_out, "h long, n_contexts long, context_id binary, at int, context binary")
    small, large = cut.where(F.col("n_contexts") <= hot), cut.where(F.col("n_contexts") > hot)

    def scanned(batches):
        rows: list[tuple] = []
        for group in _groups(batches):
            covers = maximal_repeats([(at, context) for _, at, context in group], length)
            for (name, _, _), spans in zip(group, covers, strict=True):
                rows += [(name, low, high) for low, high in merged(spans)]
            if len(rows) > 10_000:
                yield _rows(rows, ["context_id", "low", "high"], [pa.binary(), pa.int64(), pa.int64()])
                rows = []
        if rows:
            yield _rows(rows, ["context_id", "low", "high"], [pa.binary(), pa.int64(), pa.int64()])

    dealt = small.select("h", "context_id", "at", "context").repartition("h").sortWithinPartitions("h", "context_id")
    found = dealt.mapInArrow(scanned, "context_id binary, low long, high long")
    covers = whole.union(found)
    if not crowds.where(F.col("n_contexts") > hot).isEmpty():
        covers = covers.union(_counted_windows(large, length))
    where = sample.select("context_id", "key", "version", "starts").join(covers, "context_id")
    spans = where.groupBy("key", "version").agg(F.collect_list(F.struct("starts", "low", "high")).alias("spans"))

    @F.arrow_udf("binary")
    def packed(spans: pa.Array) -> pa.Array:
        out = []
        for one in spans.to_pylist():
            flat = [(f + s["low"], f + s["high"]) for s in one for f in np.frombuffer(s["starts"], "<u4").tolist()]
            out.append(np.array(merged(flat), "<i8").tobytes())
        return pa.array(out, pa.binary())

    return spans.select("key", "version", packed("spans").alias("spans"))


def _counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The ranges of contexts too many to sort in one task: windows that occur twice or more, by content."""

    def windows(batches):
        for batch in batches:
            rows = []
            for name, context in zip(batch.column("context_id").to_pylist(), batch.column("context").to_pylist(), strict=True):
                for low in range(len(context) - length + 1):
                    rows.append((name, low, hashlib.md5(context[low : low + length]).digest()))
                if len(rows) > 10_000:
                    yield _rows(rows, ["context_id", "low", "content"], [pa.binary(), pa.int64(), pa.binary()])
                    rows = []
            if rows:
                yield _rows(rows, ["context_id", "low", "content"], [pa.binary(), pa.int64(), pa.binary()])

    each = contexts.dropDuplicates(["context_id"]).select("context_id", "context").mapInArrow(windows, "context_id binary, low long, content binary")
    again = each.groupBy("content").agg(F.count("*").alias("n")).where("n > 1").select("content")
    return each.join(again, "content", "left_semi").select("context_id", "low", (F.col("low") + length).alias("high"))


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _groups(batches) -> Iterator[list[tuple]]:
    """Contexts of equal hash from sorted batches, as ``(context_id, at, context)``, each once."""
    group: list[tuple] = []
    current = None
    for batch in batches:
        for h, *row in zip(*(batch.column(k).to_pylist() for k in ("h", "context_id", "at", "context")), strict=True):
            if h != current and group:
                yield group
                group = []
            current = h
            if not group or group[-1][0] != row[0]:
                group.append(tuple(row))
    if group:
        yield group


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT_CONTEXTS, text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, what is left as ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans`` and its digest."""
    spans = broadcast_if_small(spool(repeated_spans(docs, length, hot, text)))
    both = _keyed(docs, text).join(spans, ["key", "version"], "left")

    @F.arrow_udf("struct<kept: binary, n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept_sha256: string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for value, packed in zip(texts, spans, strict=True):
            value, packed = value.as_py(), packed.as_py()
            removed = _unpack(packed, 2).tolist() if packed else []
            edges = [0, *(edge for span in removed for edge in span), len(value)]
            kept = b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((kept, len(value), len(value) - len(kept), len(removed), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    return both.select("doc_id", cut.asNondeterministic()("raw", "spans").alias("cut")).select("doc_id", "cut.*")


def substring_repeats(spark, sf_dir) -> DataFrame:
    """Every document with how much of it is repeated elsewhere and the digest of the rest."""
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")
