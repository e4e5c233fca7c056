"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has the bits that are set in over half of the hashes of a text's word shingles. Documents link when their
fingerprints differ in at most ``radius`` bits, and classes are the connected components of the links.

Finding the links of the distinct fingerprints:

* The 64 bits are cut into ``radius + 1`` blocks; fingerprints that link agree in one block at least, so every
  fingerprint goes to one cell per block, and a cell too large for a task is dealt out as pairs of chunks.
* In a cell the fingerprints are sorted by Gray rank, where neighbours share most bits. Runs of ``FAN`` neighbours
  become a node that keeps the bits all of them share (a mask and a pattern), runs of nodes become a node again.
* A search goes down from the top: a node only checks the bits that its parent did not fix and adds the differences to
  what came before, and a whole group is left as soon as the sum exceeds the radius.
* A cell returns a spanning forest of its links, not the links: at most one row per fingerprint.

Null and empty texts have fingerprint zero and link like any other. Rows that repeat a ``doc_id`` or have none are
fingerprinted like all others; a class of rows without any id has a null ``component_id``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.cells import deal
from sluicebox.llm.common import raw, table
from sluicebox.llm.components import components
from sluicebox.session import spool

SHINGLE, SEED, RADIUS = 4, 42, 4
FAN = 16
CELL_ROWS = 20_000
# Pairs of a query and a node that a search holds at a time.
FRONTIER = 1 << 21


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text; bit k is worth 2**k. Texts of fewer words than a shingle are one shingle."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - size + 1, 1)
    last = ends[len(words) - n :]
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (hashed(line[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n
    )
    votes = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        some = hashes[low : low + (1 << 16)].astype("<u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str = "code", text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint added as a signed long."""

    @F.arrow_udf("bigint")
    def coded(texts: pa.Array) -> pa.Array:
        codes = np.fromiter((fingerprint(text.as_py()) for text in texts), np.uint64, len(texts))
        return pa.array(codes.view(np.int64))

    return docs.withColumn(name, coded.asNondeterministic()(raw(text)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order below levels of nodes that keep the bits their codes share. Nodes never span two cells."""

    def __init__(self, codes: np.ndarray, cells: np.ndarray):
        order = np.lexsort((gray_rank(codes), cells))
        self.codes, cells = codes[order], cells[order]
        self.order = order
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # first child, pattern, mask; from the bottom
        ones, zeros, owner = self.codes, ~self.codes, cells
        while True:
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            place = np.arange(len(owner)) - np.repeat(begins, np.diff(np.r_[begins, len(owner)]))
            first = np.flatnonzero(place % FAN == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, first), np.bitwise_and.reduceat(zeros, first)
            self.levels.append((np.r_[first, len(owner)], ones, ones | zeros))
            owner = owner[first]
            if len(owner) == len(begins):
                break
        self.roots = np.searchsorted(owner, cells)  # of each code, in its order

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in ``codes``) of linked codes, a later one and an earlier one of the same cell."""
        step = 1 << 14
        for low in range(0, len(self.codes), step):
            queries = np.arange(low, min(low + step, len(self.codes)))
            yield from self._down(queries, self.roots[queries], np.zeros(len(queries), np.int64), len(self.levels) - 1, None, radius)

    def _down(self, queries, nodes, passed, level, above, radius):
        """``passed`` counts the differences in the bits that ``above`` (the parents' masks) fixes."""
        first, pattern, mask = self.levels[level]
        fresh = mask[nodes] if above is None else mask[nodes] & ~above
        passed = passed + np.bitwise_count((self.codes[queries] ^ pattern[nodes]) & fresh)
        near = (passed <= radius) & (first[nodes] < queries)
        queries, nodes, passed = queries[near], nodes[near], passed[near]
        if not len(queries):
            return
        width = first[nodes + 1] - first[nodes]
        for low, high in _runs(width):
            n = width[low:high]
            q, p, m = np.repeat(queries[low:high], n), np.repeat(passed[low:high], n), np.repeat(mask[nodes[low:high]], n)
            child = np.repeat(first[nodes[low:high]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if level:
                yield from self._down(q, child, p, level - 1, m, radius)
            else:
                p = p + np.bitwise_count((self.codes[q] ^ self.codes[child]) & ~m)
                found = (p <= radius) & (child < q)
                if found.any():
                    yield q[found], child[found]


def _runs(width: np.ndarray) -> Iterator[tuple[int, int]]:
    total = np.cumsum(width)
    low = 0
    while low < len(width):
        high = max(int(np.searchsorted(total, total[low] - width[low] + FRONTIER, side="right")), low + 1)
        yield low, high
        low = high


class Forest:
    """Disjoint sets of places; the least place of a set is its root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            roots = self.roots()
            x, y = roots[a], roots[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def _cell_batches(batches, keys: list[str], enough: int = 1 << 17) -> Iterator[pa.Table]:
    """Tables of whole cells from batches sorted by the cells' keys."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= enough:
            whole = pa.Table.from_batches(held)
            last = [whole.column(k)[-1] for k in keys]
            border = whole.num_rows
            same = np.ones(border, bool)
            for key, value in zip(keys, last, strict=True):
                same &= whole.column(key).to_numpy() == value.as_py()
            cut = border - int(same.sum())
            if cut:
                yield whole.slice(0, cut)
            held, rows = whole.slice(cut).to_batches(), border - cut
    if rows:
        yield pa.Table.from_batches(held)


def hamming_forest(codes: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that join all ``code`` values which differ in at most ``radius`` bits, few per code."""
    widths = [64 * (k + 1) // (radius + 1) - 64 * k // (radius + 1) for k in range(radius + 1)]
    blocks = []
    low = 0
    for number, width in enumerate(widths):
        part = F.shiftrightunsigned(F.col("code"), low).bitwiseAND(F.lit((1 << width) - 1))
        blocks.append(F.struct(F.lit(number).alias("block"), part.alias("part")))
        low += width
    spread = codes.select("code", F.explode(F.array(*blocks)).alias("b")).select("code", "b.block", "b.part")
    keys = ["block", "part", "cell_i", "cell_j"]
    dealt = deal(spread, ["block", "part"], F.col("code"), cell_rows)

    def forest(batches):
        for cells in _cell_batches(batches, keys):
            columns = [cells.column(k).to_numpy() for k in keys]
            changes = np.zeros(cells.num_rows, bool)
            for column in columns:
                changes[1:] |= column[1:] != column[:-1]
            index = GrayIndex(cells.column("code").to_numpy().view(np.uint64), np.cumsum(changes))
            sets = Forest(cells.num_rows)
            for later, earlier in index.links(radius):
                sets.join(later, earlier)
            roots = sets.roots()
            moved = np.flatnonzero(roots != np.arange(len(roots)))
            signed = index.codes.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[roots[moved]])], ["a", "b"])

    sorted_cells = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_cells.select(*keys, "code").mapInArrow(forest, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(doc_id, version, code, root, component_id)`` per row of ``docs``.

    ``version`` is a hash of the text, ``code`` the fingerprint, ``root`` names the class, also one without any id, and
    ``component_id`` is the least ``doc_id`` of the class.
    """
    versions = docs.select("doc_id", "text", F.xxhash64(raw()).alias("version"))
    coded = spool(with_fingerprint(versions).select("doc_id", "version", "code"))
    codes = spool(coded.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = components(hamming_forest(codes.select("code"), radius, cell_rows))
    rooted = codes.join(roots, codes.code == roots.node, "left")
    root = F.coalesce("root", "code")
    linked = rooted.select("code", "least", root.alias("root"))
    classes = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spool(linked.join(classes, "root").select("code", "root", "component_id"))
    return coded.join(named, "code").select("doc_id", "version", "code", "root", "component_id")


def simhash_classes(spark, sf_dir) -> DataFrame:
    """Every document's fingerprint in hex and the least id of its class."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")
