"""Near-duplicate paragraphs: MinHash banding, exact Jaccard, one paragraph of every cluster stays.

A paragraph is a line with a word (words are runs of non-white bytes, A-Z in lower case); its shingles are the sets of
five consecutive words, and a line of fewer is one exact unit named by its words. In a text with blank lines, lines are
also joined up to the next blank one, and these wrapped paragraphs are compared among each other in the same way; in a
text without any, a line end ends a paragraph. ``min_words`` leaves shorter paragraphs out; the query leaves out none.
Two paragraphs link when the Jaccard similarity of their shingle sets is 0.8 or more;
clusters are the connected components of the links, and all but the first paragraph of a cluster are to be removed.

* ``tune`` picks the fewest rows and bands that find a pair at the threshold with the wanted recall while few
  dissimilar pairs collide.
* Paragraphs with the same words are one node, so exact copies never meet in a bucket. A task spreads the bands and words
  of a node once, and none for fewer words than a shingle has, as only equal ones are alike.
* Buckets with two or more nodes are kept, buckets with the same members once. Their members come together with their
  words; all pairs of a bucket are checked by their sets of shingles (64-bit hashes): common ones are counted pair by pair,
  those of many texts by products of 0/1 matrices, block by block, and a spanning forest of the links is all that leaves a
  task. A bucket too large for a task is dealt out as pairs of chunks.

Passages that sit inside lines, with other words around them, are no paragraphs of their own. They are cut by content:
in every ``PASSAGE_STARTS`` neighbouring places of a text the one with the least hash of its next four words starts a
piece of ``PIECE_WORDS`` words, line ends or not. Any 50 equal words of two texts thus hold an equal piece. Pieces that
stand at two places or more, in one row or in several, are paragraphs too, named by their words, and all but their first
places are to be removed; of places in one text that overlap each other, as in ``a a a``, the first counts. Overlapping
pieces of a text whose first place lies in the same document are shown as one passage. At the edge of a
passage the words around it can choose one more piece, which only some of the rows share. Passages with edits are found
by longer pieces that start at the same kind of places (``near_passages``).

Every row's whole text is cut. Null and empty texts and paragraphs and pieces without a like give no rows. Rows
that repeat are copies of each other; rows without an id stay only if all of their cluster have none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.cells import deal
from sluicebox.llm.common import SLICE_BYTES, raw, slices, table
from sluicebox.llm.components import components
from sluicebox.llm.hashes import repeated
from sluicebox.llm.simhash import Forest
from sluicebox.llm.stats import SPACE
from sluicebox.session import broadcast_if_small, may_broadcast, measure, spool, worked_off

MIN_WORDS, SHINGLE, THRESHOLD = 50, 5, 0.8
RECALL, LOW, FALSE = 0.999, 0.3, 0.15
CELL_ROWS = 2_000
BLOCK = 512
OUT_ROWS, OUT_WORDS, NAMES = 2_000, 200_000, 100_000
MATRIX = 1 << 24
PIECE_WORDS, PASSAGE_STARTS, START_WORDS = 40, 11, 4
NEAR_WORDS, START_ROWS = MIN_WORDS, CELL_ROWS
OFTEN, PAIRED, NARROW = 32, 1 << 19, 1 << 15
BLOCK_WORDS = 1 << 16
_PLAIN = np.frombuffer(bytes(range(256)).lower(), np.uint8).copy()
_PLAIN[SPACE] = 32
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def tune(threshold: float = THRESHOLD, recall: float = RECALL, low: float = LOW, false: float = FALSE) -> tuple[int, int]:
    """Bands and rows with the fewest hashes: a pair at ``threshold`` collides with ``recall``, one at ``low`` rarely."""
    fitting = [
        (bands * rows, bands, rows)
        for rows in range(1, 17)
        for bands in range(1, 129)
        if 1 - (1 - threshold**rows) ** bands >= recall and 1 - (1 - low**rows) ** bands <= false
    ]
    return min(fitting)[1:]


def _split(text: bytes, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, list[bytes]]]:
    """``(number, start, n_bytes, n_lines, words)`` of the lines of a text."""
    found, start = [], 0
    for number, line in enumerate(text.split(b"\n")):
        words = line.lower().split()
        if len(words) >= max(min_words, 1):
            found.append((number, start, len(line), 1, words))
        start += len(line) + 1
    return found


def _joined(text: bytes, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, list[bytes]]]:
    """As ``_split`` for the lines between blank lines, joined; none if there is no blank line."""
    lines = _split(text, 1)
    if len(lines) == text.count(b"\n") + 1:
        return []
    found: list[tuple[int, int, int, int, list[bytes]]] = []
    for number, start, n_bytes, _, words in lines:
        if found and sum(found[-1][k] for k in (0, 3)) == number:
            first, begin, _, n_lines, before = found[-1]
            before += words
            found[-1] = (first, begin, start + n_bytes - begin, n_lines + 1, before)
        else:
            found.append((number, start, n_bytes, 1, words))
    return [one for one in found if len(one[4]) >= min_words]


def _name(words: bytes) -> tuple[bytes, int, int]:
    """The name of joined words, also as two longs."""
    name = hashlib.md5(words).digest()
    return name, *(int.from_bytes(half, "big", signed=True) for half in (name[:8], name[8:]))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def shingles(words: list[bytes], size: int = SHINGLE) -> set[bytes]:
    return {b" ".join(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))}


class _Powers:
    """Powers of an odd factor and of its inverse modulo 2**64, as many as were asked for so far."""

    def __init__(self, factor: int):
        self.both = factor, pow(factor, -1, 1 << 64)
        self.held = [np.ones(0, np.uint64), np.ones(0, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.held[0]):
            size = 1 << n.bit_length()
            self.held = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, f, np.uint64)], dtype=np.uint64) for f in self.both]
        return self.held[0][:n], self.held[1][:n]


def _byte_values(seed: int) -> np.ndarray:
    """A random number for every byte; letters count as lower case, and all white space is the same."""
    found = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
    found[65:91] = found[97:123]
    found[SPACE] = found[32]
    return found


class Shingler:
    """Hashes the shingles of joined words, as ``PieceFinder`` hashes its pieces."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.values, self.powers = size, _byte_values(len(_FACTORS)), _Powers(_FACTORS[0])

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all shingles, text by text and with repeats, and how many each text has."""
        stops = np.cumsum([len(text) + 1 for text in texts])
        found, counts, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while low < len(texts):
            before = stops[low - 1] if low else 0
            high = max(int(np.searchsorted(stops, before + SLICE_BYTES, side="right")), low + 1)
            for part, some in zip((found, counts), self._hashes(texts[low:high], stops[low:high] - before), strict=True):
                part.append(some)
            low = high
        return np.concatenate(found), np.concatenate(counts)

    def _hashes(self, texts: list[bytes], stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(texts), np.uint8)
        gaps = np.flatnonzero(data == 32)
        begins, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
        behind = np.searchsorted(begins, stops)
        first = np.r_[0, behind[:-1]]
        counts = np.maximum(behind - first - self.size + 1, 1)
        at = np.arange(counts.sum()) + np.repeat(first - np.cumsum(counts) + counts, counts)
        last = np.minimum(at + self.size, np.repeat(behind, counts)) - 1
        up, down = self.powers.upto(len(data))
        total = np.r_[np.uint64(0), np.cumsum(self.values[data] * up, dtype=np.uint64)]
        begin = begins[at]
        found = (total[ends[last]] - total[begin]) * down[begin]
        return (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9), counts


class MinHash:
    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        draw = np.random.default_rng(11)
        self.factor = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.shift = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def band_values(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One row of band values per set of shingle hashes: ``flat`` has them set by set, ``counts`` how many each has."""
        half = len(counts) // 2
        if half and len(flat) > NARROW:
            cut = counts[:half].sum()
            return np.concatenate([self.band_values(flat[:cut], counts[:half]), self.band_values(flat[cut:], counts[half:])])
        first = np.cumsum(counts) - counts
        least = np.empty((len(counts), len(self.factor)), np.uint64)
        mixed, high = np.empty_like(flat), np.empty_like(flat)
        for k, (factor, shift) in enumerate(zip(self.factor, self.shift, strict=True)):
            np.multiply(flat, factor, out=mixed)
            mixed += shift
            np.right_shift(mixed, np.uint64(31), out=high)
            mixed ^= high
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            least[:, k] = np.minimum.reduceat(mixed, first)
        values = np.zeros((len(counts), self.bands), np.uint64)
        for row in range(self.rows):
            values = (values ^ least[:, row :: self.rows]) * np.uint64(0xBF58476D1CE4E5B9)
            values ^= values >> np.uint64(32)
        return values.view(np.int64)


def paragraphs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, wrapped: bool = False) -> DataFrame:
    """One row per paragraph: where it is, the name of its words (two longs) and its band values.

    Bands are null where the task has given them for the same words before, or where there is no shingle.
    """
    bands, rows = tune()
    split = _joined if wrapped else _split

    def cut(batches):
        hasher, shingler = MinHash(bands, rows), Shingler()
        named: set[bytes] = set()
        for batch in batches:
            held: list[tuple] = []
            lines: list[bytes] = []
            size = 0

            def out():
                columns = list(zip(*held, strict=True))
                names = ["doc_id", "paragraph", "start", "n_bytes", "n_lines", "n_words", "p", "q"]
                values = hasher.band_values(*shingler.hashes(lines)) if lines else np.zeros((0, bands), np.int64)
                spread = np.array(columns[-1])
                ends = np.r_[0, np.cumsum(spread) * bands].astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(ends, mask=np.r_[~spread, False]), pa.array(values.ravel()))
                return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), flat], [*names, "bands"])

            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("raw"), strict=True):
                for number, start, n_bytes, n_lines, words in split(value.as_py(), min_words):
                    line = b" ".join(words)
                    name, p, q = _name(line)
                    fresh = len(words) >= SHINGLE and name not in named
                    if fresh:
                        if len(named) >= NAMES:
                            named.clear()
                        named.add(name)
                        lines.append(line)
                        size += len(words)
                    held.append((doc_id, number, start, n_bytes, n_lines, len(words), p, q, fresh))
                    if len(held) >= OUT_ROWS or size >= OUT_WORDS:
                        yield out()
                        held, lines, size = [], [], 0
            if held:
                yield out()

    places = "doc_id long, paragraph long, start long, n_bytes long, n_lines long, n_words long, p long, q long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw(text).alias("raw")).mapInArrow(cut, f"{places}, bands array<long>")


def paragraph_words(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, wrapped: bool = False) -> DataFrame:
    """``(p, q, words)`` of the paragraphs with a shingle; a task gives the same words once."""
    split = _joined if wrapped else _split

    def cut(batches):
        named: set[bytes] = set()
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for value in batch.column("raw"):
                for *_, words in split(value.as_py(), max(min_words, SHINGLE)):
                    line = b" ".join(words)
                    name, p, q = _name(line)
                    if name in named:
                        continue
                    if len(named) >= NAMES:
                        named.clear()
                    named.add(name)
                    held.append((p, q, line))
                    size += len(words)
                    if len(held) >= OUT_ROWS or size >= OUT_WORDS:
                        yield _batch(held, ["p", "q", "words"])
                        held, size = [], 0
            if held:
                yield _batch(held, ["p", "q", "words"])

    return docs.select(raw(text).alias("raw")).mapInArrow(cut, "p long, q long, words binary")


def _linked(texts: list[bytes], threshold: float, ends: list[int] | None = None, shingler: Shingler | None = None) -> np.ndarray:
    """The root of each text in the forest of all links among the texts of its cell; without ``ends`` all are one cell.

    Common shingles are counted pair by pair where few texts of a cell hold them, by products of 0/1 matrices elsewhere.
    """
    n = len(texts)
    ends = [n] if ends is None else ends
    begins = [0, *ends[:-1]]
    cells = np.repeat(np.arange(len(ends)), np.subtract(ends, begins))
    code, counts = (shingler or Shingler()).hashes(texts)
    rows = np.repeat(np.arange(n), counts)
    code += cells[rows].astype(np.uint64) * np.uint64(_FACTORS[0])  # the same words in two cells are two codes
    order = np.argsort(code)
    code, rows = code[order], rows[order]
    code = np.r_[0, np.cumsum(code[1:] != code[:-1])][: len(code)]  # numbers from here on
    both = np.sort(code * n + rows)
    code, rows = np.divmod(both[np.r_[True, both[1:] != both[:-1]][: len(both)]], max(n, 1))
    sizes = np.bincount(rows, minlength=n).astype(np.float64)
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
    holders = np.diff(np.r_[first, len(code)])
    holders = np.repeat(holders, holders)
    few = OFTEN if len(code) <= PAIRED else 1
    some = (holders > 1) & (holders <= few)
    paired, owner = code[some], rows[some]
    pairs = [np.zeros(0, np.int64)]
    for step in range(1, few):
        same = np.flatnonzero(paired[step:] == paired[:-step])
        if not len(same):
            break
        pairs.append(owner[same] * n + owner[same + step])
    met, common = np.unique(np.concatenate(pairs), return_counts=True)
    a, b = np.divmod(met, max(n, 1))
    dense = np.zeros(len(ends), bool)
    dense[cells[rows[holders > few]]] = True
    forest = Forest(n)
    alike = ~dense[cells[a]] & (common >= threshold * (sizes[a] + sizes[b] - common) - 1e-4)
    forest.join(a[alike], b[alike])
    for cell in np.flatnonzero(dense).tolist():
        low, high = begins[cell], ends[cell]
        often = (holders > few) & (rows >= low) & (rows < high)
        member = rows[often] - low
        held, column = np.unique(code[often], return_inverse=True)
        part = slice(*np.searchsorted(a, [low, high]))
        x, y, n_met = a[part] - low, b[part] - low, common[part]
        block = max(min(BLOCK, MATRIX // len(held)), 1)

        def matrix(at: int) -> np.ndarray:
            inside = (member >= at) & (member < at + block)
            out = np.zeros((min(block, high - low - at), len(held)), np.float32)
            out[member[inside] - at, column[inside]] = 1
            return out

        for at in range(0, high - low, block):
            left = matrix(at)
            for other in range(at, high - low, block):
                both = left @ (left if other == at else matrix(other)).T
                inside = (x >= at) & (x < at + block) & (y >= other) & (y < other + block)
                both[x[inside] - at, y[inside] - other] += n_met[inside]
                own, others = (sizes[low + k : low + min(k + block, high - low)] for k in (at, other))
                near = np.nonzero(both >= threshold * (own[:, None] + others[None, :] - both) - 1e-4)
                forest.join(near[0] + low + at, near[1] + low + other)
    return forest.roots()


def _whole_cells(batches, keys: list[str]) -> Iterator[tuple[list[tuple], list[int]]]:
    """Different ``(p, q, words)`` of some whole cells, and where each cell ends, from batches sorted by the cells' keys."""
    held: list[tuple] = []
    ends: list[int] = []
    size, current = 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in [*keys, "p", "q", "words"])
        for *key, p, q, words in zip(*columns, strict=True):
            if key != current:
                if held:
                    ends.append(len(held))
                if len(held) >= OUT_ROWS or size >= OUT_WORDS * 8:
                    yield held, ends
                    held, ends, size = [], [], 0
                current = key
            elif held[-1][:2] == (p, q):
                continue
            held.append((p, q, words))
            size += len(words)
    if held:
        yield held, [*ends, len(held)]


def paragraph_links(found: DataFrame, lines: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between the names (hex) of similar paragraphs, few per paragraph.

    ``found(p, q, bands)`` is a table; ``lines(p, q, words)`` may name the same words several times.
    """

    def values(batches):
        for batch in batches:
            p, q = (batch.column(c).to_numpy().view(np.uint64) for c in ("p", "q"))
            bands = batch.column("bands")
            yield bands.flatten().to_numpy(), np.repeat(p * np.uint64(_FACTORS[0]) + q, bands.value_lengths().to_numpy())

    name = F.xxhash64("p", "q")
    banded = found.select("p", "q", F.explode("bands").alias("value"))
    shared = _small(repeated(found.select("p", "q", "bands").where("bands is not null"), values, "value").select("value"))
    members = spool(banded.join(shared, "value", "left_semi").distinct())
    same = members.groupBy("value").agg(F.count("*").alias("n"), F.bit_xor(name).alias("x"), F.bit_xor(F.xxhash64(name)).alias("y"))
    once = same.groupBy("n", "x", "y").agg(F.min("value").alias("value")).select("value")
    kept = members.join(once, "value", "left_semi")
    names = _small(members.select("p", "q").distinct())
    words = lines.join(names, ["p", "q"], "left_semi").groupBy("p", "q").agg(F.any_value("words").alias("words"))
    dealt = deal(spool(kept), ["value"], F.struct("p", "q"), cell_rows)
    keys = ["value", "cell_i", "cell_j"]
    return _cell_links(dealt.join(words, ["p", "q"]), keys, threshold)


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, written once, for a join that moves nothing else while they are few."""
    return broadcast_if_small(spool(rows), spooled=True)


def _by_cell(rows: DataFrame, keys: list[str]) -> DataFrame:
    named = list(dict.fromkeys([*keys, "p", "q"]))
    return rows.select(*named, "words").repartition(*keys).sortWithinPartitions(*named)


def _cell_links(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Edges of the spanning forests of the links in every cell, that is among the ``(p, q, words)`` that agree in ``keys``."""

    def linked(batches):
        shingler = Shingler()
        for cell, ends in _whole_cells(batches, keys):
            roots = _linked([words for *_, words in cell], threshold, ends, shingler).tolist()
            found = [(_hex(*cell[k][:2]), _hex(*cell[r][:2])) for k, r in enumerate(roots) if k != r]
            if found:
                yield _batch(found, ["a", "b"])

    return _by_cell(rows, keys).mapInArrow(linked, "a string, b string")


def _cell_roots(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """``(p, q, root)`` of all that have a link in their cell, for cells that no link leaves: ``root`` is the least name.

    Those that are alone in their cell come with their words instead of a root.
    """

    def rooted(batches):
        kinds = {"p": pa.int64(), "q": pa.int64(), "root": pa.string(), "words": pa.binary()}
        shingler = Shingler()
        for cell, ends in _whole_cells(batches, keys):
            roots = _linked([words for *_, words in cell], threshold, ends, shingler)
            linked = np.bincount(roots, minlength=len(cell)) > 1
            found: list[tuple] = [(*cell[high - 1][:2], None, cell[high - 1][2]) for low, high in zip([0, *ends], ends, strict=False) if high - low == 1]
            least: dict[int, str] = {}
            for k in np.flatnonzero(linked[roots]).tolist():
                name, root = _hex(*cell[k][:2]), int(roots[k])
                least[root] = min(least.get(root, name), name)
            found += [(*cell[k][:2], least[int(roots[k])], None) for k in np.flatnonzero(linked[roots]).tolist()]
            if found:
                columns = zip(zip(*found, strict=True), kinds.values(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], list(kinds))

    return _by_cell(rows, keys).mapInArrow(rooted, "p long, q long, root string, words binary")


def _hex(p: int, q: int) -> str:
    return f"{p & (1 << 64) - 1:016x}{q & (1 << 64) - 1:016x}"


def _node(p: str = "p", q: str = "q") -> Column:
    return F.lower(F.concat(F.lpad(F.hex(p), 16, "0"), F.lpad(F.hex(q), 16, "0")))


def _rooted(roots: DataFrame) -> DataFrame:
    """``(p, q, root)`` of ``roots(node, root)``, names as longs; ``root`` is a struct of two."""

    def half(name: str, at: int) -> Column:
        return F.conv(F.substring(name, at, 16), 16, -10).cast("long")

    root = F.struct(half("root", 1).alias("p"), half("root", 17).alias("q")).alias("root")
    return roots.select(half("node", 1).alias("p"), half("node", 17).alias("q"), root)


def duplicate_paragraphs(
    docs: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, text: str = "text", min_words: int = MIN_WORDS, wrapped: bool = False
) -> DataFrame:
    """Every paragraph that has a like: its place, its cluster, the paragraph that stays and whether this one goes.

    With ``wrapped`` of joined lines instead of single ones; clusters of paragraphs of one line each are then left out.
    """
    found = spool(paragraphs(docs, text, min_words, wrapped))
    roots = components(paragraph_links(found, paragraph_words(docs, text, min_words, wrapped), threshold, cell_rows))
    rooted = found.drop("bands").join(_small(_rooted(roots)), ["p", "q"], "left")
    placed = spool(rooted.withColumn("root", F.coalesce("root", F.struct("p", "q"))).drop("p", "q"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "paragraph")
    clusters = placed.groupBy("root").agg(F.count("*").alias("cluster_size"), F.min(place).alias("keep"), F.max("n_lines").alias("most"))
    clusters = clusters.where(F.col("cluster_size") > 1).where(F.col("most") > (1 if wrapped else 0))
    both = placed.join(clusters, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("paragraph") == F.col("keep.paragraph"))
    return both.select(
        "doc_id", "paragraph", "start", "n_bytes", "n_words",
        _node("root.p", "root.q").alias("cluster_id"), "cluster_size",
        F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.paragraph").alias("keep_paragraph"),
        (~stays).alias("removed"),
    )


def _apart(at: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Which of the places, sorted by group, begin behind the end of the last such piece of their group."""
    found, of, free = [], None, 0
    for place, one in zip(at.tolist(), group.tolist(), strict=True):
        found.append(one != of or place >= free)
        if found[-1]:
            of, free = one, place + size
    return np.array(found, bool)


class PieceFinder:
    """Finds the pieces of texts. A run of words is hashed by sums of bytes times powers, from running sums."""

    def __init__(self, every: bool = False, size: int = PIECE_WORDS):
        self.every, self.size = every, size
        self.kinds = [(_byte_values(seed), _Powers(factor)) for seed, factor in enumerate(_FACTORS)]

    def find(self, texts: list[bytes], begun: bool = False) -> tuple[np.ndarray, ...]:
        """Of every piece, once per text: text, number of the first word, first byte, end, and two hashes.

        With ``every`` at all its places in the text that do not overlap an earlier one. With ``begun`` all places, and
        the first hash is of the words that start the piece.
        """
        data = np.frombuffer(b" ".join(texts), np.uint8)
        offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])
        inside = np.r_[False, ~SPACE[data], False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edges[::2], edges[1::2]
        owner = np.searchsorted(offsets, begins, side="right") - 1
        reach = self.size + PASSAGE_STARTS - 1
        parts = [(np.zeros(0, np.int64),) * 3]
        for low in range(0, len(begins) - reach + 1, BLOCK_WORDS):
            some = slice(low, low + BLOCK_WORDS + reach - 1)
            at, p, q = self._of_words(data, inside[1:], begins[some], ends[some], owner[some], begun)
            parts.append((at + low, p, q))
        at, p, q = (np.concatenate(part) for part in zip(*parts, strict=True))
        if begun:
            of = owner[at]
            return of, at - np.searchsorted(owner, of), begins[at] - offsets[of], ends[at + self.size - 1] - offsets[of], p, q
        order = np.lexsort((at, p, owner[at]))
        at, p, q = at[order], p[order], q[order]
        of = owner[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (of[1:] != of[:-1]) | (p[1:] != p[:-1])
        if self.every:
            group = np.cumsum(fresh)
            many = np.bincount(group)[group] > 1
            fresh[many] = _apart(at[many], group[many], self.size)
        at, of = at[fresh], of[fresh]
        word = at - np.searchsorted(owner, of)
        return of, word, begins[at] - offsets[of], ends[at + self.size - 1] - offsets[of], p[fresh], q[fresh]

    def _of_words(self, data, inside, begins, ends, owner, begun):
        low, high = begins[0], ends[-1]
        kept = inside[low:high].copy()
        kept[1:] |= inside[low : high - 1]  # each word with one byte of the white space after it
        squeezed = data[low:high][kept]
        after = np.cumsum(ends - begins + 1)
        start, end = after - (ends - begins + 1), after - 1
        sums = []
        for values, powers in self.kinds:
            up, down = powers.upto(len(squeezed))
            total = np.zeros(len(squeezed) + 1, np.uint64)
            np.multiply(values.take(squeezed), up, out=total[1:])
            np.cumsum(total, out=total)
            sums.append((total, down))

        def hashed(kind: int, first: np.ndarray | slice, size: int) -> np.ndarray:
            total, down = sums[kind]
            begin = start[first]
            found = (total[end[size - 1 :][first]] - total[begin]) * down[begin]
            return (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)

        least = hashed(0, slice(len(begins) - self.size + 1), START_WORDS)
        chosen = np.lib.stride_tricks.sliding_window_view(least, PASSAGE_STARTS).argmin(1)
        reach = self.size + PASSAGE_STARTS - 1
        within = owner[: len(chosen)] == owner[reach - 1 :]
        starts = np.zeros(len(least), bool)
        starts[(chosen + np.arange(len(chosen)))[within]] = True
        at = np.flatnonzero(starts)
        return at, hashed(0, at, START_WORDS if begun else self.size).view(np.int64), hashed(1, at, self.size).view(np.int64)


def _cut(texts: list[bytes], of: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    """The words of pieces of the texts ``of``, joined."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])[of]
    kept = ~SPACE[data]
    kept[1:] |= kept[:-1].copy()  # each word with one byte of the white space after it
    plain = _PLAIN[data[kept]].tobytes()
    at = np.r_[0, np.cumsum(kept)]
    return [plain[low:high] for low, high in zip(at[start + offsets].tolist(), at[stop + offsets].tolist(), strict=True)]


def shared_passages(docs: DataFrame, text: str = "text", every: bool = False) -> DataFrame:
    """Every passage of at least 40 words that other rows hold too: its place, where it is first, whether this one goes.

    With ``every`` also those that one row holds twice, and all places in a row instead of the first.
    """

    def names(batches):
        finder = PieceFinder(every)
        for batch in batches:
            texts = batch.column("raw")
            for low, high in slices(texts):
                yield finder.find(texts[low:high].to_pylist())[4], None

    def places(batches):
        finder = PieceFinder(every)
        for batch in batches:
            texts = batch.column("raw")
            for low, high in slices(texts):
                of, *numbers = finder.find(texts[low:high].to_pylist())
                named = [batch.column(c).take(pa.array(of + low)) for c in ("doc_id", "version")]
                yield pa.RecordBatch.from_arrays([*named, *map(pa.array, numbers)], ["doc_id", "version", "word", "start", "stop", "p", "q"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw(text)).alias("version"), raw(text).alias("raw"))
    twice = _small(repeated(texts.select("raw"), names, "p").select("p"))
    schema = "doc_id long, version long, word long, start long, stop long, p long, q long"
    found = spool(texts.mapInArrow(places, schema).join(twice, "p", "left_semi").select("doc_id", "version", "word", "start", "stop", "p", "q"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "start")
    shared = found.groupBy("p", "q").agg(F.count("*").alias("cluster_size"), F.min(place).alias("keep")).where("cluster_size > 1")
    return _runs(found.join(_small(shared), ["p", "q"]), ["p", "q"], PIECE_WORDS)


def _runs(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Pieces with the place that their cluster keeps, judged; those of a text that overlap and stay or go for one document are one row."""
    once = found.repartition("doc_id", "version").dropDuplicates(["doc_id", "version", "word"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("start") == F.col("keep.start"))
    judged = once.withColumn("removed", ~stays)
    along = Window.partitionBy("doc_id", "version").orderBy("word")
    apart = F.col("word") > F.lag("word").over(along) + size
    differs = ~F.lag("keep.doc_id").over(along).eqNullSafe(F.col("keep.doc_id")) | (F.lag("removed").over(along) != F.col("removed"))
    begins = F.when(F.lag("word").over(along).isNull() | apart | differs, 1).otherwise(0)
    runs = judged.withColumn("begins", begins).withColumn("run", F.sum("begins").over(along))
    name = _node("first.p", "first.q") if keys == ["p", "q"] else F.col(f"first.{keys[0]}")
    first = F.min(F.struct("word", "start", *keys, "cluster_size", "keep")).alias("first")
    whole = runs.groupBy("doc_id", "version", "run").agg(first, F.max("stop").alias("stop"), F.max("word").alias("last"), F.first("removed").alias("removed"))
    return whole.select(
        "doc_id",
        F.col("first.start").alias("start"),
        (F.col("stop") - F.col("first.start")).alias("n_bytes"),
        (F.col("last") + size - F.col("first.word")).alias("n_words"),
        name.alias("cluster_id"), "first.cluster_size",
        F.col("first.keep.doc_id").alias("keep_doc_id"), F.col("first.keep.start").alias("keep_start"),
        "removed",
    )


def _begun_bands(pieces: DataFrame) -> DataFrame:
    """``(p, q, bands)`` of ``pieces(p, q, words)``; bands of pieces with different starts ``p`` differ."""
    bands, rows = tune()

    def banded(batches):
        hasher, shingler = MinHash(bands, rows), Shingler()
        for batch in batches:
            for low in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(low, OUT_ROWS)
                sets = shingler.hashes(part.column("words").to_pylist())
                begun = part.column("p").to_numpy() * np.int64(-7046029254386353131)
                values = pa.array((hasher.band_values(*sets) ^ begun[:, None]).ravel())
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays([part.column("p"), part.column("q"), pa.ListArray.from_arrays(ends, values)], ["p", "q", "bands"])

    return pieces.mapInArrow(banded, "p long, q long, bands array<long>")


def near_passages(
    docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, start_rows: int = START_ROWS
) -> DataFrame:
    """Every passage of at least 50 words that is like another but not equal to it, as ``shared_passages`` shows them.

    Pieces of ``NEAR_WORDS`` words meet only if they begin with the same words, so that pieces that overlap in one text
    are not taken as copies of each other. A start below which all pieces are equal is left out before any words are
    written. The different pieces of a start meet in one exact Jaccard test; a start with more than ``start_rows`` of
    them is first parted by the bands of the paragraphs. Places are looked up again for the pieces with a like alone.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw(text)).alias("version"), raw(text).alias("raw"))

    def starts(batches):
        finder = PieceFinder(size=NEAR_WORDS)
        for batch in batches:
            texts = batch.column("raw")
            for low, high in slices(texts):
                yield finder.find(texts[low:high].to_pylist(), begun=True)[4:]

    def lines(batches):
        finder = PieceFinder(size=NEAR_WORDS)
        named = np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column("raw")
            for low, high in slices(texts):
                some = texts[low:high].to_pylist()
                of, _, start, stop, p, q = finder.find(some, begun=True)
                _, fresh = np.unique(q, return_index=True)
                fresh = fresh[~np.isin(q[fresh], named)]
                named = np.r_[named, q[fresh]] if len(named) < NAMES else q[fresh]
                words = _cut(some, of[fresh], start[fresh], stop[fresh])
                for at in range(0, len(fresh), OUT_ROWS):
                    part = slice(at, at + OUT_ROWS)
                    columns = [pa.array(p[fresh[part]]), pa.array(q[fresh[part]]), pa.array(words[part], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["p", "q", "words"])

    def places(batches):
        finder = PieceFinder(size=NEAR_WORDS)
        for batch in batches:
            texts = batch.column("raw")
            for low, high in slices(texts):
                of, *numbers = finder.find(texts[low:high].to_pylist(), begun=True)
                named = [batch.column(c).take(pa.array(of + low)) for c in ("doc_id", "version")]
                yield pa.RecordBatch.from_arrays([*named, *map(pa.array, numbers)], ["doc_id", "version", "word", "start", "stop", "p", "q"])

    counted = _small(repeated(texts.select("raw"), starts, "p").withColumnRenamed("n", "places"))
    words = texts.select("raw").mapInArrow(lines, "p long, q long, words binary")
    alone = F.when(F.col("places") > start_rows, F.xxhash64("q")).otherwise(F.lit(0))
    several = words.join(counted, "p").withColumn("cell", alone)
    found = spool(_cell_roots(several, ["p", "cell"], threshold))
    rooted_names = [found.where("root is not null").select("p", "q", "root")]
    crowded = found.where("root is null").select("p", "q", "words")
    if not crowded.isEmpty():  # starts of many places; some have few different pieces
        few = crowded.groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") <= start_rows).select("p")
        few = _small(few)
        rooted_names.append(spool(_cell_roots(crowded.join(few, "p", "left_semi"), ["p"], threshold)).select("p", "q", "root"))
        rest = spool(crowded.join(few, "p", "left_anti"))
        if not rest.isEmpty():
            roots = components(paragraph_links(spool(_begun_bands(rest)), rest, threshold, cell_rows))
            rooted_names.append(_rooted(roots).withColumn("root", _node("root.p", "root.q")))
    names = reduce(DataFrame.unionByName, rooted_names)
    again = texts.mapInArrow(places, "doc_id long, version long, word long, start long, stop long, p long, q long")
    linked_starts = spool(names.select("p").distinct())
    if may_broadcast(measure(linked_starts)[1]):  # the names themselves may be too many; then few places are shuffled
        again = again.join(F.broadcast(linked_starts), "p", "left_semi")
    rooted = spool(again.join(broadcast_if_small(names, spooled=True), ["p", "q"]).drop("p", "q"))
    # In one text a place that overlaps the one that stays is no copy of it.
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "start", (-F.col("stop")).alias("back"))
    clusters = _small(rooted.groupBy("root").agg(F.count("*").alias("cluster_size"), F.min(place).alias("keep")))
    own = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("start") != F.col("keep.start"))
    apart = rooted.join(clusters, "root").where(~(own & (F.col("start") < -F.col("keep.back"))))
    return _runs(apart, ["root"], NEAR_WORDS)


def repeated_paragraphs(spark, sf_dir) -> DataFrame:
    """Every line and wrapped paragraph of the documents that has a near copy, and every shared passage inside other paragraphs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = {
        "line": lambda: duplicate_paragraphs(docs, min_words=1),
        "wrapped": lambda: duplicate_paragraphs(docs, min_words=1, wrapped=True),
        "passage": lambda: shared_passages(docs, every=True),
        "near_passage": lambda: near_passages(docs),
    }
    # The rows of a kind are few beside what finding them takes, which is gone before the next kind.
    lines, wrapped, equal, near = (worked_off(spark, find).withColumn("kind", F.lit(kind)) for kind, find in kinds.items())
    return lines.unionByName(wrapped).unionByName(equal.unionByName(near), allowMissingColumns=True)
