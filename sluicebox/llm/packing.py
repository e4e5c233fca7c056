"""Best-fit packing with conflicts: fixed-size sequences, no copies of a text and no parted sources in one sequence.

Documents are cut into pieces of at most ``capacity`` tokens (words). Pieces are dealt into shards of about
``shard_tokens`` tokens by a hash of id, copy and piece, so a source or a group of copies that holds a third of all rows
is spread evenly. In a shard, pieces go longest first into the bin with the least residual room that still takes them.
Bins are kept in the order of their residual, each with a bitmap of the sources and one of the duplicate clusters it
holds; bins whose bitmaps conflict are passed over, all of equal room at once, and the search goes on to their successor,
until the tightest compatible bin is found or a new one is opened. No bin spans two shards.

A piece conflicts with a bin that holds a piece of the same cluster (equal normalised texts), other pieces of its own
document included, or a source listed with its own in ``apart``. Every token is packed exactly once. Documents without
words take no room and give no rows; a null source conflicts with nothing. Rows that repeat are packed as copies.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import table
from sluicebox.session import spool

CAPACITY = 2048
SHARD_TOKENS = 1 << 22
FEW = 32
APART = (("src1", "src2"), ("src3", "src4"), ("src5", "src6"))
PIECES = "doc_id long, cluster long, copy long, piece long, first_token long, n_tokens long, shard long, bin long, bin_offset long"


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


class Bins:
    """Open bins of one shard in the order of residual room, then of number.

    Bins with the same bitmap of sources and the same room are a shelf, a sorted list. A cluster with few pieces passes
    over the bins that hold it one by one. For every other one with pieces to come these bins are listed by shelf in the
    same order, so the first bin of a shelf that does not hold it is where the two lists part: any number of bins in
    conflict is passed over by one binary search.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: dict[int, int] = {}  # bitmap of sources -> bitmap of rooms that have a shelf
        self.shelves: dict[tuple[int, int], list[int]] = {}
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.room: list[int] = []
        self.holders: list[list[int]] = []  # by bit of a cluster: bins that hold it
        self.held: dict[int, dict[tuple[int, int], list[int]]] = {}  # by bit of a large cluster: shelf -> bins that hold it
        self.large = 0
        self.unused: list[int] = []

    def bit(self, pieces: int) -> int:
        """The number of a bit for a cluster with so many pieces to come."""
        if not self.unused:
            self.unused.append(len(self.holders))
            self.holders.append([])
        bit = self.unused.pop()
        if pieces > FEW:
            self.held[bit] = {}
            self.large |= 1 << bit
        return bit

    def forget(self, bit: int) -> None:
        """A cluster without pieces to come gives its bit back."""
        for number in self.holders[bit]:
            self.clusters[number] ^= 1 << bit
        self.holders[bit] = []
        self.large &= ~(1 << bit)
        self.held.pop(bit, None)
        self.unused.append(bit)

    def _lists(self, number: int):
        """The sorted lists that have, or are to have, a bin in them."""
        shelf = self.sources[number], self.room[number]
        yield self.shelves, shelf
        bits = self.clusters[number] & self.large
        while bits:
            yield self.held[(bits & -bits).bit_length() - 1], shelf
            bits &= bits - 1

    def _take(self, number: int) -> None:
        for lists, shelf in self._lists(number):
            bins = lists[shelf]
            del bins[bisect_left(bins, number)]
            if not bins:
                del lists[shelf]
                if lists is self.shelves:
                    self.rooms[shelf[0]] ^= 1 << shelf[1]

    def _put(self, number: int) -> None:
        kind, room = self.sources[number], self.room[number]
        if room:
            self.rooms[kind] = self.rooms.get(kind, 0) | 1 << room
            for lists, shelf in self._lists(number):
                insort(lists.setdefault(shelf, []), number)

    def _first(self, shelf: tuple[int, int], bit: int | None) -> int | None:
        bins = self.shelves[shelf]
        if bit is None:
            return bins[0]
        if bit not in self.held:
            return next((number for number in bins if not self.clusters[number] >> bit & 1), None)
        held = self.held[bit].get(shelf, [])
        k = bisect_left(range(len(held)), True, key=lambda i: bins[i] != held[i])
        return bins[k] if k < len(bins) else None

    def _tightest(self, size: int, enemies: int, bit: int | None) -> int | None:
        """The compatible bin with the least room that takes ``size``, of several the first."""
        open_rooms = {kind: rooms >> size << size for kind, rooms in self.rooms.items() if not kind & enemies}
        either = 0
        for rooms in open_rooms.values():
            either |= rooms
        while either:
            one = either & -either
            shelves = ((kind, one.bit_length() - 1) for kind, rooms in open_rooms.items() if rooms & one)
            found = [number for number in (self._first(shelf, bit) for shelf in shelves) if number is not None]
            if found:
                return min(found)
            either ^= one
        return None

    def place(self, size: int, source: int, enemies: int, bit: int | None) -> tuple[int, int]:
        """The bin for a piece and the piece's offset in it. ``source`` and ``enemies`` are bitmaps."""
        number = self._tightest(size, enemies, bit)
        if number is None:
            number = len(self.room)
            self.sources.append(0)
            self.clusters.append(0)
            self.room.append(self.capacity)
        else:
            self._take(number)
        room = self.room[number]
        self.room[number] -= size
        self.sources[number] |= source
        if bit is not None:
            self.clusters[number] |= 1 << bit
            self.holders[bit].append(number)
        self._put(number)
        return number, self.capacity - room


def pack(rows: list[tuple], capacity: int, apart: tuple[tuple[str, str], ...]) -> list[tuple[int, int]]:
    """Bin and offset for each ``(n_tokens, source, cluster)`` of a shard, taken in the given order."""
    parted = {name for pair in apart for name in pair}
    # A source that is parted from none can't conflict and needs no bit, nor does a cluster with one piece in the shard.
    names = {source: 1 << k for k, source in enumerate(sorted({s for _, s, _ in rows if s in parted}))}
    enemies: dict[str, int] = {}
    for a, b in apart:
        enemies[a] = enemies.get(a, 0) | names.get(b, 0)
        enemies[b] = enemies.get(b, 0) | names.get(a, 0)
    to_come = Counter(cluster for _, _, cluster in rows)
    bits: dict[int, int] = {}
    bins = Bins(capacity)
    places = []
    for size, source, cluster in rows:
        to_come[cluster] -= 1
        if to_come[cluster] and cluster not in bits:
            bits[cluster] = bins.bit(to_come[cluster])
        places.append(bins.place(size, names.get(source, 0), enemies.get(source, 0), bits.get(cluster)))
        if not to_come[cluster] and cluster in bits:
            bins.forget(bits.pop(cluster))
    return places


def best_fit(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_tokens: int = SHARD_TOKENS,
    apart: tuple[tuple[str, str], ...] = APART,
    text: str = "text",
) -> DataFrame:
    """One row per piece: where its tokens start, how many there are, and its shard, bin and offset in the bin."""
    bare = F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n\x0b\x0c\r", "")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(bare).alias("cluster"),
        n_words(text).alias("n_tokens"),
    )
    copies = spool(sized.where("n_tokens > 0").groupBy("doc_id", "source", "cluster", "n_tokens").agg(F.count("*").alias("n")))
    total = copies.agg(F.sum(F.col("n_tokens") * F.col("n"))).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    single = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    pieces = single.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity))))
    first = F.col("piece") * capacity
    dealt = pieces.select(
        "doc_id",
        "source",
        "cluster",
        F.col("copy").cast("long").alias("copy"),
        F.col("piece").cast("long").alias("piece"),
        first.alias("first_token"),
        F.least(F.lit(capacity), F.col("n_tokens") - first).alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "cluster", "copy", "piece"), F.lit(shards)).alias("shard"),
    )

    def packed(_, held):
        held = held.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("copy", "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
        places = pack(list(zip(*(held.column(k).to_pylist() for k in ("n_tokens", "source", "cluster")), strict=True)), capacity, apart)
        out = held.drop_columns(["source"])
        out = out.append_column("bin", pa.array([b for b, _ in places], pa.int64()))
        return out.append_column("bin_offset", pa.array([o for _, o in places], pa.int64()))

    return dealt.groupBy("shard").applyInArrow(packed, PIECES)


def packed_documents(spark, sf_dir) -> DataFrame:
    """Every piece of every document with its place."""
    return best_fit(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
