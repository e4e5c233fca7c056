"""Which 64-bit hashes stand more than once, counted by arrays: a hash is no row before it is known to repeat.

A task sorts its hashes, ``PACK`` at a time, and gives each range of them as one row of bytes. The rows of a range are
brought together, and one sort over all of it tells what repeats. There are ``RANGES`` ranges to a shuffle partition, so
a range grows with the input only as far as the partitions are too few for it, and a hot hash is one entry a pack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PACK, RANGES = 1 << 20, 4
_PACKS = "range int, keys binary, tags binary, counts binary"


def _planes(values: np.ndarray) -> bytes:
    """Bytes of sorted numbers, the high ones of all first: these hardly differ, so the shuffle's codec shrinks them."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _summed(keys: np.ndarray, tags: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys in order, the least and the greatest tag of each, and the sum of its counts."""
    order = np.argsort(keys)
    keys, tags, counts = keys[order], tags[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    if not len(first):
        return keys, tags, tags, counts
    return keys[first], np.minimum.reduceat(tags, first), np.maximum.reduceat(tags, first), np.add.reduceat(counts, first)


def _packed(found: Iterator[tuple[np.ndarray, np.ndarray | None]], ranges: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, tagged = 0, False

    def out() -> pa.RecordBatch:
        keys, tags = (np.concatenate(part) for part in zip(*held, strict=True))
        keys, least, most, counts = _summed(keys, tags, np.ones(len(keys), np.int64))
        if tagged:  # a key with several tags is given twice, the second time without a count
            several = np.flatnonzero(least < most)
            keys, least, counts = np.insert(keys, several, keys[several]), np.insert(least, several + 1, most[several]), np.insert(counts, several + 1, 0)
        number = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
        cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        parts = [slice(low, high) for low, high in zip(cuts, [*cuts[1:], len(keys)], strict=True)]
        columns = [
            pa.array(number[cuts]),
            pa.array([_planes(keys[part]) for part in parts], pa.binary()),
            pa.array([_planes(least[part]) if tagged else b"" for part in parts], pa.binary()),
            pa.array([counts[part].astype(np.uint32).tobytes() for part in parts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["range", "keys", "tags", "counts"])

    for keys, tags in found:
        tagged = tags is not None
        for low in range(0, len(keys), PACK):
            some = keys[low : low + PACK].view(np.uint64)
            held.append((some, tags[low : low + PACK].view(np.uint64) if tagged else np.zeros(len(some), np.uint64)))
            size += len(some)
            if size >= PACK:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def _several(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    def out(held: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        keys, tags = (np.concatenate([_numbers(each[n]) for each in held]) for n in (0, 1))
        counts = np.concatenate([np.frombuffer(each[2], np.uint32).astype(np.int64) for each in held])
        tagged = len(tags) > 0
        keys, least, most, counts = _summed(keys, tags if tagged else keys, counts)
        kept = least < most if tagged else counts > 1
        return pa.RecordBatch.from_arrays([pa.array(keys[kept].view(np.int64)), pa.array(counts[kept])], [key, "n"])

    held: list[tuple[bytes, bytes, bytes]] = []
    current = None
    for batch in batches:
        for number, *pack in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if number != current and held:
                yield out(held)
                held = []
            current = number
            held.append(tuple(pack))
    if held:
        yield out(held)


def repeated(rows: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray | None]]], key: str) -> DataFrame:
    """``(key, n)`` of the hashes that stand ``n`` > 1 times in ``rows``; where ``hashes`` gives tags, of those with several tags.

    ``hashes`` makes arrays of 64-bit keys, each with its tags or None, of the batches of a task.
    """
    ranges = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = rows.mapInArrow(lambda batches: _packed(hashes(batches), ranges), _PACKS)
    return packs.repartition("range").sortWithinPartitions("range").mapInArrow(lambda batches: _several(batches, key), f"{key} long, n long")
