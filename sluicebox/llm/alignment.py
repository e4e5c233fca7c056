"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how firmly a pair belongs together.

A text is cut by both tokenizers. Where a token of each ends at the same byte, a group ends; all A tokens of a group are
linked to all its B tokens. Corpus-wide, a pair of ids is worth the number of documents in which it is linked.

The counts come from inverted bitmaps. A task numbers its documents within blocks; for every pair of a block it keeps the
bitmap of the documents that link it, compressed as an array of 16-bit numbers or as plain bits, whichever is smaller. The
bitmaps of a block's slices are merged by OR while the task reads on. How often a document links the pair is kept in
planes over the members of the bitmap: plane k has the bit of weight 2 ** k of every multiplicity, less one. So the
document count of a pair is the sum of its bitmaps' popcounts, and its link count the weighted sum over planes; both are
added up on the map side first. The bitmaps are written once and serve as postings on the way back: each block's
postings, with the counts of their pairs, give the scores of the block's documents. No row per document and pair, and no
pair of documents, is ever written.

A block closes after ``BLOCK_DOCS`` documents or ``BLOCK_LINKS`` members of bitmaps, so one task holds a bounded part at
a time whatever the corpus; a pair that occurs in every document has one row per block. A single document is never
parted. Texts are whole. Null and empty texts, texts that are no UTF-8, and texts that a tokenizer can't give back byte
for byte have no tokens. Rows that repeat are documents of their own; null ids are kept; empty tables give no rows; only
the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import bytes_of, raw, slices, table
from sluicebox.session import broadcast_if_small, spool

TOKENIZERS = "/opt/tokenizers"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 1 << 21
SLICE_LINKS = 1 << 22  # links of groups that are written out at a time
SPACE = 0x2581  # stands for a space in pieces of tokenizer B

DOC, PAIR = 0, 1
ROW_SCHEMA = (
    "kind int, block long, doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, n_docs long, n_pair_links long, members binary, planes binary"
)
SCORED_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_ARROW = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("n_docs", pa.int64()), ("n_pair_links", pa.int64())]
    + [("members", pa.binary()), ("planes", pa.binary())]
)


def ragged(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``at[i], at[i] + 1, …`` of ``sizes[i]`` items each, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - ends + sizes, sizes)


class Flat:
    """Byte strings by number, in one buffer."""

    def __init__(self, values: list[bytes]):
        self.size = np.array([len(value) for value in values], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(values), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.at[ids], self.size[ids])]


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others moved up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers and the bytes of all their tokens."""

    def __init__(self, folder: str, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.path.join(folder, file_a))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = _letters()
        entries = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size())]
        self.flat_a = Flat([bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries])
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, file_b))
        pieces = range(self.b.get_piece_size())
        self.flat_b = Flat(
            [bytes([int(self.b.id_to_piece(k)[1:-1], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace(chr(SPACE), " ").encode() for k in pieces]
        )
        self.n_b = len(pieces)
        self.digits = Flat([f"{k} ".encode() for k in range(max(len(entries), self.n_b))])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        found_a = self.a.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        return [e.ids for e in found_a], self.b.encode(texts, num_threads=1)


@cache
def tokenizers(folder: str, file_a: str, file_b: str) -> Tokenizers:
    return Tokenizers(folder, file_a, file_b)


def _numbers(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a row, and how many each list has."""
    sizes = np.array([len(numbers) for numbers in lists], np.int64)
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    return flat, sizes


def _faithful(flat: Flat, ids: np.ndarray, owner: np.ndarray, spelled: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' bytes, joined, are the text's (``spelled`` between the borders ``at``)."""
    n = len(at) - 1
    sizes = np.bincount(owner, flat.size[ids], n).astype(np.int64)
    same = sizes == np.diff(at)
    kept = same[owner]
    joined = flat.joined(ids[kept])
    wanted = spelled[ragged(at[:-1][same], sizes[same])]
    texts = np.repeat(np.flatnonzero(same), sizes[same])
    same[texts[joined != wanted]] = False
    return same


def _expand(group_a, ids_a, group_b, ids_b, n_groups, n_b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs, as codes ``a * n_b + b``, with their group, some groups at a time; tokens are in group order."""
    size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    at_b = np.cumsum(size_b) - size_b
    at_a = np.cumsum(size_a) - size_a
    done = np.cumsum(size_a * size_b)
    low = 0
    while low < n_groups:
        base = done[low - 1] if low else 0
        high = max(int(np.searchsorted(done, base + SLICE_LINKS, side="right")), low + 1)
        if high == low + 1 and size_a[low] * size_b[low] > SLICE_LINKS:
            # A group too large to write out: each A token in turn.
            own_b = ids_b[at_b[low] : at_b[low] + size_b[low]]
            for a in ids_a[at_a[low] : at_a[low] + size_a[low]]:
                yield a * n_b + own_b, np.full(len(own_b), low)
        else:
            tokens = slice(at_a[low], at_a[high - 1] + size_a[high - 1])
            groups, n = group_a[tokens], size_b[group_a[tokens]]
            yield np.repeat(ids_a[tokens] * n_b, n) + ids_b[ragged(at_b[groups], n)], np.repeat(groups, n)
        low = high


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Aligned:
    """What a slice of texts gives: token and group counts, group strings, and linked pairs of every document."""

    def __init__(self, kit: Tokenizers, data: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        texts = [bytes(data[at[k] : at[k + 1]]).decode("utf-8", "replace") for k in range(n)]
        filled = np.diff(at) > 0
        lists_a, lists_b = kit.encode(texts)
        ids_a, n_a = _numbers(lists_a)
        ids_b, n_b = _numbers(lists_b)
        # The texts with a space before each.
        led = at + np.arange(n + 1)
        spelled = np.full(led[-1], ord(" "), np.uint8)
        spelled[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = data
        owner_a, owner_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        good = filled & _faithful(kit.flat_a, ids_a, owner_a, spelled, led) & _faithful(kit.flat_b, ids_b, owner_b, spelled, led)
        ids_a, owner_a = ids_a[good[owner_a]], owner_a[good[owner_a]]
        ids_b, owner_b = ids_b[good[owner_b]], owner_b[good[owner_b]]
        self.n_a, self.n_b = np.bincount(owner_a, minlength=n), np.bincount(owner_b, minlength=n)

        # Both token rows cover the same bytes, so ends can be counted over the whole slice.
        ends_a, ends_b = np.cumsum(kit.flat_a.size[ids_a]), np.cumsum(kit.flat_b.size[ids_b])
        n_bytes = int(ends_a[-1]) if len(ends_a) else 0
        shared = np.zeros(n_bytes + 1, bool)
        shared[ends_a] = True
        only_b = np.zeros(n_bytes + 1, bool)
        only_b[ends_b] = True
        shared &= only_b
        nth = np.cumsum(shared)
        group_a, group_b = nth[ends_a] - shared[ends_a], nth[ends_b] - shared[ends_b]
        n_borders = int(nth[-1])
        size_a, size_b = np.bincount(group_a, minlength=n_borders), np.bincount(group_b, minlength=n_borders)
        owner = owner_a[np.cumsum(size_a) - size_a]
        self.n_groups = np.bincount(owner, minlength=n)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, owner, size_a * size_b)
        self.sha = self._hashes(kit, ids_a, group_a, size_a, ids_b, group_b, size_b, n)
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for codes, groups in _expand(group_a, ids_a, group_b, ids_b, n_borders, kit.n_b):
            keys, counts = _merged(codes * BLOCK_DOCS + owner[groups], np.ones(len(codes), np.int64))
            self.keys, self.counts = np.r_[self.keys, keys], np.r_[self.counts, counts]
        self.keys, self.counts = _merged(self.keys, self.counts)

    def _hashes(self, kit, ids_a, group_a, size_a, ids_b, group_b, size_b, n) -> list[str]:
        """The hash of ``a1,a2|b1;a3|b2,b3`` of every document, built for all of them in one buffer."""
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        ids = np.zeros(len(ids_a) + len(ids_b), np.int64)
        place_a = np.arange(len(ids_a)) + before_b[group_a]
        place_b = np.arange(len(ids_b)) + before_a[group_b] + size_a[group_b]
        ids[place_a], ids[place_b] = ids_a, ids_b
        spelled = kit.digits.joined(ids)
        last = np.cumsum(kit.digits.size[ids]) - 1
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[np.cumsum(size_a) - 1]] = ord("|")
        mark[place_b[np.cumsum(size_b) - 1]] = ord(";")
        spelled[last] = mark
        ends = np.cumsum(self.n_a + self.n_b)
        view, hashes, begin = memoryview(spelled), [], 0
        for k in range(n):
            if not self.n_a[k]:
                hashes.append("")
                continue
            end = int(last[ends[k] - 1])
            hashes.append(hashlib.sha256(view[begin:end]).hexdigest())
            begin = end + 1
        return hashes


def compress(docs: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Members and planes of pairs that begin at ``first`` in ``docs`` (in order within a pair) and ``counts``."""
    sizes = np.diff(np.r_[first, len(docs)])
    top = np.maximum.reduceat(counts, first) - 1
    n_planes = np.ceil(np.log2(top + 1)).astype(np.int64)
    width = (sizes + 7) // 8
    plane_at = np.cumsum(n_planes * width) - n_planes * width
    bits = np.zeros(int((n_planes * width).sum()) * 8, bool)
    rank = ragged(np.zeros(len(first), np.int64), sizes)
    pair = np.repeat(np.arange(len(first)), sizes)
    for k in range(int(n_planes.max(initial=0))):
        has = (n_planes[pair] > k) & ((counts - 1) >> k & 1 > 0)
        bits[(plane_at[pair[has]] + k * width[pair[has]]) * 8 + rank[has]] = True
    planes = _blobs(np.packbits(bits, bitorder="little"), n_planes * width)

    as_bits = 2 * sizes > docs[first + sizes - 1] // 8 + 1
    lengths = np.where(as_bits, docs[first + sizes - 1] // 8 + 1, 2 * sizes) + 1
    at = np.cumsum(lengths) - lengths
    data = np.zeros(int(lengths.sum()), np.uint8)
    data[at] = as_bits
    listed = ~as_bits[pair]
    place = at[pair] + 1 + 2 * rank
    data[place[listed]], data[place[listed] + 1] = docs[listed] & 255, docs[listed] >> 8
    for k in np.flatnonzero(as_bits):
        flags = np.zeros((lengths[k] - 1) * 8, bool)
        flags[docs[first[k] : first[k] + sizes[k]]] = True
        data[at[k] + 1 : at[k] + lengths[k]] = np.packbits(flags, bitorder="little")
    return _blobs(data, lengths), planes


def _blobs(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def expand(members: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The way back: how many documents each pair has, the documents, and the multiplicity of each."""
    data, at = bytes_of(members)
    marks, marks_at = bytes_of(planes)
    as_bits = data[at[:-1]].astype(bool)
    length = np.diff(at) - 1
    sizes = length // 2
    own = [np.flatnonzero(np.unpackbits(data[at[k] + 1 : at[k + 1]], bitorder="little")) for k in np.flatnonzero(as_bits)]
    sizes[as_bits] = [len(docs) for docs in own]
    begin = np.cumsum(sizes) - sizes
    docs = np.zeros(int(sizes.sum()), np.int64)
    low = ragged(at[:-1][~as_bits] + 1, length[~as_bits]).reshape(-1, 2)
    docs[ragged(begin[~as_bits], sizes[~as_bits])] = data[low[:, 0]].astype(np.int64) + (data[low[:, 1]].astype(np.int64) << 8)
    if own:
        docs[ragged(begin[as_bits], sizes[as_bits])] = np.concatenate(own)
    width = (sizes + 7) // 8
    n_planes = np.diff(marks_at) // np.maximum(width, 1)
    bits = np.unpackbits(marks[marks_at[0] : marks_at[-1]], bitorder="little") if len(marks) else marks
    rank, pair = ragged(np.zeros(len(sizes), np.int64), sizes), np.repeat(np.arange(len(sizes)), sizes)
    counts = np.ones(len(docs), np.int64)
    for k in range(int(n_planes.max(initial=0))):
        has = np.flatnonzero(n_planes[pair] > k)
        at_bit = (marks_at[:-1][pair[has]] - marks_at[0] + k * width[pair[has]]) * 8 + rank[has]
        counts[has] += bits[at_bit].astype(np.int64) << k
    return sizes, docs, counts


class Block:
    """Documents of a task until a block is full, with the bitmaps of their pairs merged so far."""

    def __init__(self, number: int):
        self.number, self.docs = number, 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.links = 0

    def add(self, ids: pa.Array, found: Aligned) -> pa.RecordBatch:
        """Take in a slice; its rows of kind ``DOC``."""
        n = len(found.n_a)
        numbers = np.arange(self.docs, self.docs + n)
        self.keys.append(found.keys + self.docs)
        self.counts.append(found.counts)
        self.links += len(found.keys)
        self.docs += n
        none = {name: pa.nulls(n, _ARROW.field(name).type) for name in ("a", "b", "n_docs", "n_pair_links", "members", "planes")}
        columns = {
            "kind": np.full(n, DOC, np.int32), "block": np.full(n, self.number), "doc": numbers, "doc_id": ids, "n_a": found.n_a, "n_b": found.n_b,
            "n_groups": found.n_groups, "n_links": found.n_links, "groups_sha256": pa.array(found.sha, pa.string()), **none,
        }
        return pa.RecordBatch.from_pydict(columns, schema=_ARROW)

    def pairs(self, n_b: int) -> Iterator[pa.RecordBatch]:
        """The rows of kind ``PAIR``."""
        if not self.links:
            return
        # Slices hold different documents, so the OR of their bitmaps is the ordered union of their members.
        keys, counts = _merged(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts = [], []
        codes, docs = np.divmod(keys, BLOCK_DOCS)
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        step = 1 << 16
        for low in range(0, len(first), step):
            some = first[low : low + step]
            begin, end = some[0], first[low + step] if low + step < len(first) else len(docs)
            members, planes = compress(docs[begin:end], counts[begin:end], some - begin)
            a, b = np.divmod(codes[some], n_b)
            n = len(some)
            none = {name: pa.nulls(n, _ARROW.field(name).type) for name in ("doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            columns = {
                "kind": np.full(n, PAIR, np.int32), "block": np.full(n, self.number), "a": a.astype(np.int32), "b": b.astype(np.int32),
                "n_docs": np.diff(np.r_[some, end]), "n_pair_links": np.add.reduceat(counts[begin:end], some - begin),
                "members": members, "planes": planes, **none,
            }
            yield pa.RecordBatch.from_pydict(columns, schema=_ARROW)


def postings(docs: DataFrame, folder: str, file_a: str, file_b: str, text: str = "text") -> DataFrame:
    """Documents and the bitmaps of their pairs, written once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = tokenizers(folder, file_a, file_b)
        # Blocks are named after their task, which is the same when a lost one runs again.
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            data, at = bytes_of(texts)
            for low, high in slices(texts):
                for begin in range(low, high, BLOCK_DOCS):
                    end = min(begin + BLOCK_DOCS, high)
                    if block.links > BLOCK_LINKS or block.docs + end - begin > BLOCK_DOCS:
                        yield from block.pairs(kit.n_b)
                        number += 1
                        block = Block(number)
                    found = Aligned(kit, data[at[begin] : at[end]], at[begin : end + 1] - at[begin])
                    yield block.add(ids.slice(begin, end - begin), found)
        yield from block.pairs(kit.n_b)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw(text).alias("text"))
    return spool(slim.mapInArrow(scan, ROW_SCHEMA), by="kind")


def pair_counts(found: DataFrame) -> DataFrame:
    """``(a, b, n_docs, n_links, best)`` of every pair of ids: ``best`` if no pair of its A id has more documents."""
    pairs = found.where(F.col("kind") == PAIR)
    counted = spool(pairs.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_pair_links").alias("n_links")))
    most = broadcast_if_small(counted.groupBy("a").agg(F.max("n_docs").alias("most")))
    return counted.join(most, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    docs = docs.combine_chunks()
    n = docs.num_rows
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    slot = np.zeros(n, np.int64)
    slot[docs["doc"].to_numpy()] = np.arange(n)
    for batch in pairs.to_batches(max_chunksize=1 << 14):
        sizes, members, counts = expand(batch.column("members"), batch.column("planes"))
        at = slot[members]
        np.add.at(total, at, counts * np.repeat(batch.column("total").to_numpy(), sizes))
        np.add.at(best, at, counts * np.repeat(batch.column("best").to_numpy(zero_copy_only=False).astype(np.int64), sizes))
    columns = {name: docs[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(columns | {"n_best": best, "count_sum": total, "groups_sha256": docs["groups_sha256"]})


def align(
    docs: DataFrame, folder: str = TOKENIZERS, file_a: str = TOKENIZER_A, file_b: str = TOKENIZER_B, text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """One row per document with its token, group and link counts and scores; and the counts of all pairs of ids."""
    found = postings(docs, folder, file_a, file_b, text)
    pairs = spool(pair_counts(found))
    known = broadcast_if_small(pairs.select("a", "b", F.col("n_docs").alias("total"), "best"))
    worth = found.where(F.col("kind") == PAIR).join(known, ["a", "b"]).select(F.col("block").alias("pair_block"), "members", "planes", "total", "best")
    listed = found.where(F.col("kind") == DOC).select("block", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return listed.groupBy("block").cogroup(worth.groupBy("pair_block")).applyInArrow(_scored, SCORED_SCHEMA), pairs


def aligned_documents(spark, sf_dir) -> DataFrame:
    """Every document's counts, scores and the hash of its groups."""
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))[0]
