"""Exact duplicates: full texts in Patricia tries, one row of every group of equal texts stays.

Texts are equal when they agree after all white space (space, tab, line feed, vertical tab, form feed, carriage return)
is deleted. Of equal texts the row with the most code points stays, then the one with the smallest id (null last).

* Map side: every task puts its normalised texts into a compressed radix trie whose terminal nodes hold the owner and
  the number of rows, so a text that a third of all rows share leaves a task once. A trie that outgrows ``TRIE_BYTES``
  hands on its largest subtree and goes on.
* The terminals are dealt out by length and content hash and put, whole byte strings again, into the trie of their
  partition. Input comes in the order of these keys, so a subtree is finished and handed on when its key has passed:
  what is held at a time is the texts of one length and hash.
* A terminal is named by length and SHA-256 of its string; rows find their terminal by that name in a narrow join.

Null texts count as empty, and empty texts are equal to each other. Rows that repeat a ``doc_id`` and its text are one
document and stand or fall together. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import raw, table
from sluicebox.session import spool

WHITE = b" \t\n\x0b\x0c\r"
TRIE_BYTES = 32 * 1024 * 1024
OUT_BYTES = 4 * 1024 * 1024

TERMINALS = "n_bytes long, part long, content binary, n_rows long, n_chars long, owner long"


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    __slots__ = ("label", "children", "n_rows", "best")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.n_rows = 0
        self.best: tuple | None = None


class PatriciaTrie:
    """A compressed radix trie over byte strings with the owner and the row count at the terminals."""

    def __init__(self):
        self.root = Node(b"")
        self.held: dict[int, int] = {}  # bytes below each child of the root; -1: the empty string
        self.n_bytes = 0

    def insert(self, key: bytes, best: tuple, n_rows: int = 1) -> None:
        """``best`` sorts first for the owner that should stay."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self._grow(key, len(key) - at)
                node, at = child, len(key)
                continue
            if not key.startswith(child.label, at):
                shared = _common(child.label, key, at)
                upper = Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                child = upper
            node, at = child, at + len(child.label)
        if node.best is None or best < node.best:
            node.best = best
        node.n_rows += n_rows

    def _grow(self, key: bytes, n: int) -> None:
        self.held[key[0]] = self.held.get(key[0], 0) + n + 200
        self.n_bytes += n + 200

    def spill(self) -> Iterator[tuple[bytes, int, tuple]]:
        """Take the largest subtree out and return its terminals."""
        first = max(self.held, key=self.held.get)
        self.n_bytes -= self.held.pop(first)
        return _terminals(self.root.children.pop(first))

    def drain(self) -> Iterator[tuple[bytes, int, tuple]]:
        found = _terminals(self.root)
        self.__init__()
        return found


def _terminals(top: Node) -> Iterator[tuple[bytes, int, tuple]]:
    stack = [(b"", top)]
    while stack:
        above, node = stack.pop()
        whole = above + node.label
        if node.n_rows:
            yield whole, node.n_rows, node.best
        stack += [(whole, child) for child in node.children.values()]


def _batches(terminals: Iterator[tuple[bytes, int, tuple]], content: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows, strict=True)]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["n_bytes", "part", "content", "n_rows", "n_chars", "owner"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for text, n_rows, (less_chars, _, owner) in terminals:
        digest = hashlib.sha256(text).digest()
        part = int.from_bytes(digest[:8], "big", signed=True)
        rows.append((len(text), part, text if content else digest, n_rows, -less_chars, owner))
        size += len(text) + 100
        if size > OUT_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES, text: str = "text") -> DataFrame:
    """One row per distinct normalised text: ``n_bytes``, ``content`` (its SHA-256), ``n_rows``, ``n_chars``, ``owner``."""

    def local(batches):
        trie = PatriciaTrie()
        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id"), batch.column("raw"), strict=True):
                value, owner = value.as_py(), doc_id.as_py()
                trie.insert(value.translate(None, WHITE), (-_code_points(value), owner is None, owner))
                while trie.n_bytes > trie_bytes:
                    yield from _batches(trie.spill(), content=True)
        yield from _batches(trie.drain(), content=True)

    def whole(batches):
        def finished() -> Iterator[tuple[bytes, int, tuple]]:
            trie, key = PatriciaTrie(), None
            for batch in batches:
                for row in zip(*(batch.column(k) for k in ("n_bytes", "part", "content", "n_rows", "n_chars", "owner")), strict=True):
                    n_bytes, part, content, n_rows, n_chars, owner = (value.as_py() for value in row)
                    if key != (n_bytes, part):
                        yield from trie.drain()
                        key = n_bytes, part
                    trie.insert(content, (-n_chars, owner is None, owner), n_rows)
            yield from trie.drain()

        yield from _batches(finished(), content=False)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw(text).alias("raw"))
    partial = texts.mapInArrow(local, TERMINALS)
    dealt = partial.repartition("n_bytes", "part").sortWithinPartitions("n_bytes", "part")
    return dealt.mapInArrow(whole, TERMINALS).drop("part")


_BEGINS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)


def _code_points(value: bytes) -> int:
    """Bytes that begin a code point, which is their number in valid UTF-8."""
    return len(value) - len(value.translate(None, _BEGINS))


def exact_duplicates(docs: DataFrame, text: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``docs`` with the struct ``copies`` (in place of a column of that name): ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""

    @F.arrow_udf("struct<n_bytes: bigint, content: binary, n_chars: bigint>")
    def named(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            value = value.as_py()
            bare = value.translate(None, WHITE)
            rows.append((len(bare), hashlib.sha256(bare).digest(), _code_points(value)))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.binary(), pa.int64())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["n_bytes", "content", "n_chars"]
        )

    kept = spool(owners(docs, text=text, trie_bytes=trie_bytes))
    name = F.struct("n_bytes", "content").alias("name")
    found = kept.select(name, F.struct("owner", "n_rows", "n_chars").alias("of"))
    # The row is boxed, so its columns can have any names.
    boxed = docs.select(F.struct("*").alias("row"), named.asNondeterministic()(raw(text)).alias("own"))
    joined = boxed.withColumn("name", F.struct("own.n_bytes", "own.content")).join(found, "name")
    copies = F.struct(
        F.col("of.owner").alias("keep_id"),
        F.col("of.n_rows").alias("group_size"),
        (F.col("row.doc_id").eqNullSafe(F.col("of.owner")) & (F.col("own.n_chars") == F.col("of.n_chars"))).alias("kept"),
        F.lower(F.hex("own.content")).alias("text_sha256"),
    )
    others = [F.col(f"row.`{name}`") for name in docs.columns if name.lower() != "copies"]
    return joined.select(*others, copies.alias("copies"))


def exact_owners(spark, sf_dir) -> DataFrame:
    """Every document with the row that stays for its text, the size of its group and its digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_duplicates(docs).select("doc_id", "copies.*")
