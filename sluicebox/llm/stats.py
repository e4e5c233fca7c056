"""Statistics of whole texts, computed for a slice of texts at a time.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return, so a character
outside ASCII is part of a word. All counts cover the whole text.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import bytes_of, raw, slices

WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# The inputs of the learned scores: ratios, so that they mean the same for short and long texts, and two log sizes.
FEATURES = (
    "log_words",
    "mean_word_chars",
    "symbol_ratio",
    "dup_line_ratio",
    "repeat_word_ratio",
    "upper_ratio",
    "digit_ratio",
    "bang_ratio",
    "bar_ratio",
    "stop_ratio",
    "distinct_word_ratio",
    "stutter_ratio",
    "words_per_line",
    "short_word_ratio",
)


class _Numbers(dict):
    """Numbers words in the order they first appear."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _table(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[np.frombuffer(members, np.uint8)] = True
    return found


SPACE = _table(b" \t\n\x0b\x0c\r")
SYMBOL = _table(b"#*$%&|<>")
UPPER = _table(bytes(range(65, 91)))
LOWER = _table(bytes(range(97, 123)))
DIGIT = _table(b"0123456789")
BANG = _table(b"!?")
BAR = _table(b"|")
STOP = _table(b".,;:")
INNER = np.zeros(256, bool)
INNER[0x80:0xC0] = True  # bytes inside a UTF-8 character

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    running = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, dtype=running.dtype, out=running[1:])
    return (running[at[1:]] - running[at[:-1]]).astype(np.int64)


def _repeated_words(ids: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``size`` words that occurs twice or more in the same text.

    ``first`` holds the position of the first word of each text and, last, the number of words. Windows are grouped by
    a hash and only windows whose hash repeats are compared word by word.
    """
    covered = np.zeros(len(ids) + 1, np.int64)
    n = len(ids) - size + 1
    if n <= 1:
        return covered[:-1].astype(bool)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(text[:n] == text[size - 1 :])
    key = text[whole].astype(np.uint64)
    for k in range(size):
        key = (key ^ (key >> np.uint64(29))) * _MIX + ids[whole + k].astype(np.uint64)
    key = (key ^ (key >> np.uint64(32))) * _MIX
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    candidates = whole[order[again]]
    seen: dict[tuple, list[int]] = {}
    for start, window in zip(candidates.tolist(), np.stack([text[candidates], *(ids[candidates + k] for k in range(size))], 1).tolist(), strict=True):
        seen.setdefault(tuple(window), []).append(start)
    for starts in seen.values():
        if len(starts) > 1:
            covered[starts] += 1
            np.subtract.at(covered, np.array(starts) + size, 1)
    return np.cumsum(covered[:-1]) > 0


def _duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[bytes] = set()
    found = 0
    for line in lines:
        if line in seen:
            found += bool(line.strip(b" \t\n\x0b\x0c\r"))
        seen.add(line)
    return found


def _of_slice(texts: pa.Array) -> dict[str, np.ndarray]:
    data, at = bytes_of(texts)
    data, at = data[at[0] : at[-1]], at - at[0]
    in_word = ~SPACE[data]
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    borders = at[1:-1][at[1:-1] < len(data)]
    begins[borders] = in_word[borders]
    n_words = _per_text(begins, at)
    values = texts.to_pylist()
    known = _Numbers()
    ids = np.fromiter(chain.from_iterable(map(known.__getitem__, text.split()) for text in values), np.int64)
    first = np.concatenate([[0], np.cumsum(n_words)])
    stutter = np.zeros(len(ids), bool)
    stutter[1:] = ids[1:] == ids[:-1]
    stutter[first[:-1][first[:-1] < len(ids)]] = False
    by_text = np.repeat(np.arange(len(values)), n_words)
    pairs = np.sort(by_text * (len(known) + 1) + ids)
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = pairs[1:] != pairs[:-1]
    owners = pairs[fresh] // (len(known) + 1)
    lengths = np.array([len(word) for word in known], np.int64)
    short = lengths[ids] <= 3 if len(ids) else np.zeros(0, bool)
    upper, lower = _per_text(UPPER[data], at), _per_text(LOWER[data], at)
    out = {
        "n_words": n_words,
        "word_chars": _per_text(in_word & ~INNER[data], at),
        "n_symbols": _per_text(SYMBOL[data], at),
        "n_dup_lines": np.array([_duplicate_lines(text) for text in values], np.int64),
        "n_repeat_words": _per_text(_repeated_words(ids, first), first),
    }
    chars = np.maximum(out["word_chars"], 1)
    words = np.maximum(n_words, 1)
    lines = np.array([text.count(b"\n") + 1 for text in values], np.int64)
    out |= {
        "log_words": np.log1p(n_words),
        "mean_word_chars": out["word_chars"] / words,
        "symbol_ratio": out["n_symbols"] / chars,
        "dup_line_ratio": out["n_dup_lines"] / lines,
        "repeat_word_ratio": out["n_repeat_words"] / words,
        "upper_ratio": upper / np.maximum(upper + lower, 1),
        "digit_ratio": _per_text(DIGIT[data], at) / chars,
        "bang_ratio": _per_text(BANG[data], at) / chars,
        "bar_ratio": _per_text(BAR[data], at) / chars,
        "stop_ratio": _per_text(STOP[data], at) / words,
        "distinct_word_ratio": np.bincount(owners, minlength=len(values)) / words,
        "stutter_ratio": _per_text(stutter, first) / words,
        "words_per_line": n_words / lines,
        "short_word_ratio": _per_text(short, first) / words,
    }
    return out


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts and features of each text of a binary array without nulls."""
    parts = [_of_slice(texts.slice(low, high - low)) for low, high in slices(texts)]
    names = (*COUNTS, *FEATURES)
    if not parts:
        return {name: np.zeros(0) for name in names}
    return {name: np.concatenate([part[name] for part in parts]) for name in names}


def matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([np.asarray(stats[name], np.float64) for name in FEATURES], 1)


def labelled_features(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample ``(doc_id, label)``, on the driver.

    The sample is bounded by its own limit, so it is sent to the executors; no text is shuffled.
    """

    def features(batches):
        for batch in batches:
            found = matrix(text_stats(batch.column("raw")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *(pa.array(column) for column in found.T)],
                ["doc_id", "label", *FEATURES],
            )

    schema = "doc_id long, label int, " + ", ".join(f"{name} double" for name in FEATURES)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw().alias("raw"))
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "raw")
    found = joined.mapInArrow(features, schema).dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return found[list(FEATURES)].to_numpy(np.float64), found["label"].to_numpy(np.float64)
