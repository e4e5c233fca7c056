"""Sharding, fill-in-middle and token alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicebox.llm import alignment, middle, sharding

SF_DIR = "/root/testdata/sf0.001"


# ---- sharding ------------------------------------------------------------------------------------------------------


def plain_place(number, n, seed=sharding.SEED):
    """Where a row number goes, step by step."""
    high, wide = sharding.grid(n)
    while True:
        y, x = divmod(number, wide)
        for r in range(sharding.ROUNDS):
            shift = int(hashlib.md5(f"{seed}:{r}:{y if r % 2 else x}".encode()).hexdigest()[:8], 16)
            if r % 2:
                x = (x + shift) % wide
            else:
                y = (y + shift) % high
        number = y * wide + x
        if number < n:
            return number


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 31, 257, 1000])
def test_shuffle_is_a_permutation_and_can_be_undone(spark, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("slot"), (F.col("id") * 2).alias("other column"))
    found = {r["doc_id"]: r for r in sharding.shuffled(rows.repartition(5), ["doc_id"]).collect()}
    assert {k: (r["row_number"], r["slot"] * 8 + r["shard"]) for k, r in found.items()} == {k: (k, plain_place(k, n)) for k in range(n)}
    sizes = Counter(r["shard"] for r in found.values())
    assert n < 8 or max(sizes.values()) - min(sizes.values()) <= 1
    assert all({r["slot"] for r in found.values() if r["shard"] == s} == set(range(sizes[s])) for s in sizes)
    assert all(r["other column"] == 2 * k for k, r in found.items())
    if n:
        places = spark.createDataFrame([(r["shard"], r["slot"]) for r in found.values()] + [(8, 0), (0, n), (None, 1)], "shard int, slot long")
        back = {(r["shard"], r["slot"]): r["row_number"] for r in sharding.row_numbers(places, n).collect()}
        assert all(back[r["shard"], r["slot"]] == k for k, r in found.items())
        assert back[8, 0] is None and back[0, n] is None and back[None, 1] is None


def test_grid_holds_every_number_and_little_more():
    for n in [*range(1, 300), 10**6, 10**12 + 7]:
        high, wide = sharding.grid(n)
        assert n <= high * wide < n + high


def test_shards_do_not_depend_on_partitions_and_equal_rows_are_dealt_out(spark):
    rows = [(None, "a")] * 40 + [(7, "b")] * 3 + [(k, "") for k in range(40)]
    one, many = (sharding.shuffled(spark.createDataFrame(rows, "doc_id long, text string").repartition(k), ["doc_id", "text"]) for k in (1, 9))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    assert one.count() == len(rows) and one.select("shard", "slot").distinct().count() == len(rows)
    assert one.orderBy("row_number").first()["doc_id"] is None


def test_shard_query_has_no_python_in_its_plan(spark):
    plan = sharding.shard_documents(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- fill-in-middle ------------------------------------------------------------------------------------------------


def plain_middle(doc_id, text, rate=100):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts_of_lines(seed, n):
    draw = random.Random(seed)
    parts = ["\n", "\n\n", "ä", "日本", "<", "<P", ">", "P>", "S>", "<M>", "word ", "x" * 50, "", "\r\n", "😀"]
    return ["".join(draw.choices(parts, k=draw.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("rate", [100, 60])
def test_middles_agree_with_plain_version(spark, rate):
    texts = [None, "", "\n", "a", "a\n", "\na", "<P>", "x<P", ">y", *texts_of_lines(rate, 600), "line\n" * 60_000]
    rows = [(k if k % 50 else None, t, "mine") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim string")
    built = middle.fill_in_middle(docs, rate=rate)
    found = built.withColumn("back", middle.restored(F.col("fim.output"), F.col("fim.form")).cast("string"))
    got = sorted((r["doc_id"] or -1, r["text"] or "", *r["fim"][:4], bytes(r["fim"]["output"]).decode(), r["back"]) for r in found.collect())
    want = sorted(((k or -1, t or "", *plain_middle(k, t, rate), t or "") for k, t, _ in rows))
    key = lambda row: repr(row)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {"plain", "psm", "spm"} <= {r[3] for r in got}


def test_middle_of_other_bytes_and_empty_table(spark):
    odd = spark.createDataFrame([(1, b"a\xff\n\xfeb\n"), (2, b"\xff" * 9)], "doc_id long, bytes binary").select("doc_id", F.col("bytes").cast("string").alias("text"))
    built = middle.fill_in_middle(odd)
    back = built.select("doc_id", middle.restored(F.col("fim.output"), F.col("fim.form")).alias("back"))
    assert {r["doc_id"]: bytes(r["back"]) for r in back.collect()} == {1: b"a\xff\n\xfeb\n", 2: b"\xff" * 9}
    assert middle.fill_in_middle(odd.limit(0)).count() == 0


def test_output_without_its_sentinels_is_taken_as_it_is(spark):
    rows = [("psm", b"<S>a<P>b<M>c"), ("spm", b"plain words"), (None, b"<P>"), ("psm", None), ("psm", b"<P>a<S>b<M>c")]
    docs = spark.createDataFrame(rows, "form string, output binary")
    back = docs.select(middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(bytes(r["back"]) for r in back) == sorted([b"<S>a<P>b<M>c", b"plain words", b"<P>", b"", b"acb"])


# ---- token alignment -----------------------------------------------------------------------------------------------


def plain_tokens(kit, text):
    """Ids and end places of both tokenizers, or None if one of them doesn't give the text back."""
    whole = (" " + text).encode()
    both = []
    for ids, flat in zip(kit.encode([text]), (kit.flat_a, kit.flat_b)):
        pieces = [bytes(flat.joined(np.array([k]))) for k in ids[0]]
        if b"".join(pieces) != whole:
            return None
        ends, end = [], 0
        for piece in pieces:
            end += len(piece)
            ends.append(end)
        both.append((ids[0], ends))
    return both


def plain_alignment(kit, rows):
    """Digest columns of every ``(doc_id, text)`` and the pairs' document and link counts."""
    seen = []
    for doc_id, text in rows:
        found = plain_tokens(kit, text) if text else None
        if not found:
            seen.append((doc_id, 0, 0, [], Counter()))
            continue
        (a, ends_a), (b, ends_b) = found
        groups = []
        links = Counter()
        low = 0
        for end in sorted(set(ends_a) & set(ends_b)):
            own_a = [k for k, e in zip(a, ends_a) if low < e <= end]
            own_b = [k for k, e in zip(b, ends_b) if low < e <= end]
            groups.append((own_a, own_b))
            links.update((x, y) for x in own_a for y in own_b)
            low = end
        seen.append((doc_id, len(a), len(b), groups, links))
    docs, times = Counter(), Counter()
    for *_, links in seen:
        docs.update(links.keys())
        times.update(links)
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, n_a, n_b, groups, links in seen:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(n for pair, n in links.items() if docs[pair] == best[pair[0]])
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), n_best, sum(n * docs[pair] for pair, n in links.items()), sha))
    return out, docs, times


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", "hello world", "Hello, <|endoftext|> <s> </s> <unk> world", "a▁b", "ünïcödé 日本語 😀 ​ x", "x" * 3000, " " * 500,
    "tab\tand\r\nfeed", "<0x41> ▁", "aaa bbb aaa bbb " * 40, "lone \x00 zero", "é combining", "ﬁ ligature", "1234567890 " * 30,
]


def test_alignment_agrees_with_plain_version(spark, monkeypatch):
    kit = alignment.tokenizers(alignment.TOKENIZERS, alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(ODD_TEXTS + texts + ODD_TEXTS[:6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("extra")).repartition(3)
    want, n_docs, n_links = plain_alignment(kit, rows)
    found, pairs = alignment.align(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in pairs.collect()} == {p: (n, n_links[p]) for p, n in n_docs.items()}


def test_alignment_of_empty_table_and_other_bytes(spark):
    odd = spark.createDataFrame([(1, b"a\xffb"), (2, b"\xed\xa0\x80")], "doc_id long, bytes binary").select("doc_id", F.col("bytes").cast("string").alias("text"))
    assert sorted(tuple(r) for r in alignment.align(odd)[0].collect()) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]
    assert alignment.align(odd.limit(0))[0].count() == 0


def test_bitmaps_and_planes_come_back(monkeypatch):
    draw = np.random.default_rng(3)
    docs, counts, first = [], [], []
    for size in [1, 2, 5000, 40_000, 3, 1, 17]:
        first.append(len(docs))
        docs += sorted(draw.choice(1 << 16, size, replace=False).tolist())
        counts += (draw.integers(1, 9, size) if size % 2 else np.ones(size, int)).tolist()
    members, planes = alignment.compress(np.array(docs), np.array(counts), np.array(first))
    assert len(members[3].as_py()) < 2 * 40_000
    sizes, back, times = alignment.expand(members, planes)
    assert sizes.tolist() == np.diff([*first, len(docs)]).tolist() and back.tolist() == docs and times.tolist() == counts
    low = pa.concat_arrays([members, members]).slice(2, 7), pa.concat_arrays([planes, planes]).slice(2, 7)
    assert alignment.expand(*low)[0].tolist() == [*sizes.tolist()[2:], *sizes.tolist()[:2]]


def test_small_blocks_and_large_groups_give_the_same(monkeypatch):
    kit = alignment.tokenizers(alignment.TOKENIZERS, alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    texts = [t.encode() for t in ("ab cd ef " * 20, "日本語のテキスト" * 30, "x", "")]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    whole = alignment.Aligned(kit, data, at)
    monkeypatch.setattr(alignment, "SLICE_LINKS", 2)
    parts = alignment.Aligned(kit, data, at)
    assert whole.keys.tolist() == parts.keys.tolist() and whole.counts.tolist() == parts.counts.tolist() and whole.sha == parts.sha


def test_sizes_and_sums_of_sharded_documents(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in sharding.shard_documents(spark, SF_DIR).collect():
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
