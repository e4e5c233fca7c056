"""Exact, near, paragraph and substring duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sluicebox.llm import paragraphs, repeats, simhash, trie
from sluicebox.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


class Sets(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def documents(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


ODD = [
    (1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "on e"), (1005, "ONE two three four"), (1006, "one two three four"),
    (1007, "x " * 40_000), (1008, "x " * 40_000), (1009, "y" * 500), (1010, "same words " * 60), (1010, "same words " * 60),
    (None, "no id at all"), (None, "no id at all"), (1011, "no id at all "),
]


def odd_frame(spark, more=()):
    rows = [(i, t, "clash", 1) for i, t in [*ODD, *more]]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, copies int")


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[bare].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for bare, members in groups.items():
        best = min(members)
        digest = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[2], best[2], len(members), m == best, digest) for m in members]
    return sorted(out, key=repr)


def test_exact_groups_equal_plain_ones(spark):
    rows = documents(spark) + ODD
    docs = odd_frame(spark, documents(spark))
    for budget in (trie.TRIE_BYTES, 4096):
        found = trie.exact_duplicates(docs, trie_bytes=budget)
        assert found.columns == docs.columns
        got = [tuple(r) for r in found.select("doc_id", "copies.*").select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
        assert sorted(got, key=repr) == plain_groups(rows)
    assert trie.exact_duplicates(docs.limit(0)).count() == 0


def test_trie_holds_what_was_put_in():
    draw = random.Random(5)
    words = [bytes(draw.choices(b"ab", k=draw.randint(0, 12))) for _ in range(2000)]
    tree = trie.PatriciaTrie()
    for n, word in enumerate(words):
        tree.insert(word, (0, False, n))
    spilled = list(tree.spill())
    found = {key: (n, best[2]) for key, n, best in [*spilled, *tree.drain()]}
    assert found == {w: (n, words.index(w)) for w, n in Counter(words).items()}
    assert len({key[0] for key, _, _ in spilled}) == 1 and tree.n_bytes == 0


def plain_code(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_classes_equal_brute_force(spark):
    rows = documents(spark) + ODD
    found = simhash.near_duplicates(odd_frame(spark, documents(spark))).collect()
    assert len(found) == len(rows)
    codes = [plain_code(t) for _, t in rows]
    sets = Sets()
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 4:
                sets.join(i, j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[sets.root(i)].append(doc_id)
    named = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    want = sorted(((d, codes[i], named[sets.root(i)]) for i, (d, _) in enumerate(rows)), key=repr)
    assert sorted(((r["doc_id"], r["code"] & (1 << 64) - 1, r["component_id"]) for r in found), key=repr) == want
    assert simhash.near_duplicates(odd_frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("cell_rows", [20_000, 40])
def test_gray_index_finds_every_link(spark, cell_rows):
    draw = np.random.default_rng(9)
    seeds = draw.integers(0, 1 << 63, 60, dtype=np.uint64)
    codes = {int(s) ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 6), replace=False)) for s in np.repeat(seeds, 8)}
    codes |= set(range(200))  # one dense ball, in one cell of four blocks
    listed = sorted(codes)
    sets = Sets()
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= 4:
                sets.join(b, a)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in listed], "code long")
    edges = simhash.hamming_forest(frame, 4, cell_rows).collect()
    ours = Sets()
    mask = (1 << 64) - 1
    for r in edges:
        ours.join(r["a"] & mask, r["b"] & mask)
    groups = lambda s: {frozenset(x for x in listed if s.root(x) == r) for r in {s.root(x) for x in listed}}
    assert groups(ours) == groups(sets)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (300, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 160), 100) | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_forest_that_differs_at_every_reading(spark):
    def star(batches):
        for batch in batches:
            nodes = batch.column("id").to_pylist()
            middle = random.SystemRandom().choice(nodes)
            rest = [n for n in nodes if n != middle]
            yield pa.RecordBatch.from_arrays([pa.array([middle] * len(rest)), pa.array(rest)], ["a", "b"])

    edges = spark.range(0, 40, 1, 1).mapInArrow(star, "a long, b long")
    for _ in range(3):
        assert {(r["node"], r["root"]) for r in components(edges).collect()} == {(k, 0) for k in range(40)}


def plain_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), text in zip(rows, texts, strict=True):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc_id, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [repeats.HOT_CONTEXTS, 1])
def test_repeats_equal_brute_force(spark, hot):
    draw = random.Random(2)
    base = "".join(draw.choices("abc ", k=900))
    made = [(2000 + k, base[draw.randint(0, 300) :][: draw.randint(150, 600)] + "".join(draw.choices("abc ", k=90))) for k in range(30)]
    made += [(2100, base + base), (2101, "ab" * 400), (2102, "z" * 199), (2103, "z" * 200), (2104, "q" * 201)]
    docs = odd_frame(spark, made)
    found = repeats.without_repeats(docs, hot=hot).drop("kept")
    got = sorted((tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)
    assert got == plain_repeats(ODD + made, 200)
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_repeats_across_chunks_of_a_long_text(monkeypatch):
    draw = np.random.default_rng(3)
    text = draw.integers(97, 101, 5000, dtype=np.uint8)
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    cut = repeats.anchors(text)
    windows = lambda a: {w: (h, p) for h, p, f, e in zip(*(x.tolist() for x in a), strict=True) for w in range(f, e + 1)}
    assert windows(whole) == windows(cut) and len(windows(cut)) == 4801


def test_maximal_repeats_by_definition():
    draw = random.Random(8)
    gram = b"g" * repeats.GRAM
    contexts = [(n, bytes(draw.choices(b"xy", k=n)) + gram + bytes(draw.choices(b"xy", k=m))) for n, m in [(draw.randint(0, 9), draw.randint(0, 9)) for _ in range(40)]]
    length = repeats.GRAM + 6
    for (at, text), covers in zip(contexts, repeats.maximal_repeats(contexts, length), strict=True):
        covered = {k for a, b in covers for k in range(a, b)}
        want = set()
        for other_at, other in contexts:
            if other is text:
                continue
            left = repeats.lcp(text[:at][::-1], other[:other_at][::-1])
            right = repeats.lcp(text[at:], other[other_at:])
            if left + right >= length:
                want |= set(range(at - left, at + right))
        assert covered == want


def plain_clusters(rows):
    found = []
    for doc_id, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            words = re.findall(rb"[^\x20\x09-\x0D]+", line.encode().lower())
            if len(words) >= 50:
                found.append((doc_id, number, {tuple(words[i : i + 5]) for i in range(len(words) - 4)}))
    sets = Sets()
    for i, (_, _, a) in enumerate(found):
        for j in range(i):
            b = found[j][2]
            if len(a & b) / len(a | b) >= 0.8:
                sets.join(i, j)
    groups = defaultdict(list)
    for i, (doc_id, number, _) in enumerate(found):
        groups[sets.root(i)].append((doc_id is None, doc_id, number))
    out = []
    for members in groups.values():
        if len(members) > 1:
            out += [(m[1], m[2], len(members), min(members)[1], m != min(members)) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell_rows", [2_000, 5])
def test_paragraph_clusters_equal_brute_force(spark, cell_rows):
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [draw.choices(vocabulary, k=70) for _ in range(6)]
    made = []
    for k in range(60):
        line = list(draw.choice(base))
        for _ in range(draw.randint(0, 2)):
            line[draw.randrange(70)] = draw.choice(vocabulary)
        made.append((3000 + k, " ".join(draw.choices(vocabulary, k=60)) + "\n" + " ".join(line)))
    rows = documents(spark) + ODD + made
    found = paragraphs.duplicate_paragraphs(odd_frame(spark, documents(spark) + made), cell_rows=cell_rows).collect()
    got = sorted(((r["doc_id"], r["paragraph"], r["cluster_size"], r["keep_doc_id"], r["removed"]) for r in found), key=repr)
    assert got == plain_clusters(rows)
    assert paragraphs.duplicate_paragraphs(odd_frame(spark).limit(0)).count() == 0


def test_bands_are_tuned_for_recall():
    bands, rows = paragraphs.tune()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert 1 - (1 - 0.3**rows) ** bands <= 0.15


def test_hex_of_a_name_is_the_same_in_spark(spark):
    row = spark.createDataFrame([(-5, 7)], "p long, q long")
    assert row.select(F.lower(F.concat(F.lpad(F.hex("p"), 16, "0"), F.lpad(F.hex("q"), 16, "0")))).first()[0] == paragraphs._hex(-5, 7)


def test_shared_passages_equal_brute_force(spark):
    rng = random.Random(3)

    def prose(n):
        return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]

    passages = [prose(50), prose(51), prose(70)]
    spliced = []
    for k in range(30):
        words, cut = prose(rng.randrange(20, 120)), rng.randrange(20)
        inner = passages[k % 3]
        parts = [*words[:cut], *(w.upper() if rng.random() < 0.1 else w for w in inner), *words[cut:]]
        spliced.append((2000 + k, "".join(w + rng.choice([" ", "\n", "  "]) for w in parts)))
    clean = [(3000 + k, " ".join(prose(200))) for k in range(10)]
    given = documents(spark) + ODD + spliced + clean
    found = paragraphs.shared_passages(odd_frame(spark, documents(spark) + spliced + clean)).collect()

    words = [(doc_id, (text or "").encode().lower().split()) for doc_id, text in given]
    holders = defaultdict(set)
    for size in (40, 50):
        for row, (_, w) in enumerate(words):
            for k in range(len(w) - size + 1):
                holders[tuple(w[k : k + size])].add(row)
    shown = {r["doc_id"] for r in found}
    must = {words[row][0] for piece, rows in holders.items() if len(piece) == 50 and len(rows) > 1 for row in rows}
    may = {words[row][0] for piece, rows in holders.items() if len(piece) == 40 and len(rows) > 1 for row in rows}
    assert must <= shown <= may
    assert {2000 + k for k in range(30)} <= shown and not shown & {3000 + k for k in range(10)}
    texts = defaultdict(list)
    for doc_id, text in given:
        texts[doc_id].append((text or "").encode())
    for r in found:
        own = [t[r["start"] : r["start"] + r["n_bytes"]].lower().split() for t in texts[r["doc_id"]]]
        kept = [t[r["keep_start"] :].lower().split()[:40] for t in texts[r["keep_doc_id"]]]
        assert any(len(w) == r["n_words"] and w[:40] in kept for w in own)
    # All later holders of a passage that was spliced in point at the first, which points at no other document.
    made = [r for r in found if 2000 <= r["doc_id"] < 2030]
    assert all((r["keep_doc_id"] - r["doc_id"]) % 3 == 0 and r["removed"] == (r["keep_doc_id"] != r["doc_id"]) for r in made)
    first = {r["doc_id"] for r in made if r["removed"] and r["keep_doc_id"] == 2000 + (r["doc_id"] - 2000) % 3}
    assert first == set(range(2003, 2030)) and not any(r["removed"] for r in made if r["doc_id"] < 2003)
    assert paragraphs.shared_passages(odd_frame(spark).limit(0)).count() == 0


def units_of_any_length(rows, wrapped):
    for doc_id, text in rows:
        lines = [re.findall(rb"[^\x20\x09-\x0D]+", line.encode().lower()) for line in (text or "").split("\n")]
        units = [(n, w) for n, w in enumerate(lines) if w]
        if wrapped:
            units = [] if all(lines) else [(n, sum(lines[n : (lines + [[]]).index([], n)], [])) for n, w in units if not n or not lines[n - 1]]
        for number, words in units:
            yield doc_id, number, {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


@pytest.mark.parametrize("wrapped", [False, True])
def test_paragraphs_of_any_length_equal_brute_force(spark, wrapped):
    draw = random.Random(12)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [draw.choices(vocabulary, k=n) for n in (2, 4, 5, 9, 12, 30, 49, 60, 80)]
    given = list(ODD)
    for k in range(70):
        words = list(draw.choice(base))
        if len(words) > 20 and k % 2:
            words[draw.randrange(len(words))] = "changed"
        lines = [" ".join(words[i : i + 8]) for i in range(0, len(words), 8)] if k % 3 else [" ".join(words)]
        own = " ".join(draw.choices(vocabulary, k=20))
        given.append((5000 + k, "\n".join([own, *([""] if k % 7 else []), *lines, " \t", "short line", own[::-1]])))
    frame = odd_frame(spark, given[len(ODD) :])
    found = list(units_of_any_length(given, wrapped))
    sets = Sets()
    for i, (_, _, a) in enumerate(found):
        for j in range(i):
            b = found[j][2]
            if len(a & b) / len(a | b) >= 0.8:
                sets.join(i, j)
    groups = defaultdict(list)
    for i, (doc_id, number, _) in enumerate(found):
        groups[sets.root(i)].append((doc_id is None, doc_id, number))
    want = {(m[1], m[2], len(g), min(g)[1], m != min(g)) for g in groups.values() if len(g) > 1 for m in g}
    rows = paragraphs.duplicate_paragraphs(frame, min_words=1, wrapped=wrapped).collect()
    got = {(r["doc_id"], r["paragraph"], r["cluster_size"], r["keep_doc_id"], r["removed"]) for r in rows}
    texts = dict(given)
    if wrapped:  # clusters of one-line paragraphs alone are found among the lines
        many = {r["cluster_id"] for r in rows if (texts[r["doc_id"]] or "").encode()[r["start"] : r["start"] + r["n_bytes"]].count(b"\n")}
        assert got <= want and {r["cluster_id"] for r in rows} == many and len(many) > 4
        whole = {(d, n) for d, n, *_ in want if len((texts[d] or "").split("\n")) > n + 1 and (texts[d] or "").split("\n")[n + 1].split()}
        assert whole <= {g[:2] for g in got}
    else:
        assert got == want and {len(texts[d].split("\n")[n].split()) for d, n, *_ in got} >= {2, 4, 5}


def test_every_place_of_a_passage_in_one_text_is_shown(spark):
    draw = random.Random(21)

    def prose(n):
        return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]

    alone, both = prose(60), prose(60)
    texts = {
        7000: [*prose(30), *alone, *prose(30), *alone, *prose(20), *alone],
        7001: [*prose(15), *both, *prose(25)],
        7002: [*both, *prose(30), *both, *prose(10)],
        7003: prose(300),
        7004: ["z"] * 130,
    }
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")
    rows = paragraphs.shared_passages(frame, every=True).collect()
    spans = defaultdict(list)
    for r in rows:
        raw = " ".join(texts[r["doc_id"]])
        first = len(raw[: r["start"]].split())
        assert raw[r["start"] : r["start"] + r["n_bytes"]].split() == texts[r["doc_id"]][first : first + r["n_words"]]
        spans[r["doc_id"]].append((first, r["n_words"], r["keep_doc_id"], r["removed"], r["cluster_size"]))
    places = {7000: [(30, False), (120, True), (200, True)], 7001: [(15, False)], 7002: [(0, True), (90, True)]}
    for doc_id, want in places.items():
        got = sorted(spans[doc_id])
        keep = 7000 if doc_id == 7000 else 7001
        assert [g[2:] for g in got] == [(keep, gone, 3) for _, gone in want]
        assert all(at <= g[0] <= at + 10 and g[0] + g[1] <= at + 60 for g, (at, _) in zip(got, want, strict=True))
    assert sorted(spans[7004]) == [(0, 40, 7004, False, 3), (40, 80, 7004, True, 3)] and 7003 not in spans
    assert {r["doc_id"] for r in paragraphs.shared_passages(frame).collect()} == {7001, 7002}


@pytest.mark.parametrize("start_rows", [paragraphs.START_ROWS, 0])
def test_edited_passages_inside_other_words_are_linked(spark, start_rows):
    draw = random.Random(33)

    def prose(n):
        return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]

    given, want = [], []
    for k in range(12):
        inner = prose(60)
        edited = [*inner[:30], "changed", *inner[31:]]
        given += [(8000 + 2 * k, " ".join([*prose(90), *inner, *prose(80)])), (8001 + 2 * k, " ".join([*prose(70), *edited, *prose(95)]))]
        want += [(8000 + 2 * k, 8000 + 2 * k, False), (8001 + 2 * k, 8000 + 2 * k, True)]
    given += [(9000, "z " * 300), (9001, " ".join(prose(300))), (None, None)]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    rows = paragraphs.near_passages(frame, start_rows=start_rows).collect()
    made = [r for r in rows if r["doc_id"] != 9000]
    assert sorted({(r["doc_id"], r["keep_doc_id"], r["removed"]) for r in made}) == want
    texts = dict(given)
    for r in made:
        words = texts[r["doc_id"]][r["start"] : r["start"] + r["n_bytes"]].split()
        assert len(words) == r["n_words"] >= 50 and "changed" in words or not r["removed"]
    assert paragraphs.near_passages(frame.limit(0)).count() == 0


def test_links_of_pieces_equal_brute_force_for_crowded_starts(spark):
    draw = random.Random(40)
    begin = ["alpha", "beta", "gamma", "delta"]
    base = [draw.choices([f"w{k}" for k in range(90)], k=46) for _ in range(8)]
    lines = []
    for _ in range(120):
        words = list(draw.choice(base))
        words[draw.randrange(46)] = draw.choice(["x", "y"])
        lines.append(begin + words)
    rows = [(-7, k, " ".join(words).encode()) for k, words in enumerate(lines)] + [(9, -1, b"alone in its start")]
    frame = spark.createDataFrame([*rows, rows[0]], "p long, q long, words binary")
    sets = Sets()
    for i, (p, q, a) in enumerate(rows):
        for j, (other, _, b) in enumerate(rows[:i]):
            x, y = (paragraphs.shingles(t.split()) for t in (a, b))
            if p == other and len(x & y) / len(x | y) >= 0.8:
                sets.join(i, j)
    names = [paragraphs._hex(p, q) for p, q, _ in rows]
    want = {frozenset(n for k, n in enumerate(names) if sets.root(k) == root) for root in {sets.root(k) for k in range(len(rows))}}
    want = {group for group in want if len(group) > 1}
    banded = paragraphs._begun_bands(frame.dropDuplicates(["p", "q"]))
    for links in (paragraphs._cell_links(frame, ["p"], 0.8), paragraphs.paragraph_links(banded, frame, cell_rows=30)):
        found = Sets()
        for a, b in links.collect():
            found.join(names.index(a), names.index(b))
        got = {frozenset(n for k, n in enumerate(names) if found.root(k) == root) for root in {found.root(k) for k in range(len(rows))}}
        assert {group for group in got if len(group) > 1} == want and len(want) > 3


def test_exact_copies_of_other_bytes_and_clashing_names(spark):
    rows = [(1, b"a\xff b"), (2, b"a\xffb"), (3, b"\xc3\xa4 "), (4, b"\xc3\xa4")]
    docs = spark.createDataFrame(rows, "doc_id long, bytes binary").select("doc_id", F.col("bytes").cast("string").alias("text"))
    docs = docs.withColumns({"copies_name": F.lit("n"), "copies_own": F.lit("o"), "copies_of": F.lit("f"), "row": F.lit("r")})
    found = trie.exact_duplicates(docs)
    assert {r["doc_id"]: (r["copies"]["keep_id"], r["copies"]["kept"]) for r in found.collect()} == {1: (1, True), 2: (1, False), 3: (3, True), 4: (3, False)}
    assert {(r["copies_name"], r["copies_own"], r["copies_of"], r["row"]) for r in found.collect()} == {("n", "o", "f", "r")}


@pytest.mark.parametrize("often", [paragraphs.OFTEN, 3, 1])
def test_links_within_cells_equal_brute_force(monkeypatch, often):
    monkeypatch.setattr(paragraphs, "OFTEN", often)
    draw = random.Random(5)
    vocabulary = [b"w%d" % k for k in range(40)]
    base = [draw.choices(vocabulary, k=k) for k in (3, 5, 9, 30, 50)]
    texts, ends = [], []
    for n in (1, 40, 130, 3):
        for _ in range(n):
            words = list(draw.choice(base))
            if draw.random() < 0.7:
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(b" ".join(words))
        ends.append(len(texts))
    want = Sets()
    for low, high in zip([0, *ends], ends, strict=False):
        for i in range(low, high):
            for j in range(low, i):
                a, b = (paragraphs.shingles(texts[k].split()) for k in (i, j))
                if len(a & b) / len(a | b) >= 0.8:
                    want.join(i, j)
    got = paragraphs._linked(texts, 0.8, ends).tolist()
    assert len({(g, want.root(k)) for k, g in enumerate(got)}) == len(set(got)) == len({want.root(k) for k in range(len(texts))}) < len(texts)


def test_starts_of_few_pieces_need_no_rounds_of_joins(spark, monkeypatch):
    draw = random.Random(51)
    inner = draw.choices([f"w{k}" for k in range(500)], k=60)
    given = [(k, " ".join([*inner[:20], f"edit{k % 70}", *inner[21:], f"end{k}"])) for k in range(90)]
    frame = spark.createDataFrame(given, "doc_id long, text string")

    def refused(edges):
        raise AssertionError("a start of few pieces is settled in its cell")

    monkeypatch.setattr(paragraphs, "components", refused)
    for start_rows in (paragraphs.START_ROWS, 80):  # 90 places, 70 different pieces
        rows = paragraphs.near_passages(frame, start_rows=start_rows).collect()
        assert {r["doc_id"] for r in rows} == set(range(90)) and {r["keep_doc_id"] for r in rows} == {0}
        assert {r["doc_id"] for r in rows if r["removed"]} == set(range(1, 90))
