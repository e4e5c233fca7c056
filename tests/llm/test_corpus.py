"""Mixing, packing, chat formatting and the pipeline against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import compare, connect
from sluicebox.llm import chat, gam, mixing, packing, registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, registry.QUERIES[name], registry.SQL[name], SF_DIR) is None


def odd_documents(spark):
    rows = [
        (1, None, "en", "src1", 0), (2, "", None, None, 0), (None, "one two", "en", "src0", 7), (None, "one two", "en", "src0", 7),
        (3, "a b c", "xx", "no number", 5), (3, "a b c", "xx", "no number", 5), (4, "w " * 9000, "de", "src2", None), (5, "z " * 2048, "de", "src1", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def give(total, nodes):
    """Budgets of ``{name: (capacity, weight)}``: fill by weight, whole shortages to the others, again and again."""
    budget, open_nodes = {}, {n for n, (c, w) in nodes.items() if c and w}
    budget = dict.fromkeys(nodes, 0)
    left = Fraction(total)
    while open_nodes:
        weight = sum(nodes[n][1] for n in open_nodes)
        full = {n for n in open_nodes if nodes[n][0] * weight <= nodes[n][1] * left}
        if not full:
            for n in open_nodes:
                budget[n] = int(left * nodes[n][1] / weight)
            break
        for n in full:
            budget[n] = nodes[n][0]
        left -= sum(nodes[n][0] for n in full)
        open_nodes -= full
    return budget


def test_budgets_redistribute_among_siblings_first(spark):
    leaves = [("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "de", "s1", 10), ("b", "en", "s3", 50), ("b", "fr", "s4", 400), ("c", "en", "s5", 5000), ("c", "en", "s6", 0)]
    weights = {"domain": {"a": 3, "b": 2, "c": 1}, "lang": {"en": 2}, "source": {"s1": 5}}
    weight = lambda level, name: weights[level].get(name, 1)
    for total in (0, 100, 900, 2000, 6000, 20_000):
        found = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), total, weights, 2).collect()}
        capacity = Counter()
        for d, lang, s, t in leaves:
            for depth, path in enumerate([(d,), (d, lang), (d, lang, s)]):
                capacity[path] += 2 * t
        want = {(): total}
        for depth, level in enumerate(mixing.TREE):
            for parent in [p for p in want if len(p) == depth]:
                nodes = {p: (c, weight(level, p[-1])) for p, c in capacity.items() if len(p) == depth + 1 and p[:-1] == parent}
                want |= give(want[parent], nodes)
        assert found == {p: b for p, b in want.items() if len(p) == 3}


def test_mix_of_odd_tables(spark):
    docs = odd_documents(spark).withColumn("mix", F.lit(1)).withColumn("path", F.lit(2))
    found = mixing.mix(docs)
    assert found.count() == 8 and sorted(found.columns) == sorted(docs.columns)
    rows = found.select("doc_id", "mix.*").collect()
    assert all(0 <= r["copies"] <= mixing.EPOCHS for r in rows)
    taken = sum(r["copies"] * r["n_tokens"] for r in rows)
    assert taken <= sum(r["n_tokens"] for r in rows) * mixing.SHARE[0] // mixing.SHARE[1]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_leaf_without_ids_gets_its_budget(spark):
    rows = [(None, f"word{k} a b", "en", "src0", 0) for k in range(1000)] + [(k, "one two three", "de", "src0", 0) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_cut long").withColumn("mix_path", F.lit("mine"))
    taken = mixing.mix(docs, share=(1, 2))
    n = {r["lang"]: r["n"] for r in taken.groupBy("lang").agg(F.sum(F.col("mix.copies") * F.col("mix.n_tokens")).alias("n")).collect()}
    assert 2990 <= n["en"] + n["de"] <= 3000 and n["en"] > 1500
    assert {(r["mix_path"], r["mix_cut"]) for r in taken.collect()} == {("mine", 0)}


def plain_pack(pieces, capacity, apart):
    foes = {frozenset(p) for p in apart}
    bins, out = [], []
    for n, source, cluster in pieces:
        fitting = [
            (room, k) for k, (room, held) in enumerate(bins)
            if room >= n and all(c != cluster and frozenset((s, source)) not in foes for s, c in held)
        ]
        room, k = min(fitting, default=(capacity, len(bins)))
        if k == len(bins):
            bins.append([capacity, []])
        out.append((k, capacity - room))
        bins[k][0] -= n
        bins[k][1].append((source, cluster))
    return out


def test_packing_equals_plain_best_fit():
    import random

    draw = random.Random(4)
    sources = [None, "src0", "src0", "src0", "src1", "src2", "src3", "src4"]
    for _ in range(20):
        pieces = sorted(((draw.randint(1, 60), draw.choice(sources), draw.randint(0, 25)) for _ in range(150)), key=lambda p: -p[0])
        assert packing.pack(pieces, 64, packing.APART) == plain_pack(pieces, 64, packing.APART)


def test_packing_of_many_copies_equals_plain_best_fit():
    import random

    draw = random.Random(9)
    for copies in (1, 40, 150):
        pieces = [(12, draw.choice(["src1", "src2", "other", None]), 1) for _ in range(copies)]
        pieces += [(draw.choice([12, 13, 30]), draw.choice(["src2", "src3", "src4"]), draw.choice([1, 2, 3, 4, 5])) for _ in range(200)]
        pieces += [(draw.randint(1, 40), None, 100 + draw.randint(0, 400)) for _ in range(200)]
        pieces.sort(key=lambda p: -p[0])
        assert packing.pack(pieces, 64, packing.APART) == plain_pack(pieces, 64, packing.APART)


def test_packing_passes_over_conflicts_without_walking_them():
    import time

    started = time.perf_counter()
    places = packing.pack([(12, "src0", 1)] * 60_000 + [(6, None, 2)] * 60_000, packing.CAPACITY, packing.APART)
    assert time.perf_counter() - started < 60
    assert [b for b, _ in places] == [*range(60_000)] * 2


def check_bins(rows, docs, capacity):
    """Every token once, no bin too full, no two pieces of a cluster and no parted sources in a bin."""
    words = {(i, s): n for i, s, n in docs}
    held, whole = defaultdict(list), Counter()
    for r in rows:
        held[r["shard"], r["bin"]].append(r)
        whole[r["doc_id"], r["cluster"]] += r["n_tokens"]
        assert r["first_token"] == r["piece"] * capacity
    for pieces in held.values():
        places = sorted((r["bin_offset"], r["n_tokens"]) for r in pieces)
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
        assert sum(n for _, n in places) <= capacity
        assert len({r["cluster"] for r in pieces}) == len(pieces)
    assert sum(whole.values()) == sum(words.values())


def test_packed_documents_keep_every_token(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counted = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()]
    for shard_tokens in (packing.SHARD_TOKENS, 20_000):
        rows = packing.best_fit(docs, shard_tokens=shard_tokens).collect()
        check_bins(rows, counted, packing.CAPACITY)
        sources = {i: s for i, s, _ in counted}
        bins = defaultdict(set)
        for r in rows:
            bins[r["shard"], r["bin"]].add(sources[r["doc_id"]])
        assert not any(set(pair) <= found for pair in packing.APART for found in bins.values())
    odd = packing.best_fit(odd_documents(spark)).collect()
    assert sum(r["n_tokens"] for r in odd) == 2 + 2 + 3 + 3 + 9000 + 2048
    assert packing.best_fit(odd_documents(spark).limit(0)).count() == 0


def plain_chat(turns):
    out = {}
    talks = defaultdict(set)
    for conv, turn, role, text in turns:
        talks[conv].add((turn, role or "unknown", text or ""))
    for conv, said in talks.items():
        for speaker in {r for _, r, _ in said}:
            parts = defaultdict(lambda: ["", [], [], 0])
            for turn, role, text in sorted(said, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])):
                part = parts[(turn or 0) // chat.PART_TURNS]
                part[0] += "<|assistant|>\n" if role == speaker else f"<|user name={role}|>\n"
                if role == speaker:
                    part[1].append(len(part[0]))
                part[0] += text + "<|end|>\n"
                if role == speaker:
                    part[2].append(len(part[0]))
                part[3] += 1
            for number, (text, starts, ends, n) in parts.items():
                out[conv, speaker, number] = (text, n, ",".join(map(str, starts)), ",".join(map(str, ends)))
    return out


def test_perspectives_of_odd_conversations(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "ho"), (1, 3, "ann", None), (1, 3, "ann", None), (1, 3, "bob", "é😀"),
        (2, None, None, "alone"), (2, None, "x", ""), (None, 5, "x", "lost"), (3, 64, "x", "next part"), (3, 1, "y", "first part"), (4, 0, "z", "long " * 9000),
    ]
    frame = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, part string")
    rows = chat.perspectives(frame).collect()
    found = {(r["conv_id"], r["speaker"], r["part"]): (r["rendered"], r["n_turns"], r["mask_starts"], r["mask_ends"]) for r in rows}
    assert len(found) == len(rows) and found == plain_chat(turns)
    assert all(r["part_chars"] == len(r["rendered"]) and r["section"] == 0 for r in rows)
    assert chat.perspectives(frame.limit(0)).count() == 0


def test_a_crowded_part_is_cut_into_sections(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_ROWS", 10)
    frame = spark.createDataFrame([(1, 0, "x", f"text {k}") for k in range(95)], "conv_id long, turn long, role string, text string")
    rows = chat.perspectives(frame).collect()
    assert len(rows) == 10 and sum(r["n_turns"] for r in rows) == 95


def test_sections_joined_are_the_dialogue(spark, monkeypatch):
    turns = [(c, k % 3 if k % 7 else None, "xyz"[k % 2], f"text {k * 37 % 101}") for c in (1, None) for k in range(95)] + [(2, k, "x", "t") for k in range(200)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    view = lambda rows: {
        key: "".join(r["rendered"] for r in sorted(rows, key=lambda r: (r["part"], r["section"])) if (r["conv_id"], r["speaker"]) == key)
        for key in {(r["conv_id"], r["speaker"]) for r in rows}
    }
    whole = chat.perspectives(frame, part_turns=1000).collect()
    monkeypatch.setattr(chat, "PART_ROWS", 10)
    cut = chat.perspectives(frame).collect()
    assert len(cut) > 3 * len(whole) and view(cut) == view(whole)
    assert all(r["n_turns"] <= 10 for r in cut if r["conv_id"] != 2)


def test_chat_uses_no_python(spark):
    plan = chat.rotated_chats(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_stages_return_the_columns_of_documents_and_nothing_new(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = list(corpus_pipeline.COLUMNS)
    model = gam.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = [tuple(r) for r in docs.select(*columns).collect()]
        after_frame = stage(spark, docs, SF_DIR)
        assert after_frame.columns == columns
        after = [tuple(r) for r in after_frame.collect()]
        assert set(after) <= set(before), name
        if number == 0:
            scores = {r["doc_id"]: r["score"] for r in gam.score(docs, model).collect()}
            assert sorted(after) == sorted(r for r in before if scores[r[0]] >= gam.THRESHOLD)
        if number == 1:
            bare = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r[1])
            best = {}
            for r in before:
                best[bare(r)] = min(best.get(bare(r), (0, 1 << 62)), (-len(r[1]), r[0]))
            assert sorted(r[0] for r in after) == sorted(i for _, i in best.values())
        if number == 2:
            classes = corpus_pipeline.simhash.near_duplicates(docs).collect()
            assert sorted(r[0] for r in after) == sorted({r["component_id"] for r in classes})
        if number == 3:
            taken = {r["doc_id"]: r["mix"]["copies"] for r in mixing.mix(docs).collect()}
            assert Counter(r[0] for r in after) == Counter({i: n for i, n in taken.items() if n})
        docs = spark.createDataFrame(after, docs.select(*columns).schema)


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    odd = documents.limit(40).union(odd_documents(spark)).withColumn("score", F.lit("clash")).withColumn("version", F.lit(0))
    for name, frame in (("odd", odd), ("empty", odd.limit(0))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert (found.count() > 0) == (name == "odd")


def test_copies_without_or_with_equal_ids_are_reduced_to_one(spark):
    line = "many words stand in this line and again in the next one "
    rows = [(None, line * 9)] * 3 + [(None, line * 9 + " ")] * 2 + [(7, "short text")] * 3 + [(None, "short  text")] + [(8, "a b c"), (8, "a bc")]
    docs = spark.createDataFrame([(*r, "en", f"src{k}", k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    after = corpus_pipeline.drop_copies(spark, docs, SF_DIR).collect()
    assert sorted(r["text"].replace(" ", "") for r in after) == sorted({t.replace(" ", "") for _, t in rows})
    near = [(None, line * 40), (None, line * 40 + "x"), (None, line * 40 + "y"), (None, line * 40), (3, "other words altogether here and there")]
    docs = spark.createDataFrame([(*r, "en", f"src{k}", k) for k, r in enumerate(near)], docs.schema)
    after = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()
    assert len(after) == 2 and {r["doc_id"] for r in after} == {None, 3}


def test_pipeline_packs_what_the_last_stage_kept(spark):
    docs = corpus_pipeline.table(spark, SF_DIR, "documents").select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.spool(stage(spark, docs, SF_DIR))
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect())
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.agg(F.sum("n_tokens")).first()[0] == words
    assert hashlib.md5(repr(sorted(map(tuple, packed.collect()))).encode()).digest() == hashlib.md5(repr(sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))).encode()).digest()
