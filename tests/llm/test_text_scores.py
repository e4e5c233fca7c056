"""License scan, document statistics and the two learned scores against plain versions."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicebox.llm import gam, gbt, licenses, stats

SF_DIR = "/root/testdata/sf0.001"

ODD = [
    "",
    " \n\t ",
    "one",
    "a b c d e a b c d e x",
    "x x x x x x x",
    "line one\nline one\n\n\nline two\nline one",
    "ÄÖ ü | ## *** $5 %& <b>",
    "tab\tand\vfeed\fand\rreturn and more words here now",
    "no break is　one word",
    "word " * 3000,
    "cc by all rights reserved general public license cc by",
    "CC-BY 4.0; CC BY; ccby; cc\nby",
]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line in seen and re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += 1
        seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered))


def plain_license(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")):
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def texts_of(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(row[0], row[1]) for row in rows]


def frame(spark, texts):
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")


def test_counts_equal_plain_ones_over_whole_documents(spark):
    texts = [t for _, t in texts_of(spark)] + ODD
    found = stats.text_stats(pa.array([t.encode() for t in texts], pa.binary()))
    ours = list(zip(*(found[name].tolist() for name in stats.COUNTS), strict=True))
    assert ours == [plain_counts(t) for t in texts]


def test_features_do_not_depend_on_the_neighbours():
    whole = stats.matrix(stats.text_stats(pa.array([t.encode() for t in ODD], pa.binary())))
    alone = np.concatenate([stats.matrix(stats.text_stats(pa.array([t.encode()], pa.binary()))) for t in ODD])
    assert np.allclose(whole, alone)
    assert np.isfinite(whole).all()
    assert stats.matrix(stats.text_stats(pa.array([], pa.binary()))).shape == (0, len(stats.FEATURES))


def test_license_base_columns_equal_plain_ones(spark):
    texts = [t for _, t in texts_of(spark)] + ODD
    rows = licenses.scan_licenses(frame(spark, texts)).select("doc_id", "licenses.*").collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert [tuple(r[n] for n in names) for r in sorted(rows)] == [plain_license(t) for t in texts]
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows)


def test_license_rules_prefer_the_containing_notice():
    scanner = licenses.Scanner(licenses.rules())
    assert len(scanner.rules) >= 200
    found = scanner.scan(b"Licensed under the Apache License, Version 2.0.")
    assert found[5:] == ("apache-2.0", 0.9, [("apache-2.0", 0, 7)])
    assert scanner.scan(b"This emits apachelike text")[5] == ""
    both = scanner.scan(b"MIT License. SPDX-License-Identifier: BSD-3-Clause")
    assert both[5] == "bsd-3-clause,mit" and both[6] == 0.95


def test_suppression_keeps_what_no_stronger_rule_contains():
    import itertools

    def rule(priority):
        return licenses.Rule(str(priority), priority, 0.5, (), re.compile(b""))

    spans = [(a, b, rule(p)) for p, (a, b) in zip(itertools.cycle((3, 1, 2)), [(0, 9), (2, 5), (4, 12), (5, 9), (10, 12), (0, 20)], strict=False)]
    kept = licenses.suppress(spans)
    for span in spans:
        inside = any(o is not span and o[2].priority >= span[2].priority and o[0] <= span[0] and o[1] >= span[1] for o in spans)
        assert (span in kept) == (not inside)


def test_lookup_tables_add_up_and_learn_an_interaction():
    draw = np.random.default_rng(3)
    rows = draw.random((4000, len(stats.FEATURES)))
    labels = ((rows[:, 2] > 0.5) ^ (rows[:, 5] > 0.5)).astype(float)
    model = gam.fit(rows[:3000], labels[:3000])
    assert (2, 5) in model.pairs
    right = (model.score(rows[3000:]) >= 0.5) == (labels[3000:] == 1)
    assert right.mean() > 0.8
    one = rows[:1]
    total = model.base + sum(t[np.searchsorted(c, one[0, k], side="right")] for k, (c, t) in enumerate(zip(model.cuts, model.tables, strict=True)))
    for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
        total += t[np.searchsorted(model.pair_cuts[a], one[0, a], side="right"), np.searchsorted(model.pair_cuts[b], one[0, b], side="right")]
    assert model.score(one)[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_forest_never_rises_with_a_falling_feature():
    draw = np.random.default_rng(4)
    rows = draw.random((3000, len(stats.FEATURES)))
    k = stats.FEATURES.index("symbol_ratio")
    labels = ((rows[:, k] * 4 % 1 > 0.5) | (rows[:, 0] > 0.7)).astype(float)
    forest = gbt.fit(rows, labels)
    probe = np.repeat(rows[:200], 21, 0)
    probe[:, k] = np.tile(np.linspace(0, 1, 21), 200)
    assert (np.diff(forest.score(probe).reshape(200, 21), axis=1) <= 1e-12).all()
    assert len(forest.feature) == len(forest.value) > gbt.ROUNDS


@pytest.mark.parametrize("module", [gam, gbt])
def test_one_class_or_no_label_keeps_everything_or_nothing(module):
    rows = np.random.default_rng(5).random((50, len(stats.FEATURES)))
    assert (module.fit(rows, np.ones(50)).score(rows) > 0.9).all()
    assert (module.fit(rows, np.zeros(50)).score(rows) < 0.1).all()
    assert (module.fit(rows[:0], np.zeros(0)).score(rows) > 0.9).all()


def test_classifiers_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = gam.quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.9
    judged = gbt.judge_documents(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in judged]) > 0.9


def test_scores_of_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame(
        [(1, None, "x", 5), (None, "some words", "y", 6), (3, "", None, None), (3, "", None, None), (4, "w " * 50_000, "z", 7)],
        "doc_id long, text string, score string, rules int",
    )
    for docs, n in ((odd, 5), (odd.limit(0), 0)):
        assert gam.score(docs, gam.train(docs, labels)).count() == n
        assert gbt.quality_rules(docs, gbt.train(docs, labels)).select("rules.kept").count() == n
        assert licenses.scan_licenses(docs.withColumn("licenses", F.lit(1))).select("licenses.score").count() == n


CLEAN = [
    "Er kam mit dem Zug und ging mit ihr nach Hause. Mit der Lizenz hat das nichts zu tun.",
    "Je vais avec toi au marché; la licence de pêche est valable un an.",
    "Ella vino con su hermano y no dijo nada de la licencia.",
    "He studied at MIT and drove home, commit by commit, with an eclipse in the sky or a bus.",
]
NAMED = {
    "Released under the MIT License.": "mit", "SPDX-License-Identifier: MIT": "mit", "licensed under MIT": "mit", "(MIT OR Apache-2.0)": "apache-2.0,mit",
    "Apache-2.0 OR MIT": "apache-2.0,mit", "MPL-2.0": "mpl-2.0", "SPDX-License-Identifier: EPL-2.0": "epl-2.0", "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
    "GNU General Public License v3": "gpl,gpl-3.0", "under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
}


def test_plain_texts_have_no_license_and_named_ones_theirs():
    scanner = licenses.Scanner(licenses.rules())
    assert [scanner.scan(text.encode())[5] for text in CLEAN] == [""] * len(CLEAN)
    assert {text: scanner.scan(text.encode())[5] for text in NAMED} == NAMED
