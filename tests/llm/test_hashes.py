"""Repeated hashes against plain counting, and what a worked-off job leaves behind."""

from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicebox.llm import hashes, paragraphs
from sluicebox.session import CLEANUP_CONF, shared_dir, spool, worked_off

TEXT = " ".join(f"word{n}" for n in range(90))
ODD = [0, 1, -1, 2**63 - 1, -(2**63), 7 << 32]


def _pairs():
    draw = np.random.default_rng(5)
    pairs = [(int(key), int(tag)) for key, tag in zip(draw.integers(-60, 60, 150), draw.integers(0, 2, 150))]
    return pairs + [(key, tag) for key in ODD for tag in (3, -3)] + [(5 << 40, 1)] * 3 + [(6 << 40, 1)]


@pytest.mark.parametrize("tagged", [True, False])
@pytest.mark.parametrize("pack", [4, 1 << 20])
def test_repeated_hashes_equal_plain_counting(spark, monkeypatch, tagged, pack):
    monkeypatch.setattr(hashes, "PACK", pack)
    pairs = _pairs()
    tags, counts = defaultdict(set), defaultdict(int)
    for key, tag in pairs:
        tags[key].add(tag)
        counts[key] += 1

    def both(batches):
        hashes.PACK = pack
        for batch in batches:
            yield batch.column("key").to_numpy(), batch.column("tag").to_numpy() if tagged else None

    rows = spark.createDataFrame(pairs, "key long, tag long").repartition(3)
    found = {r["key"]: r["n"] for r in hashes.repeated(rows, both, "key").collect()}
    assert found == {key: n for key, n in counts.items() if (len(tags[key]) > 1 if tagged else n > 1)}
    assert hashes.repeated(rows.limit(0), both, "key").count() == 0


def _tables(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("spool-*")}


def test_worked_off_leaves_its_result_only(spark):
    before, setting = _tables(spark), spark.conf.get(CLEANUP_CONF)

    def work():
        inner = worked_off(spark, lambda: spool(spark.range(9)).where("id > 3"))
        return spool(inner.union(inner)).groupBy("id").agg(F.count("*").alias("n"))

    made = worked_off(spark, work)
    assert {(r["id"], r["n"]) for r in made.collect()} == {(n, 2) for n in range(4, 9)}
    assert len(_tables(spark) - before) == 1
    with pytest.raises(ZeroDivisionError):
        worked_off(spark, lambda: spool(spark.range(3)).where(str(1 // 0)))
    assert len(_tables(spark) - before) == 1
    assert spark.conf.get(CLEANUP_CONF) == setting


def test_paragraphs_leave_one_table_per_kind(spark, tmp_path):
    edited = TEXT.replace("word60", "other")
    rows = [(1, f"a line\n{TEXT} tail one"), (2, f"a line\n{TEXT} tail two"), (3, f"{edited} third"), (None, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = _tables(spark)
    found = paragraphs.repeated_paragraphs(spark, str(tmp_path)).collect()
    assert {"line", "passage", "near_passage"} <= {r["kind"] for r in found}
    assert len(_tables(spark) - before) == 4
