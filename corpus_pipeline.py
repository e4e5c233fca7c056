"""The corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator on all that the stage before it kept; all but the last return the columns of
``documents``. Between stages the rows are written as Parquet and read again, so a lost executor repeats one stage at
most. Rows are named by ``doc_id`` and a hash of their text. Rows that share an id only are judged one by one. Of copies
and of near copies one row stays, whether or not they have ids: of rows with the same id, or without one, the row with the
least hash, and of rows that repeat both id and text the one with the least other columns. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm import gam, mixing, packing, simhash, trie
from sluicebox.llm.common import raw, table
from sluicebox.session import broadcast_if_small, ship_package, spool

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows named by ``dropped(doc_id, version)``; only these names are moved while they are few."""
    gone = broadcast_if_small(spool(dropped.select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version")).distinct()))
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(raw()) == gone["gone_version"])
    return docs.join(gone, same, "left_anti")


def _tied(kept: DataFrame, group: str) -> DataFrame:
    """Of rows that stay for one ``group`` all but those of its least version: ids that are null or repeat don't choose one."""
    both = kept.groupBy(group).agg(F.min("version").alias("least"), F.max("version").alias("most")).where("least < most")
    least = broadcast_if_small(spool(both.select(group, "least")))
    return kept.join(least, group).where("version > least").select("doc_id", "version")


def _once(docs: DataFrame) -> DataFrame:
    """``docs`` with rows that agree in id and text reduced to one; nothing else is moved."""
    names = docs.groupBy(F.col("doc_id").alias("again_id"), F.xxhash64(raw()).alias("again_version")).agg(F.count("*").alias("n"))
    again = broadcast_if_small(spool(names.where("n > 1").drop("n")))
    if again.isEmpty():
        return docs
    same = docs["doc_id"].eqNullSafe(again["again_id"]) & (F.xxhash64(raw()) == again["again_version"])
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    repeated = docs.join(again, same, "left_semi").groupBy("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one = repeated.agg(F.min(F.struct(*others)).alias("others")).select("doc_id", "text", "others.*")
    return docs.join(again, same, "left_anti").unionByName(one)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labelled rows of ``docs``."""
    ship_package(spark)
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    scored = gam.score(docs, model, "pipeline_score")
    return scored.where(F.col("pipeline_score") >= gam.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal normalised texts."""
    ship_package(spark)
    judged = trie.exact_duplicates(docs.select("doc_id", "text", F.xxhash64(raw()).alias("version")))
    judged = spool(judged.select("doc_id", "version", "copies.kept", "copies.text_sha256"))
    dropped = judged.where("not kept").select("doc_id", "version").unionByName(_tied(judged.where("kept"), "text_sha256"))
    return _once(_without(docs, dropped))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class of linked fingerprints."""
    ship_package(spark)
    classes = spool(simhash.near_duplicates(docs))
    kept = classes.where("doc_id is not distinct from component_id")
    dropped = classes.where("doc_id is distinct from component_id").select("doc_id", "version")
    return _once(_without(docs, dropped.unionByName(_tied(kept, "root"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship_package(spark)
    mixed = mixing.mix(docs).where("mix.copies > 0")
    return mixed.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in its training sequence."""
    ship_package(spark)
    return packing.best_fit(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Learned scores, tries, fingerprints and packing have no SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
