"""Mixing sources to target weights: a token budget goes down a tree of domains, languages and sources.

Every node gives its budget to its children by weight. A child that has not enough tokens (counted ``epochs`` times)
takes what it has, and what it leaves goes to its siblings by their weights; only what a whole subtree cannot use goes
to the siblings of an ancestor. With children in the order of tokens per weight this has a closed form: running sums
over the small table of nodes, no loop.

A leaf's budget is whole epochs plus a prefix of one more. Each epoch has its own order, by MD5 of seed, epoch, id and text;
the prefix is the longest that fits. Its end is found by two histograms over hash prefixes and one sort inside the
last cell, about one in 16 million rows of the leaf, so a source that holds a third of all rows is never sorted in one
task. Rows then compare their own hash with their leaf's cut: no text is shuffled.

Tokens are words. Null languages and sources are the node ``unknown``; null texts have no tokens and come along with
every epoch; rows that agree in id and text share one place in the order and
are taken together. Without any token nothing is taken. Weights
are whole numbers of 0 or more; a node without one weighs 1.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import raw, table
from sluicebox.llm.packing import n_words
from sluicebox.session import broadcast_if_small, spool

SEED = 20
EPOCHS = 2
SHARE = (4, 5)
WEIGHTS = {
    "domain": {"d0": 3, "d1": 3, "d2": 2, "d3": 2},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 4},
}
TREE = ("domain", "lang", "source")
CELL = 3  # hexadecimal digits a histogram looks at


def domain_of(source: Column) -> Column:
    """The domain of a source, as these tables have none: the number at the end of its name, modulo 4."""
    number = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("bigint") % 4).cast("string"))).otherwise(F.lit("other"))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level) or {}
    if not given:
        return F.lit(1).cast("long")
    pairs = [F.lit(x) for name, weight in given.items() for x in (name, weight)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1)).cast("long")


def _give(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """``nodes(…, capacity, weight, above)`` with ``budget``: their share of the parent's budget ``above``."""
    usable = nodes.withColumn("usable", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0)).cast("long"))
    by_need = Window.partitionBy(*parent).orderBy(F.expr("usable / greatest(weight, 1)"), level)
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("above") - F.coalesce(F.sum("usable").over(before), F.lit(0))
    full = F.col("usable") * F.sum("weight").over(after) <= F.col("weight") * left
    judged = usable.withColumn("is_full", full | (F.col("usable") == 0))
    whole = Window.partitionBy(*parent)
    rest = F.col("above") - F.sum(F.when(F.col("is_full"), F.col("usable")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("is_full"), 0).otherwise(F.col("weight"))).over(whole)
    shared = judged.withColumn("rest", rest).withColumn("open_weight", open_weight)
    part = F.expr("(weight * rest) div greatest(open_weight, 1)")
    given = shared.withColumn("budget", F.when(F.col("is_full"), F.col("usable")).otherwise(part).cast("long"))
    return given.drop("usable", "is_full", "rest", "open_weight", "above")


def budgets(leaves: DataFrame, total: int, weights: Mapping[str, Mapping[str, int]], epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` with the ``budget`` that reaches each of them."""
    known = leaves.withColumn("capacity", F.col("tokens") * epochs)
    given = None
    for depth, level in enumerate(TREE):
        parent, path = list(TREE[:depth]), list(TREE[: depth + 1])
        nodes = known.groupBy(*path).agg(F.sum("capacity").cast("long").alias("capacity")).withColumn("weight", _weight(level, weights))
        if given is None:
            nodes = nodes.withColumn("above", F.lit(total).cast("long"))
        else:
            nodes = nodes.join(given.select(*parent, F.col("budget").alias("above")), parent)
        given = _give(nodes, parent, level)
    return leaves.join(given.select(*TREE, "budget"), list(TREE))


def _order(epoch: Column, doc_id: Column, version: Column, seed: int) -> Column:
    """The place of a row in an epoch; ``version`` is the MD5 of its text, so rows without an id have places too."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")), version))


def mix(
    docs: DataFrame,
    share: tuple[int, int] = SHARE,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = SEED,
    domain=domain_of,
    text: str = "text",
) -> DataFrame:
    """``docs`` with the struct ``mix`` (in place of a column of that name): domain, language, source, ``n_tokens`` and ``copies``, how often to take it.

    The budget is the given share (numerator, denominator) of all tokens.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit("unknown"))
    path = F.struct(
        domain(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("lang"),
        source.alias("source"),
    )
    tree = list(TREE)
    version = F.md5(raw(text))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), n_words(text).alias("n_tokens"), version.alias("version"))
    sized = spool(named.select("doc_id", "path.*", "n_tokens", "version"))
    leaves = spool(sized.groupBy(*tree).agg(F.sum("n_tokens").alias("tokens")))
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * share[0] // share[1]
    given = budgets(leaves, total, weights, epochs).select(
        *tree,
        F.expr("coalesce(try_divide(budget - budget % nullif(tokens, 0), tokens), 0)").cast("long").alias("whole"),
        F.coalesce(F.expr("budget % nullif(tokens, 0)"), F.lit(0)).cast("long").alias("rest"),
    )
    leaf = broadcast_if_small(spool(given))
    ranked = sized.join(leaf, tree).where("rest > 0").withColumn("place", _order(F.col("whole"), F.col("doc_id"), F.col("version"), seed))
    for depth in (1, 2):
        ranked = _last_cell(ranked, tree, depth * CELL)
    fits = Window.partitionBy(*tree).orderBy("place", F.col("doc_id").asc_nulls_first())
    upto = ranked.withColumn("upto", F.sum("n_tokens").over(fits)).where("upto <= rest")
    ends = upto.groupBy(*tree).agg(F.max(F.struct("place", "doc_id")).alias("end"))
    # The last cell itself where nothing of it fits: all cells before it are taken.
    cells = ranked.groupBy(*tree).agg(F.min(F.substring("place", 1, 2 * CELL)).alias("cell"))
    cuts = spool(given.join(cells, tree, "left").join(ends, tree, "left"))
    named = F.struct(*tree, "whole", "rest", "cell", "end").alias("cut")
    cut = broadcast_if_small(cuts.select(F.struct(*tree).alias("path"), named))
    # The row is boxed, so its columns can have any names.
    boxed = docs.select(F.struct("*").alias("row"), path.alias("path"), version.alias("version"), n_words(text).alias("n_tokens"))
    placed = boxed.join(cut, "path")
    place = _order(F.col("cut.whole"), F.col("row.doc_id").cast("long"), F.col("version"), seed)
    own = F.struct(place.alias("place"), F.col("row.doc_id").cast("long").alias("doc_id"))
    inside = F.when(F.col("cut.rest") == 0, F.lit(False)).otherwise(
        (F.substring(place, 1, 2 * CELL) < F.col("cut.cell")) | F.coalesce(own <= F.col("cut.end"), F.lit(False))
    )
    found = F.struct("path.*", "n_tokens", (F.col("cut.whole") + F.coalesce(inside, F.lit(False)).cast("long")).alias("copies"))
    others = [F.col(f"row.`{name}`") for name in docs.columns if name.lower() != "mix"]
    return placed.select(*others, found.alias("mix"))


def _last_cell(ranked: DataFrame, tree: list[str], digits: int) -> DataFrame:
    """Only the rows of the hash cell where the prefix ends, with ``rest`` less what comes before the cell."""
    cell = F.substring("place", 1, digits)
    sums = ranked.groupBy(*tree, cell.alias("cell")).agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*tree).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("tokens").over(running), F.lit(0)))
    last = before.where("before <= rest").groupBy(*tree).agg(F.max(F.struct("cell", "before")).alias("last"))
    ends = broadcast_if_small(spool(last.select(*tree, "last.*")))
    inside = ranked.join(ends, tree).where(cell == F.col("cell"))
    return inside.withColumn("rest", F.col("rest") - F.col("before")).drop("cell", "before")


def mixed_sources(spark, sf_dir) -> DataFrame:
    """Every document with its place in the tree, its tokens and how often the mix takes it."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")).select("doc_id", "mix.*")


def _sql_weight(level: str) -> str:
    given = "".join(f" WHEN '{name}' THEN {weight}" for name, weight in WEIGHTS[level].items())
    return f"CAST(CASE {level}{given} ELSE 1 END AS HUGEINT)"


def _sql_level(depth: int) -> str:
    level, parent = TREE[depth], ", ".join(TREE[:depth])
    path = ", ".join(TREE[: depth + 1])
    by, using = (f"PARTITION BY {parent}", f"JOIN given{depth} USING ({parent})") if depth else ("", "CROSS JOIN goal")
    above = f"given{depth}.budget" if depth else "goal.budget"
    return f"""
nodes{depth} AS (
    SELECT {path}, capacity, {_sql_weight(level)} AS weight, {above} AS above
    FROM (SELECT {path}, sum(tokens) * {EPOCHS} AS capacity FROM leaves GROUP BY {path}) {using}
), judged{depth} AS (
    SELECT *, capacity = 0 OR capacity * sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= weight * (above - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
    FROM nodes{depth} WINDOW w AS ({by} ORDER BY capacity / weight, {level})
), given{depth + 1} AS (
    SELECT {path}, CASE WHEN is_full THEN capacity ELSE
        (weight * (above - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({by})))
        // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}), 1) END AS budget
    FROM judged{depth}
)"""


SQL = f"""
WITH sized AS (
    SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
        CASE WHEN regexp_extract(coalesce(source, 'unknown'), '([0-9]{{1,9}})$', 1) <> ''
            THEN 'd' || (CAST(regexp_extract(coalesce(source, 'unknown'), '([0-9]{{1,9}})$', 1) AS BIGINT) % 4) ELSE 'other' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens, md5(coalesce(text, '')) AS version
    FROM documents
), leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM sized GROUP BY ALL
), goal AS (SELECT sum(tokens) * {SHARE[0]} // {SHARE[1]} AS budget FROM leaves
),{_sql_level(0)},{_sql_level(1)},{_sql_level(2)},
cut AS (
    SELECT domain, lang, source, coalesce(budget // nullif(tokens, 0), 0) AS whole, coalesce(budget % nullif(tokens, 0), 0) AS rest
    FROM leaves JOIN given3 USING (domain, lang, source)
), placed AS (
    SELECT *, md5('{SEED}-' || whole || '-' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '-' || version) AS place FROM sized JOIN cut USING (domain, lang, source)
), summed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id NULLS FIRST RANGE UNBOUNDED PRECEDING) AS upto FROM placed
)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
    CAST(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM summed
"""
