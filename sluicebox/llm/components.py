"""Connected components of an edge table, by least labels and pointer jumping.

Every round is two shuffle joins and two hash aggregations that combine on the map side, so a node that a third of all
edges meet costs one row per task. Labels are written to the shared folder after each round: a lost executor re-reads
files. Nothing is collected but one count per round. Both directions of an edge come from one reading of ``edges``: a
spanning forest computed a second time may be another one, and half of each would not join its components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.session import spool


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: ``root`` is the least node that can be reached.

    Null ends and loops are ignored; an empty table gives no rows.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    one_way = edges.where(F.col("a") != F.col("b"))
    both = spool(one_way.select(F.explode(ends).alias("edge")).select("edge.a", "edge.b").distinct())
    labels = spool(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")))
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        closer = labels.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        ends = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = spool(closer.join(ends, "root").select("node", "old", F.col("far").alias("root")))
        labels = jumped.select("node", "root")
        if jumped.where(F.col("root") != F.col("old")).isEmpty():
            return labels
