"""Distributed connected components: rounds of large-star and small-star.

Every round is two joins and grouped minima, written to the shared checkpoint
folder; nothing but two counters reaches the driver. A hub's edges are reduced
to one row per key before they are joined, so adaptive execution can split
the hub's side. Folders of earlier rounds are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.session import discard, materialize


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(_node, _label): the smallest node of each node's component, for nodes with an edge to another.

    ``edges`` (_a, _b) is read once; nodes are of any ordered type. No edges give no rows.
    """
    now = edges.select(F.greatest("_a", "_b").alias("_v"), F.least("_a", "_b").alias("_u")).where("_v <> _u")
    now, before = materialize(now.distinct(), purpose), None
    while True:
        both = now.unionByName(now.select(F.col("_u").alias("_v"), F.col("_v").alias("_u")))
        least = both.groupBy("_v").agg(F.least(F.col("_v"), F.min("_u")).alias("_m"))
        large = both.where("_u > _v").join(least, "_v").select(F.col("_u").alias("_v"), F.col("_m").alias("_u")).distinct()
        least = large.groupBy("_v").agg(F.min("_u").alias("_m"))
        small = large.join(least, "_v")
        own, other = F.struct("_v", F.col("_m").alias("_u")), F.struct(F.col("_u").alias("_v"), F.col("_m").alias("_u"))
        turn = small.select(F.explode(F.array(own, other)).alias("_e")).select("_e.*").where("_v <> _u").distinct()
        old, now = now, materialize(turn, purpose)
        discard(old)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_v", "_u").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    roots = now.select(F.col("_u").alias("_node")).distinct()
    return now.select(F.col("_v").alias("_node"), F.col("_u").alias("_label")).unionByName(roots.withColumn("_label", F.col("_node")))
