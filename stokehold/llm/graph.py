"""Connected components of an undirected graph kept as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, written


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst; longs, any order): root is
    the smallest node reachable.

    Min-label hooking with pointer jumping: a round takes the smallest label
    among each node's neighbours, hooks the roots onto it and halves the
    paths, so the rounds grow with the logarithm of the longest path. Edges
    are never rewritten, so no node's degree grows; a label that many nodes
    carry is aggregated before the shuffle and its join is salted."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = written(both.filter("src != dst").distinct())
    labels = written(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("root")))
    nodes = labels.count()
    for _ in range(rounds if nodes else 0):
        # smallest label around each node
        around = (both.join(labels.select(F.col("node").alias("dst"), F.col("root").alias("near")), "dst")
                  .groupBy(F.col("src").alias("node")).agg(F.min("near").alias("near")))
        seen = labels.join(around, "node").select("node", "root", F.least("root", "near").alias("near"))
        # a label's new label: the least one that any of its nodes has seen, followed once
        hooks = written(seen.groupBy("root").agg(F.min("near").alias("hook"), F.count(F.lit(1)).alias("n")))
        if not hooks.filter("hook != root").limit(1).count():
            return labels
        far = hooks.select(F.col("root").alias("hook"), F.col("hook").alias("far"))
        jumped = hooks.join(far, "hook", "left").select("root", "n", F.least("hook", F.coalesce("far", "hook")).alias("next"))
        hot = jumped.filter(F.col("n") * 1000 > nodes).select("root")  # 1,000 labels at most
        moved = salted_join(labels, jumped.select("root", "next"), ["root"], hot, ["node"], "inner")
        labels = written(moved.select("node", F.col("next").alias("root")))
    if nodes:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return labels
