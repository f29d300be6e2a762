"""Connected components of an edge table, in the shared folder, nothing on the driver but a count."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``node long, root long``: the smallest node reachable, for nodes that have an edge.

    Each round every node takes the smallest root among its own and its neighbours', then the root of that root; rounds
    go on until nothing changes. Both inputs of a round are written tables, so a lost executor costs its tasks only. A
    node with many neighbours is combined before the shuffle (min)."""
    e = written(edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    lab = written(e.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots")
    while True:
        near = e.join(lab, e["a"] == lab["node"]).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("near"))
        step = written(lab.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "near")
        up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        lab = written(step.join(up, "root", "left").select("node", "old", F.coalesce("up", "root").alias("root")), "roots")
        if lab.where("old <> root").limit(1).count() == 0:
            return lab.select("node", "root")
        lab = lab.select("node", "root")
