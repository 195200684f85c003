"""Connected components of an edge table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) of every node of ``edges``; comp is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and hands it to all
    nodes of the same label, so that whole trees move. Rounds end when no label changes.
    With node numbers that are hashes, as here, descending paths are short and rounds are
    about the logarithm of the nodes. All state stays in tables, checkpointed each round;
    only whether a label changed reaches the driver. Nulls are no nodes; loops and
    repeated edges make no difference.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = materialize(pairs.union(pairs.select("b", "a")).distinct())
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "node"))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near")).withColumnRenamed("a", "node")
        moved = materialize(labels.join(seen, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")))
        if moved.where("comp < was").isEmpty():
            return labels
        # Written apart, so that adaptive execution may broadcast it or split a giant component among tasks.
        roots = materialize(moved.groupBy("was").agg(F.min("comp").alias("root")))
        labels = materialize(moved.join(roots, "was").select("node", "root").withColumnRenamed("root", "comp"))


def merged(labels: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``labels`` (node, comp) after a few more ``edges``: components are found among the labels only.

    The names of joined components are the smallest label among them.
    """
    known = labels.select("node", "comp")
    nodes = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b).alias("node"))).distinct()
    every = materialize(known.union(nodes.join(known, "node", "left_anti").select("node", F.col("node").alias("comp"))))
    one = edges.select(a, b).join(every.select(F.col("node").alias(a), F.col("comp").alias("x")), a)
    two = one.join(every.select(F.col("node").alias(b), F.col("comp").alias("y")), b).where("x <> y")
    names = materialize(components(two, "x", "y").select(F.col("node").alias("comp"), F.col("comp").alias("to")))
    return materialize(every.join(names, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))
