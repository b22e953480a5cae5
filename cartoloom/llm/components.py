"""Connected components by distributed union-find, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node that links lead to.

    Alternates two steps until nothing changes: each node hooks its larger neighbours to the smallest node it knows, then
    hooks itself and its smaller neighbours to the smallest of those. Each round is written to the shared folder. Minima
    are combined before the shuffle; the joins back are plain sort-merge joins, whose hot keys adaptive execution splits.
    Self links make a node known. No links give no rows.
    """
    edges = edges.select("a", "b").distinct()
    alone = edges.where("a = b").select(F.col("a").alias("node"))
    now = common.materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    mark = _mark(now)
    while True:
        both = _both(now)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("m < u").select("u", F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select("u", "v", "m")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least.select("u", F.col("m").alias("v"))).distinct()
        now = common.materialise(small, label)
        new = _mark(now)
        if new == mark:
            break
        mark = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    known = stars.union(roots)
    return known.union(alone.join(known, "node", "left_anti").select("node", F.col("node").alias("root")))


def _mark(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
