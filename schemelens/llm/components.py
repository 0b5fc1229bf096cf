"""Connected components: of a link table by alternating star contraction, of a link matrix by smallest labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v: long), component the smallest node it reaches.

    A round hangs every node's larger neighbours on its smallest neighbour
    (large star), then its smaller ones (small star).  Minima are summed before
    the shuffle and written, so that a node with very many neighbours is a
    plain skewed join, which adaptive execution splits.
    """
    edges = scratch.keep(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = scratch.keep(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .where("u <> v").distinct())
        low2 = scratch.keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                               F.struct("u", F.col("m").alias("v")))).alias("e"))
        after_edges = scratch.keep(small.select("e.u", "e.v").where("u <> v").distinct())
        after = _state(after_edges)
        scratch.drop(low, low2, large, edges)
        edges = after_edges
        if after == before:
            break
        before = after
    star = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return star.unionByName(roots)


def forest(m: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest key each row and each column reaches through the links ``m``."""
    big = np.iinfo(np.int64).max
    low_l, low_r = left.copy(), right.copy()
    while True:
        new_r = np.minimum(low_r, np.where(m, low_l[:, None], big).min(0, initial=big))
        new_l = np.minimum(low_l, np.where(m, new_r[None, :], big).min(1, initial=big))
        if (new_l == low_l).all() and (new_r == low_r).all():
            return low_l, low_r
        low_l, low_r = new_l, new_r
