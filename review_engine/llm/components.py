"""Connected components of a table of links, by hooking and contraction.

Every node takes its least neighbour, or itself; as names only fall, that makes trees, and
their roots are found by doubling. Links are then drawn between roots: those inside a tree are
gone, equal ones are one, and what is left is worked on in the same way. A group that hangs
together by a few centres needs one round, whatever its size; rounds go on until no link is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import written


def _between(links: DataFrame) -> DataFrame:
    """Distinct links between different nodes, the lesser first."""
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return links.where("a <> b").select(a, b).groupBy("a", "b").agg(F.lit(1).alias("one")).drop("one")


def _roots(trees: DataFrame) -> DataFrame:
    """(node, name) with the root of each node for its name."""
    while True:
        above = trees.select(F.col("node").alias("name"), F.col("name").alias("above"))
        moved = written(trees.join(above, "name").select("node", F.col("above").alias("name"), (F.col("above") != F.col("name")).alias("moved")),
                        "component-names")
        trees = moved.select("node", "name")
        if moved.where("moved").isEmpty():
            return trees


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component's name is its least node.

    ``known`` gives the components of earlier links, (node, component): then only what the new
    links join up is worked out, and nodes of either are in the result.
    """
    if known is not None:
        for side in "ab":
            links = links.join(known.select(F.col("node").alias(side), F.col("component").alias("of")), side, "left").withColumn(
                side, F.coalesce("of", side)).drop("of")
    left = written(_between(links), "component-links")
    names = None
    while names is None or not left.isEmpty():
        near = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        trees = written(near.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("name")), "component-names")
        roots = _roots(trees)
        if names is None:
            names = roots
        else:
            names = written(names.join(roots.select(F.col("node").alias("name"), F.col("name").alias("root")), "name", "left").select(
                "node", F.coalesce("root", "name").alias("name")), "component-names")
        drawn = left
        for side in "ab":
            drawn = drawn.join(roots.select(F.col("node").alias(side), F.col("name").alias("of")), side).withColumn(side, F.col("of")).drop("of")
        left = written(_between(drawn), "component-links")
    if known is not None:
        moved = names.select(F.col("node").alias("component"), F.col("name").alias("root"))
        before = known.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        fresh = names.join(known.select("node"), "node", "left_anti").select("node", F.col("name").alias("component"))
        return written(before.unionByName(fresh), "component-names")
    return names.withColumnRenamed("name", "component")


def forest(component: np.ndarray, pairs: Iterable[tuple[int, int]], alike: Callable[[int, int], bool] | None = None) -> list[int]:
    """Which of the pairs of places join what is still apart, given the component of each place.

    Only those that would are asked to be ``alike``. Any pair left out joins places that
    these, and links known before, have joined already.
    """
    names, place = np.unique(component, return_inverse=True)
    up = list(range(len(names)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    kept = []
    for k, (x, y) in enumerate(pairs):
        i, j = top(place[x]), top(place[y])
        if i != j and (alike is None or alike(x, y)):
            up[max(i, j)] = min(i, j)
            kept.append(k)
    return kept
