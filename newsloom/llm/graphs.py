"""Connected components of a table of links: alternating stars, and distributed union-find."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage


LINKS_PER_TASK = 500_000


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
    return r["n"], r["s"]


def star_components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id, root the smallest of its component, from links (a, b).

    Large-star ties every larger neighbour of a node to the node's least
    neighbour, small-star every smaller one; both in turn until nothing changes.
    Each step is an aggregation and a join on the node, in which adaptive
    execution splits nodes with very many neighbours; each result is written.
    """
    tasks = 1 + links.count() // LINKS_PER_TASK
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # each task hands on a spanning forest of its links, so that fewer rounds are left
    edges = stage(edges.coalesce(tasks).mapInArrow(_spanning, "u long, v long"), "stars")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = (large := stage(large, "stars")).groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's links: each id that is not a root, with its root."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != x:
            parent[x] = top
            x = up
        return top

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    ids = list(parent)
    for at in range(0, len(ids), 100_000):
        some = ids[at:at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([root(x) for x in some], pa.int64())], names=["u", "v"])


def union_find(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id by distributed union-find, from links (a, b).

    Every task unites the links it holds and passes on a spanning forest only.
    Each id then hooks onto its least root, paths are halved until all point at
    a root, and the links between different roots go into the next round.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    found = None
    while True:
        tasks = 1 + edges.count() // LINKS_PER_TASK
        forest = stage(edges.coalesce(tasks).mapInArrow(_spanning, "u long, v long"), "forest")
        hooks = stage(forest.groupBy("u").agg(F.min("v").alias("v")), "hooks")
        if hooks.isEmpty():
            break
        while True:  # path halving
            up = hooks.select(F.col("u").alias("v"), F.col("v").alias("w"))
            flat = stage(hooks.join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")), "hooks")
            moved = flat.filter("moved").isEmpty()
            hooks = flat.select("u", "v")
            if moved:
                break
        up = hooks.select(F.col("u").alias("v"), F.col("v").alias("w"))
        if found is None:
            found = hooks
        else:
            found = stage(found.join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v")).union(
                hooks.join(found.select("u"), "u", "left_anti")), "found")
        roots = hooks.select(F.col("u").alias("x"), F.col("v").alias("r"))
        left = forest.join(roots, forest["u"] == roots["x"], "left").select(F.coalesce("r", "u").alias("u"), "v")
        left = left.join(roots, left["v"] == roots["x"], "left").select("u", F.coalesce("r", "v").alias("v"))
        edges = left.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    if found is None:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return found.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        found.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
