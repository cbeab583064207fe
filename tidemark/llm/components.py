"""Connected components of a distributed edge list by contraction.

Each round every node points to its smallest neighbour below it, pointers are
followed to their roots, and the edges that no pointer took are drawn between
roots anew. All steps are map-side combined minima and joins that deal a node
with very many edges to several tasks, so none is gathered in one task or sent
to the driver.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import hot_keys, join_dealt, join_spread
from tidemark.llm.workspace import Workspace


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(id, component) of every node that is not the smallest of its component.

    ``edges`` has two columns of one integer type; null ends and loops are
    passed over, repeated edges count once. A node that is absent from the
    result is its own component.
    """
    x, y = edges.columns
    e = edges.where(F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(x) != F.col(y)))
    e = ws.save(e.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "edges")
    labels = None
    while not e.isEmpty():
        parents = ws.save(e.groupBy("b").agg(F.min("a").alias("p"), F.count(F.lit(1)).alias("n")), "parents")
        # A node that is the greater end of very many edges is dealt out as well as one that is the smaller.
        wide = hot_keys(ws, parents, ["b"])
        moving = parents.select("b", F.col("p").alias("first"), "p")
        pointers, settled, steps = moving, [], [parents]
        while True:
            above = pointers.select(F.col("b").alias("p"), F.col("p").alias("q"))
            step = join_spread(ws, moving, above, "p", "b", "left").select("b", "first", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved"))
            jumped = ws.save(step, "jumped")
            steps.append(jumped)
            # A pointer that did not move has met its root and is followed no further.
            settled.append(jumped.where("NOT moved").select("b", "first", "p"))
            moving = jumped.where("moved").select("b", "first", "p")
            if moving.isEmpty():
                break
            pointers = functools.reduce(DataFrame.unionByName, settled, moving)
        up = functools.reduce(DataFrame.unionByName, settled)
        # The edge that a node's pointer took lies within a root; only the others can join two roots.
        others = join_dealt(e, up, ["b"], "a", wide).where("a != first").select("a", F.col("p").alias("b"))
        others = ws.save(others.distinct(), "others")
        below = up.select(F.col("b").alias("a"), F.col("p").alias("ra"))
        nearer = join_spread(ws, others, below, "a", "b", "left").select(F.coalesce("ra", "a").alias("a"), "b")
        smaller = ws.save(nearer.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        ws.drop(e, others)
        e = smaller
        now = up.select(F.col("b").alias("id"), F.col("p").alias("component"))
        if labels is None:
            labels = ws.save(now, "labels")
        else:
            then = up.select(F.col("b").alias("component"), F.col("p").alias("root"))
            moved = join_spread(ws, labels, then, "component", "id", "left").select("id", F.coalesce("root", "component").alias("component"))
            newer = ws.save(moved.unionByName(now), "labels")
            ws.drop(labels)
            labels = newer
        ws.drop(*steps)
    if labels is None:
        return ws.save(e.select(F.col("a").alias("id"), F.col("b").alias("component")), "labels")
    return labels
