"""Near-duplicate vectors by PCA-ordered tiled comparison.

Equal vectors are one class with a multiplicity. Unit vectors are turned into
the axes of a principal component analysis of a bounded sample. Vectors of a
label whose cosine reaches the threshold differ by at most a known length, so
they lie in the same or in neighbouring cells of a grid over the two leading
components; cells are split into blocks, and a task compares two blocks.
There, leading components are summed first; what the rest can add is bounded
by the product of the suffix norms, and a pair is dropped as soon as it
cannot reach the threshold. Pairs that stay are decided in the original
coordinates in double precision.

Before all that a vector is scaled by a power of two, so huge and tiny
components neither overflow nor vanish. A tile reports per vector its number of links and the smallest id it is
joined with, never pairs. A group in one cell, however large, is dealt to
many tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.skew import hot_keys, join_dealt
from tidemark.llm.textops import runs, struct
from tidemark.llm.workspace import Workspace

#: Vectors that the axes are fitted to, at most. Any axes give right results.
SAMPLE_VECTORS = 4096
#: Vectors of a block.
BLOCK = 2048
#: Leading components summed at a time.
STEP = 8
#: Pairs of a tile looked at at a time.
PAIRS = 1 << 17
#: Room for rounding in the bounds.
SLACK = 1e-9


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times a power of two each that brings the largest component near 1: no norm overflows or vanishes, no cosine changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal axes as columns, by descending spread of the unit vectors."""
    vectors = scaled(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    _, axes = np.linalg.eigh(np.cov(unit, rowvar=False) if len(unit) > 1 else np.eye(unit.shape[1]))
    return np.ascontiguousarray(np.atleast_2d(axes)[:, ::-1])


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks with cosine >= threshold (each once if both are the same block)."""
    x, y = scaled(x), scaled(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    ux, uy = (x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes
    d = ux.shape[1]
    step = min(STEP, d)
    # Norm of what follows the first k components.
    rx = np.sqrt(np.maximum(0.0, np.cumsum((ux * ux)[:, ::-1], axis=1)[:, ::-1]))
    ry = np.sqrt(np.maximum(0.0, np.cumsum((uy * uy)[:, ::-1], axis=1)[:, ::-1]))
    zero = np.zeros
    rx, ry = np.hstack([rx, zero((len(rx), 1))]), np.hstack([ry, zero((len(ry), 1))])
    found_i, found_j = [], []
    stripe = max(1, PAIRS // max(1, len(uy)))
    for at in range(0, len(ux), stripe):  # bounds the memory of a tile
        part = slice(at, at + stripe)
        sums = ux[part, :step] @ uy[:, :step].T
        i, j = np.nonzero(sums + np.outer(rx[part, step], ry[:, step]) >= threshold - SLACK)
        total = sums[i, j]
        i = i + at
        if same:
            keep = i < j
            i, j, total = i[keep], j[keep], total[keep]
        for k in range(step, d, step):
            if len(i) == 0:
                break
            to = min(d, k + step)
            total = total + np.einsum("ij,ij->i", ux[i, k:to], uy[j, k:to])
            keep = total + rx[i, to] * ry[j, to] >= threshold - SLACK
            i, j, total = i[keep], j[keep], total[keep]
        if len(i):
            exact = np.einsum("ij,ij->i", x[i], y[j]) / (nx[i] * ny[j])
            keep = exact >= threshold
            found_i.append(i[keep])
            found_j.append(j[keep])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def tile_report(ids: np.ndarray, copies: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, linked vectors, smallest joined id) of the rows with links, for links between rows i and j."""
    links = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
    low = ids.copy()
    while True:  # minima spread along the links, two steps at a time
        near = low.copy()
        np.minimum.at(near, i, low[j])
        np.minimum.at(near, j, low[i])
        if (near == low).all():
            break
        low = near
    rows = np.flatnonzero(links)
    return rows, links[rows].astype(np.int64), low[rows]


def embedding_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors are compared if their labels are equal and not null and their
    lengths agree. A vector that is null, empty, zero, or holds a null or a
    value that is not finite links with nothing, as does a row without id.
    Rows with one id and equal vectors are one vector; ``n_links`` counts
    other ids. ``vec_id`` is an integer column; other columns are not read.
    ``threshold`` is above 0.5.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "vectors")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("e"), F.col(label).alias("label"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0) & finite & F.exists("e", lambda v: v != 0)
    # An equal vector of a label is known by 128 hash bits; its components move once, not once a copy.
    rows = rows.withColumn("e", F.when(sound, F.col("e")))
    rows = rows.withColumn("h", F.when(sound, F.xxhash64("label", "e"))).withColumn("g", F.when(sound, F.xxhash64(F.lit(1), "label", "e")))
    good = rows.where(F.col("h").isNotNull())
    owners = good.groupBy("h", "g", "id").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("copies"))
    values = good.groupBy("h", "g").agg(F.any_value("label").alias("label"), F.any_value("e").alias("e"), F.count(F.lit(1)).alias("n"))
    # A class is known by its hashes and smallest id: one id with two vectors makes two classes.
    classes = ws.save(owners.join(values, ["h", "g"]).withColumnRenamed("h", "key"), "classes")

    sample = classes.orderBy(F.xxhash64("e")).limit(SAMPLE_VECTORS).select("e").collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r.e), []).append(r.e)
    axes = spark.sparkContext.broadcast({d: principal_axes(np.array(v)) for d, v in by_size.items()})
    width = math.sqrt(2 - 2 * threshold) + 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                a = scaled(np.array(v, float)[None, :])[0]
                turn = axes.value.get(len(a))
                lead = (a / np.linalg.norm(a)) @ (turn[:, :2] if turn is not None else np.eye(len(a))[:, :2])
                cell = np.floor(np.append(lead, 0.0)[:2] / width).astype(int)
                out.append((len(a), int(cell[0]), int(cell[1]), a.tobytes()))
            cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary()), batch.column(2), batch.column(3), batch.column(4)], names=["label", "d", "x", "y", "v", "cid", "copies", "key"])

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "e", "cid", "copies", "key").mapInArrow(place, struct(f"label {kind}, d int, x int, y int, v binary, cid long, copies long, key long"))
    placed = ws.save(placed, "placed")

    cells = placed.groupBy("label", "d", "x", "y").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    cells = ws.save(cells, "cells")
    at = ["label", "d", "x", "y"]
    hot = hot_keys(ws, cells, at)
    # Every pair of neighbouring cells once: a cell with itself and with four others.
    steps = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    toward = cells.withColumn("s", F.explode(steps)).select("label", "d", "x", "y", "blocks", (F.col("x") + F.col("s.dx")).alias("x2"), (F.col("y") + F.col("s.dy")).alias("y2"))
    beside = cells.select("label", "d", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("blocks").alias("blocks2"))
    couples = ws.save(toward.join(beside, ["label", "d", "x2", "y2"]), "couples")

    block = F.pmod(F.xxhash64("key"), F.col("own")).cast("int")
    tile = ["label", "d", "x", "y", "x2", "y2", "i", "j"]
    carried = ["cid", "copies", "key", "v"]
    home = join_dealt(placed, couples, at, "key", hot).withColumn("own", F.col("blocks"))
    home = home.withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1))).select(*tile, *carried, F.lit(0).alias("side"))
    theirs = couples.select("label", "d", F.col("x").alias("x1"), F.col("y").alias("y1"), "blocks", F.col("x2").alias("x"), F.col("y2").alias("y"), "blocks2")
    guest = join_dealt(placed, theirs, at, "key", hot)
    guest = guest.withColumnsRenamed({"x": "x2", "y": "y2"}).withColumnsRenamed({"x1": "x", "y1": "y"}).withColumn("own", F.col("blocks2"))
    guest = guest.withColumn("j", block).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*tile, *carried, F.lit(1).alias("side"))
    inside = (F.col("x") == F.col("x2")) & (F.col("y") == F.col("y2"))
    # Within a cell a tile of two blocks is needed once, a block with itself needs no guests.
    both = home.where(~inside | (F.col("i") <= F.col("j"))).unionByName(guest.where(~inside | (F.col("i") < F.col("j"))))
    dealt = both.withColumn("t", F.xxhash64(*tile)).select("t", "d", (inside & (F.col("i") == F.col("j"))).alias("alone"), "side", *carried)
    dealt = dealt.repartition("t").sortWithinPartitions("t", "side", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ("t",)):
            d = t.column("d")[0].as_py()
            side = t.column("side").to_numpy()
            ids, copies, keys = (t.column(c).to_numpy() for c in ("cid", "copies", "key"))
            v = np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(-1, d)
            turn = axes.value.get(d)
            turn = np.eye(d) if turn is None else turn
            if t.column("alone")[0].as_py():
                i, j = linked_pairs(v, v, turn, threshold, True)
            else:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                if len(left) == 0 or len(right) == 0:
                    continue
                i, j = linked_pairs(v[left], v[right], turn, threshold, False)
                i, j = left[i], right[j]
            if len(i) == 0:
                continue
            rows, links, low = tile_report(ids, copies, i, j)
            yield pa.RecordBatch.from_arrays([pa.array(keys[rows]), pa.array(ids[rows]), pa.array(links), pa.array(low)], names=["key", "cid", "links", "low"])

    report = ws.save(dealt.mapInArrow(compare, struct("key long, cid long, links long, low long")), "report")
    labels = connected_components(ws, report.select("cid", "low"))
    counted = report.groupBy("key", "cid").agg(F.sum("links").alias("links"))
    known = classes.select("key", "g", "cid", "copies", "n").join(counted, ["key", "cid"], "left").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
    known = ws.save(known.select(F.col("key").alias("h"), "g", "n", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "cid").alias("c")), "known")
    ws.drop_all_but(known)
    out = join_dealt(rows.select("id", "h", "g"), known.select("h", "g", "links", "c"), ["h", "g"], "id", hot_keys(ws, known, ["h", "g"]), "left")
    kind = vectors.schema[vec_id].dataType
    component = F.coalesce("c", "id")
    return out.select(F.col("id").cast(kind).alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.cast(kind).alias("component_id"), (F.col("id").isNull() | (component == F.col("id"))).alias("kept"))
