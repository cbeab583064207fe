"""Whitening of vectors that were rounded to integers, with exact moments.

Entries become integers and are centred by the whole part of their mean. Each
block is then cut into slices of ``DIGIT_BITS`` bits, small enough that every
BLAS product of two slices is an exact sum in float64; slices are put together
again as big integers, which tasks add up and two levels of grouping merge.
With the remainder of the mean these give the covariance as fractions, rounded
once to double precision before the eigendecomposition. Only figures of the
size of the dimension, squared, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textops import struct

#: Bits of a slice, and rows of a block: 2 ** (2 * (bits - 1)) * rows stays below 2 ** 53.
DIGIT_BITS = 20
ROWS = 1 << 14
#: Entries saturate at this magnitude.
MOST = 1 << 61
#: Sums of tasks merged by one task.
FAN_IN = 256
COMPONENTS = 8


def integers(vectors: np.ndarray, scale: int = 1024, offset: int = 100_000) -> np.ndarray:
    """floor(scale * entry) + offset, within ``MOST``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * scale), -MOST + offset, MOST - offset).astype(np.int64) + offset


def slices(x: np.ndarray) -> list[np.ndarray]:
    """Digits to the base 2 ** DIGIT_BITS, from the least, each within half the base of zero, as float64."""
    half, out = 1 << (DIGIT_BITS - 1), []
    while True:
        digit = ((x + half) & ((1 << DIGIT_BITS) - 1)) - half
        out.append(digit.astype(np.float64))
        x = (x - digit) >> DIGIT_BITS
        if not x.any():
            return out


def gram(x: np.ndarray) -> np.ndarray:
    """The matrix of sums over the rows of x_i * x_j, as Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), ROWS):
        digits = slices(x[at : at + ROWS])
        levels: dict[int, np.ndarray] = {}
        for i, a in enumerate(digits):
            for j, b in enumerate(digits[: i + 1]):
                product = (a.T @ b).astype(np.int64).astype(object)
                levels[i + j] = levels.get(i + j, 0) + (product if i == j else product + product.T)
        for level, sums in levels.items():
            total += sums << (DIGIT_BITS * level)
    return total


@dataclass(frozen=True)
class Fit:
    """What the fit list says: counts, mean, and the leading components as columns."""

    n: int
    whole: np.ndarray  # whole part of the mean, int64
    rest: tuple[int, ...]  # the mean is whole + rest / n
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN for components without variance."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.variances > 0, self.centred(x) @ self.components / np.sqrt(self.variances), np.nan)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        d = x - self.whole
        most = self.n * int(np.abs(d).max(initial=0)) + max(self.rest)
        if most * most * x.shape[1] < 1 << 63:
            y = self.n * d - np.array(self.rest, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * d.astype(object) - np.array(self.rest, object)
        return (y * y).sum(axis=1).tolist()


def _merged(parts: DataFrame) -> dict[int, list[int]]:
    """i -> sums over the tasks of (i, task, values), where values are decimals joined by spaces."""

    def add(table: pa.Table) -> pa.Table:
        sums = np.zeros(1, object)
        for line in table.column("v").to_pylist():
            sums = sums + np.array([int(v) for v in line.split()], object)
        return pa.table({"i": table.column("i")[:1], "task": table.column("task")[:1], "v": pa.array([" ".join(map(str, sums))])})

    merge = lambda t: t.groupBy("i", "task").applyInArrow(add, "i int, task int, v string")
    once = merge(parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")))
    whole = merge(once.withColumn("task", F.lit(0))).collect()  # one row a dimension
    return {r.i: [int(v) for v in r.v.split()] for r in whole}


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sound_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, e) of the rows whose vector is there and whose entries are finite."""
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    e = F.col(embedding) if kind in ("float", "double") else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).alias("id"), e.alias("e"))
    return rows.where(F.col("e").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def fit(sound: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The moments of all rows (id, e) of the commonest length, None if there is no row."""
    lengths = sound.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d, n = lengths.d, lengths.n
    rows = sound.where(F.size("e") == d).select("e")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, object), np.zeros(d, object)
        for batch in batches:
            x = integers(_matrix(batch.column(0), d))
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        total = [Decimal((int(a) << 32) + int(b)) for a, b in zip(high, low, strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "s": pa.array(total, pa.decimal128(38, 0))})

    totals = {r.i: int(r.s) for r in rows.mapInArrow(sums, struct("i int, s decimal(38,0)")).groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    mean = [divmod(totals[i], n) for i in range(d)]
    whole, rest = np.array([q for q, _ in mean], np.int64), tuple(r for _, r in mean)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, count = np.zeros((d, d), object), [], 0
        for batch in batches:
            held.append(integers(_matrix(batch.column(0), d)) - whole)
            count += batch.num_rows
            if count >= ROWS:
                total += gram(np.concatenate(held))
                held, count = [], 0
        if held:
            total += gram(np.concatenate(held))
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "task": pa.array([task] * d, pa.int32()), "v": pa.array([" ".join(map(str, row)) for row in total])})

    products = _merged(rows.mapInArrow(moments, struct("i int, task int, v string")))
    # Covariance of x: sum(x' x') / n - (rest / n) (rest / n), each entry one division of integers.
    v = np.array([[(n * products[i][j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], np.ascontiguousarray(axes[:, ::-1][:, :components])
    values = np.where(values > d * np.finfo(float).eps * max(values[0], 0), values, 0.0)
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return Fit(n, whole, rest, axes, values, float(np.trace(v)))


def identity_error(sound: DataFrame, model: Fit) -> float:
    """The largest entry, in magnitude, of the covariance of the whitened rows less the identity; components without variance aside."""
    d, k = len(model.whole), len(model.variances)
    shared = sound.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = np.nan_to_num(shared.value.whitened(integers(_matrix(batch.column(0), d))))
            total += w.T @ np.column_stack([w, np.ones(len(w))])
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k * (k + 1)), pa.int32()), "v": pa.array(total.ravel())})

    found = sound.where(F.size("e") == d).select("e").mapInArrow(sums, struct("at int, v double")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    table = np.zeros(k * (k + 1))
    for r in found:
        table[r["at"]] = r.v
    table = table.reshape(k, k + 1) / model.n
    live = model.variances > 0
    error = table[:, :k] - np.outer(table[:, k], table[:, k]) - np.eye(k)
    return float(np.abs(error[np.ix_(live, live)]).max(initial=0.0))


def whiten(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact), one row a vector and component.

    A vector that is null, empty, or holds a null or a value that is not
    finite is dropped, as is one whose length is not the commonest (the larger
    of two equally common): no covariance takes it in. Entries become
    floor(1024 * entry) + 100000, saturated at ``MOST``. Null ids and repeated
    rows stay and count; other columns are not read. A component without
    variance has a null ``whitened``. ``deviation`` is null where it exceeds 64
    bits; ``deviation_exact`` holds it always (null beyond 38 digits). Without
    vectors the result is empty.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[vec_id].dataType.simpleString()
    out = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    sound = sound_vectors(vectors, vec_id, embedding)
    model = fit(sound, components)
    if model is None:
        return spark.createDataFrame([], out)
    d, k = len(model.whole), len(model.variances)
    error, shared = identity_error(sound, model), spark.sparkContext.broadcast(model)
    explained = [float(e) / model.trace if model.trace else None for e in model.variances]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x, m = integers(_matrix(part.column(1), d)), part.num_rows
                exact = np.repeat(np.array(shared.value.deviation(x), object), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, shared.value.n)),
                        pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()), pa.array(shared.value.whitened(x).ravel(), from_pandas=True), pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error)),
                        pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return sound.where(F.size("e") == d).select("id", "e").mapInArrow(project, struct(out))
