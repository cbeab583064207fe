"""Word hashing and batch plumbing shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Length of the longest word or pre-token that a worker remembers, so a cache is bounded in bytes too.
LONGEST_KEY = 64
#: Characters of text handled at once within an Arrow batch.
SLICE_CHARS = 2_000_000
#: Bytes of an Arrow batch, at most, that the pipeline asks for (one row may be larger).
BATCH_BYTES = 8 << 20

_MULT_INT = 0x9E3779B97F4A7C15
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


class Remembered(dict):
    """key -> make(key), remembered for short keys in recent use, ``most`` at most, beside a fixed tier."""

    def __init__(self, make: Callable[[Any], Any], most: int, fixed: dict | None = None):
        super().__init__(fixed or {})
        self._make, self._fixed, self._old = make, fixed or {}, {}
        self._full = len(self) + most // 2

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
            if len(key) > LONGEST_KEY:
                return value
        if len(self) >= self._full:
            self._old = dict(self)
            self.clear()
            self.update(self._fixed)
        self[key] = value
        return value


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at once; a longer word is hashed whole.
_STRETCH = 1 << 20
#: A word's hash is the polynomial of these byte values at an odd point, modulo 2**64, mixed with its length.
_VALUE = np.random.default_rng(20_240_307).integers(0, 1 << 64, 256, dtype=np.uint64)
_POINT = 0x9FB21C651E98DF25
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the point and of its inverse, from 0 to n at least."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1 << 14, 1 << n.bit_length())
        _POWERS[:] = [np.cumprod(np.append(np.uint64(1), np.full(size, np.uint64(x)))) for x in (_POINT, pow(_POINT, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r"""Byte offsets of the starts and ends of the words ``[^\x20\x09-\x0D]+``."""
    edge = np.empty(len(raw) + 2, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = _WHITE[raw]
    edges = np.flatnonzero(edge[1:] != edge[:-1])
    return edges[::2], edges[1::2]


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, which are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _STRETCH, side="right")))
        stretch = raw[base : int(ends[to - 1])]
        power, inverse = _powers(len(stretch))
        sums = np.zeros(len(stretch) + 1, np.uint64)
        np.cumsum(_VALUE[stretch] * power[: len(stretch)], out=sums[1:])
        a, b = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _MIX2)
        at = to
    return out


def text_bytes(text: str | None, lower: bool = True) -> np.ndarray:
    """The text in UTF-8, with A-Z (only) lower-cased if asked for."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return np.frombuffer(raw.lower() if lower else raw, np.uint8)


def hash_words(text: str | None, lower: bool = True) -> np.ndarray:
    """Hashes of the text's words, in order."""
    raw = text_bytes(text, lower)
    return hash_spans(raw, *word_spans(raw))


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _SHIFT)
    x = x * _MIX1
    x = x ^ (x >> _SHIFT)
    x = x * _MIX2
    return x ^ (x >> _SHIFT)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order (empty if there are fewer)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    # Windows of 1, 2, 4, .. words, joined as the bits of n ask for.
    out, size, part, width = None, 0, hashes, 1
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                out = part[: len(hashes) - width + 1] if out is None else part[: len(part) - size] * np.uint64(pow(_MULT_INT, size, 1 << 64)) + out[width:]
                size += width
            if size == n:
                return mix64(out)
            part = part[:-width] * np.uint64(pow(_MULT_INT, width, 1 << 64)) + part[width:]
            width *= 2


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct shingle hashes, sorted; with 1..n-1 words the whole sequence is one shingle."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    if len(hashes) < n:
        return windows(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(windows(hashes, n))


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    return shingles(hash_words(text), n)


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b|, for sorted distinct arrays."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if small == 0 or 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no slice holds much more than SLICE_CHARS of text (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table each, across batches."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if table.num_rows == 0:
            continue
        columns = [table.column(k).to_numpy() for k in keys]
        changed = np.zeros(table.num_rows - 1, bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), table.num_rows]
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[x] for c in columns)
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(x, y - x))
            held_key = key
    if held:
        yield pa.concat_tables(held)


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound on the bytes of an Arrow batch to ``BATCH_BYTES`` where it is larger: a task holds several of them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, "64m")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(held.rstrip("b")[-1:], 1)
    size = int(held.rstrip("bkmg") or 0) * unit
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def map_rows(df: DataFrame, schema: T.StructType, prepare: Callable[[], Callable[..., list[list[Any]]]], text: str = "text") -> DataFrame:
    """mapInArrow over bounded slices.

    ``prepare()`` runs once per task and returns a function that gets the
    slice's columns as lists and returns the result's columns as lists.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for part in slices(batch, text):
                columns = work(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def struct(spec: str) -> T.StructType:
    """'a long, b string' -> StructType."""
    return T.StructType.fromDDL(spec)
