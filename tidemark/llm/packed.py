"""Rows with equal keys, found on packed rows.

Most keys of a sketch stand alone. A task packs its rows as fixed-size records,
in order of key, into one binary value per range of keys; Spark shuffles these
values, and only records that meet their like become rows of a table.

A key that a task meets very often sends its least and its greatest record and
one that is marked as ``again``; the others are laid aside and joined with the
key's least row afterwards, dealt to several tasks where it is hot. So a range
holds at most ``OFTEN`` records a key and pack, however often the key stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.skew import hot_keys, join_dealt
from tidemark.llm.textops import runs, struct
from tidemark.llm.workspace import Workspace

#: Leading bits of a key that name its range: the 0.5 GB of check_l make about 0.4 MB of records a range.
BITS = 11
#: Records that a task holds before it packs them.
PACK = 1 << 18
#: Records of one key in a pack that are all sent to its range.
OFTEN = 16
#: The range of records that were laid aside.
ASIDE = -1

#: k and c are the key, of is what rows of a key differ in, more tells that records were laid aside.
FIELDS = [("k", "<u8"), ("c", "<u8"), ("of", "<i8"), ("start", "<i4"), ("end", "<i4"), ("again", "?"), ("more", "?")]
_ROW = "k long, c long, of long, start int, end int, again boolean, more boolean"


def record(*names: str) -> np.dtype:
    """A record of the key ``k``, ``of`` and these fields."""
    return np.dtype([(n, t) for n, t in FIELDS if n in {"k", "of", "more", *names}])


def records(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns["k"]), kind)
    for name, values in columns.items():
        out[name] = values.view(np.uint64) if values.dtype == np.int64 and name in ("k", "c") else values
    return out


def _lay_aside(rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the rows, in order of key, are laid aside; keys that have such rows are marked."""
    aside = np.zeros(len(rows), bool)
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        run = rows[start : start + size]
        keys = run["c"] if "c" in rows.dtype.names else np.zeros(size, np.uint64)
        for c in np.unique(keys):
            at = np.flatnonzero(keys == c)
            if len(at) > OFTEN:
                of = run["of"][at]
                sent = [at[of.argmin()], at[of.argmax()]]
                if "again" in rows.dtype.names:
                    sent.append(at[run["again"][at].argmax()])
                run["more"][at] = True
                aside[start + at] = True
                aside[start + np.array(sent)] = False
    return aside


def packs(rows: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(ranges, packed records of each)."""
    rows = rows[np.argsort(rows["k"])]
    first = np.flatnonzero(np.append(True, rows["k"][1:] != rows["k"][:-1]))
    sizes = np.diff(np.append(first, len(rows)))
    often = sizes > OFTEN
    where = np.full(len(rows), ASIDE, np.int32)
    sent = np.ones(len(rows), bool)
    if often.any():
        sent = ~_lay_aside(rows, first[often], sizes[often])
        rows = np.concatenate([rows[~sent], rows[sent]])
    aside = len(rows) - int(sent.sum())
    where[aside:] = rows["k"][aside:] >> np.uint64(64 - BITS)
    cut = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    ends = (np.append(cut, len(rows)) * rows.dtype.itemsize).astype(np.int32)
    return where[cut], pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def met(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, least ``of`` of the row's key), of the keys whose rows differ in ``of`` or stand ``again``."""
    named = rows.dtype.names
    k = rows["k"]
    order = np.argsort(k)
    same = k[order[1:]] == k[order[:-1]]
    # One record may stand for many that were laid aside.
    rows = rows[order[np.append(same, False) | np.append(False, same) | rows["more"][order]]]
    if "c" in named:
        rows = rows[np.lexsort((rows["c"], rows["k"]))]
    if len(rows) == 0:
        return rows, rows["of"]
    new = rows["k"][1:] != rows["k"][:-1]
    if "c" in named:
        new |= rows["c"][1:] != rows["c"][:-1]
    starts = np.flatnonzero(np.append(True, new))
    sizes = np.diff(np.append(starts, len(rows)))
    lo = np.minimum.reduceat(rows["of"], starts)
    stays = lo != np.maximum.reduceat(rows["of"], starts)
    if "again" in named:
        stays |= np.logical_or.reduceat(rows["again"], starts)
    rows["more"] = np.repeat(np.logical_or.reduceat(rows["more"], starts), sizes)
    stays = np.repeat(stays, sizes)
    return rows[stays], np.repeat(lo, sizes)[stays]


def _columns(rows: np.ndarray, kinds: pa.Schema) -> list[pa.Array]:
    """The fields as columns; those that the record lacks are null."""
    given = {n: np.ascontiguousarray(rows[n]) for n in rows.dtype.names}
    return [pa.array(given[f.name].view(np.int64) if f.name in ("k", "c") else given[f.name]) if f.name in given else pa.nulls(len(rows), f.type) for f in kinds]


def groups(ws: Workspace, packed: DataFrame, kind: np.dtype) -> DataFrame:
    """(k, c, of, start, end, again, lo) of the packed (part, rows) whose key has rows that differ in ``of`` or stand ``again``; ``lo`` is its least ``of``.

    ``packed`` is a written table and is read more than once.
    """
    kinds = to_arrow_schema(struct(_ROW))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ("part",)):
            rows, lo = met(np.frombuffer(b"".join(t.column("rows").to_pylist()), kind))
            yield pa.RecordBatch.from_arrays([*_columns(rows, kinds), pa.array(lo)], names=[*kinds.names, "lo"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(_columns(np.frombuffer(value, kind), kinds), names=kinds.names)

    sent = packed.where(F.col("part") != ASIDE).select("part", "rows").repartition("part").sortWithinPartitions("part")
    home = sent.mapInArrow(meet, struct(f"{_ROW}, lo long"))
    others = packed.where(F.col("part") == ASIDE).select("rows")
    if others.isEmpty():
        return home.drop("more")
    home = ws.save(home, "met")
    others = ws.save(others.mapInArrow(unpack, struct(_ROW)).withColumn("c", F.coalesce("c", F.lit(0))), "aside")
    hot = hot_keys(ws, others.groupBy("k", "c").agg(F.count(F.lit(1)).alias("n")), ["k", "c"])
    least = ws.save(home.where("more").select("k", F.coalesce("c", F.lit(0)).alias("c"), "lo").distinct(), "least")
    return home.drop("more").unionByName(join_dealt(others, least, ["k", "c"], "of", hot).select(home.drop("more").columns))
