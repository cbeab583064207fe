"""Joins whose hot keys are dealt to several tasks, and selections by lists of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.workspace import Workspace

#: Rows of one key that stay in one task.
HOT = 512
#: Bytes that a broadcast list of ids may take on an executor, and bytes it takes per id.
BROADCAST_BYTES = 16 << 20
_ID_BYTES = 96


def hot_keys(ws: Workspace, counted: DataFrame, on: Sequence[str], n: str = "n") -> DataFrame:
    """(on, _parts) of the keys with more than ``HOT`` rows.

    The table has at most one row per ``HOT`` rows counted, so Spark's own
    size threshold decides whether it is broadcast.
    """
    return ws.save(counted.where(F.col(n) > HOT).select(*on, F.ceil(F.col(n) / HOT).cast("int").alias("_parts")), "hot")


def join_dealt(many: DataFrame, one: DataFrame, on: Sequence[str], by: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one`` on ``on``: rows of a hot key go to ``_parts`` tasks by a hash of ``by``, its row of ``one`` to each.

    Only rows of ``many`` look their key up: every row of ``one`` goes to part 0 as it is, those of hot keys to the other parts too.
    ``one`` is read twice, so it is a written table or made from one by a few steps.
    """
    part = F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))
    left = many.join(hot, list(on), "left").withColumn("_part", part).drop("_parts")
    more = one.join(hot, list(on)).withColumn("_part", F.explode(F.sequence(F.lit(1), F.col("_parts") - 1))).drop("_parts")
    right = one.withColumn("_part", F.lit(0)).unionByName(more)
    return left.join(right, [*on, "_part"], how).drop("_part")


def join_spread(ws: Workspace, many: DataFrame, one: DataFrame, on: str, by: str, how: str = "inner", many_as: DataFrame | None = None) -> DataFrame:
    """:func:`join_dealt` for a written table ``many`` whose hot keys are not known yet; ``many_as`` are its rows with more columns."""
    hot = hot_keys(ws, many.groupBy(on).agg(F.count(F.lit(1)).alias("n")), [on])
    return join_dealt(many if many_as is None else many_as, one, [on], by, hot, how)


def few(ids: DataFrame) -> bool:
    """Whether a written table of ids is small enough to broadcast."""
    return ids.count() * _ID_BYTES <= BROADCAST_BYTES


def by_size(ids: DataFrame) -> DataFrame:
    """The written table of ids, marked for broadcast if it is small; else the join is left to a shuffle."""
    return F.broadcast(ids) if few(ids) else ids
