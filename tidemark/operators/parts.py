"""Windows over a symbol's history in parts, so that no task holds all of it.

A part is a value that never falls along the arrival order, such as an hour of
it. Small neighbouring parts make a group of about ``GROUP_ROWS`` rows; a group
also gets, as its halo, the parts just before it that hold as many rows or as
much time as a window looks back. Rows meet their group through a table with
one row a part, which Spark broadcasts as long as it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a group, halo aside, as far as parts allow.
GROUP_ROWS = 1_000_000


def _meet(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """An equality join in which nulls are equal."""
    other = table.withColumnsRenamed({c: f"_on{i}" for i, c in enumerate(on)})
    same = [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)]
    return rows.join(other, same, how).drop(*[f"_on{i}" for i in range(len(on))])


def _layout(parts: DataFrame, by: str, rows: int, span: int | None, size: int) -> DataFrame:
    """(by, _part, _in): the groups that a part goes to, its own first, from (by, _part, n, lo, hi)."""
    along = W.partitionBy(by).orderBy("_part")
    # A group's number is that of its first part among the symbol's rows, so groups with many rows stay apart.
    laid = parts.withColumn("_before", F.sum("n").over(along) - F.col("n"))
    laid = laid.withColumn("_new", F.coalesce((F.floor(F.col("_before") / size) != F.lag(F.floor(F.col("_before") / size)).over(along)).cast("int"), F.lit(1)))
    laid = laid.withColumn("_group", F.sum("_new").over(along))
    starts = laid.where("_new = 1").select(by, "_group", F.struct(F.col("_before").alias("before"), F.col("lo").alias("lo"), F.col("_group").alias("group")).alias("_start"))
    # As every group holds size rows with the one before it, the halo of a group reaches two groups back at most, if size covers it.
    ahead = starts.withColumn("_next", F.collect_list("_start").over(W.partitionBy(by).orderBy("_group").rowsBetween(1, 2 if span is None else W.unboundedFollowing)))
    met = _meet(laid, ahead.select(by, "_group", "_next"), [by, "_group"])
    reached = lambda g: F.col("_before") + F.col("n") > g["before"] - rows
    if span is not None:
        near = lambda g: reached(g) | (F.col("hi") >= g["lo"] - span)
    else:
        near = reached
    return met.select(by, "_part", F.concat(F.array("_group"), F.transform(F.filter("_next", near), lambda g: g["group"])).alias("_in"))


def with_halo(df: DataFrame, part: Column, *, rows: int = 0, time: str | None = None, span: int | None = None, by: str = "symbol", size: int | None = None) -> DataFrame:
    """``df`` with ``_group`` and ``_own``: every row in its group (own), and in those later groups whose windows may reach it.

    A window looks back ``rows`` rows, or ``span`` in the column ``time``. What
    a window over (by, _group) gives for own rows is what one over ``by`` gives;
    :func:`own_rows` keeps these.
    """
    held = df.withColumn("_part", part)
    at = F.col(time) if time else F.lit(0)
    counted = held.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    laid = _layout(counted, by, rows, span, max(size or GROUP_ROWS, rows, 1))
    own = F.element_at("_in", 1)
    return _meet(held, laid, [by, "_part"]).select(*df.columns, own.alias("_home"), F.explode("_in").alias("_group")).withColumn("_own", F.col("_home") == F.col("_group")).drop("_home")


def grouped(df: DataFrame, part: Column | None, by: str = "symbol", **reach) -> tuple[DataFrame, list[str]]:
    """The rows and the columns that windows are partitioned by: groups with a halo, or ``by`` alone without parts."""
    return (df, [by]) if part is None else (with_halo(df, part, by=by, **reach), [by, "_group"])


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_own", "_group") if "_own" in df.columns else df


def carried(df: DataFrame, value: Column, arrival: Sequence[str | Column], by: str, part: Column, greatest: bool) -> DataFrame:
    """``df`` with ``_part``, ``_v`` and ``_c``: the last value (or the greatest) of all parts before; null values count for nothing.

    Parts are reduced in one pass over the few columns that this takes; rows
    then meet the carried values, one a part.
    """
    rows = df.withColumn("_v", value).withColumn("_part", part)
    order = F.struct(*arrival)
    one = F.max("_v") if greatest else F.max_by("_v", F.when(F.col("_v").isNotNull(), order))
    ends = rows.groupBy(by, "_part").agg(one.alias("_e"))
    over = F.max("_e") if greatest else F.last("_e", ignorenulls=True)
    carry = ends.select(by, "_part", over.over(W.partitionBy(by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)).alias("_c"))
    return _meet(rows, carry, [by, "_part"])


def numbered(df: DataFrame, out: str, order: str, part: Column, by: str = "symbol") -> DataFrame:
    """Adds ``out``: the row's place, from 0, among all rows of ``by`` in the order; parts are counted first, rows sorted within theirs only."""
    rows = df.withColumn("_part", part)
    counts = rows.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(by, "_part", (F.sum("_n").over(W.partitionBy(by).orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(W.partitionBy(by, "_part").orderBy(order)) - 1
    return _meet(rows, before, [by, "_part"]).withColumn(out, local + F.col("_before")).select(*df.columns, out)
