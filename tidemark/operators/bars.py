"""Tumbling bars of trades: OHLCV and taker flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bucket(ts: str, width: int) -> Column:
    return F.col(ts) - F.pmod(F.col(ts), F.lit(width))


def _ohlcv(seq: str) -> list[Column]:
    return [
        F.min_by("price", seq).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", seq).alias("close"),
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
    ]


def _taker() -> list[Column]:
    return [
        F.sum(F.when(~F.col("is_buyer_maker"), F.col("quantity")).otherwise(0.0)).alias("buy_volume"),
        F.sum(F.when(F.col("is_buyer_maker"), F.col("quantity")).otherwise(0.0)).alias("sell_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    ]


def ohlcv(trades: DataFrame, seq: str, width: int = 60_000, ts: str = "timestamp") -> DataFrame:
    """Bars of trades that arrive in time order: one map-side combined aggregation."""
    return trades.groupBy("symbol", bucket(ts, width).alias("minute_start")).agg(*_ohlcv(seq))


def _first_islands(trades: DataFrame, arrival: Sequence[str], width: int, ts: str) -> DataFrame:
    """Trades of the first unbroken run of every bucket: a bar closes when another bucket's trade arrives, and its key is taken then."""
    w = W.partitionBy("symbol").orderBy(*arrival)
    marked = trades.withColumn("_m", bucket(ts, width)).withColumn("_new", F.coalesce((F.lag("_m").over(w) != F.col("_m")).cast("int"), F.lit(1)))
    runs = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.withColumn("_first", F.min("_run").over(W.partitionBy("symbol", "_m"))).where("_run = _first")


def _first_runs(trades: DataFrame, arrival: Sequence[str], width: int, ts: str, part: Column, first: list[Column], again: list[Column]) -> DataFrame:
    """The first unbroken run of every bucket, reduced within parts of the arrival order and merged over them.

    A part's trades become its runs. Only its first and its last run can go on
    in another part: these, two rows a part, are scanned along the arrival to
    find where each begins. Runs that begin at one place are merged, and the
    earliest of each bucket stays. ``first`` reduces trades (``_seq`` is their
    order), ``again`` reduces reduced runs (``_at`` is theirs).
    """
    w = W.partitionBy("symbol", "_part").orderBy(*arrival)
    marked = trades.withColumn("_part", part).withColumn("_m", bucket(ts, width)).withColumn("_seq", F.struct(*arrival))
    marked = marked.withColumn("_new", F.coalesce((F.lag("_m").over(w) != F.col("_m")).cast("int"), F.lit(1))).withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = marked.groupBy("symbol", "_part", "_run", "_m").agg(*first).withColumn("_at", F.struct("_part", "_run"))
    ends = marked.groupBy("symbol", "_part").agg(F.max("_run").alias("_last"), F.min_by("_m", "_seq").alias("_m1"), F.max_by("_m", "_seq").alias("_m2"))
    edge = lambda run, m: F.struct(F.struct("_part", F.col(run).cast("long").alias("_run")).alias("at"), F.col(m).alias("m"))
    edges = ends.withColumn("_one", F.lit(1)).select("symbol", F.explode(F.array_distinct(F.array(edge("_one", "_m1"), edge("_last", "_m2")))).alias("e"))
    along = W.partitionBy("symbol").orderBy("e.at")
    # An edge begins a run unless the edge before it, in another part, has its bucket; within a part two edges are two runs.
    goes_on = (F.lag("e.m").over(along) == F.col("e.m")) & (F.lag("e.at").over(along)["_part"] != F.col("e.at")["_part"])
    heads = edges.withColumn("_head", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("e.at")))
    heads = heads.select("symbol", F.col("e.at").alias("_at"), F.last("_head", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, 0)).alias("_head"))
    placed = runs.join(heads, ["symbol", "_at"], "left").withColumn("_head", F.coalesce("_head", "_at"))
    whole = placed.groupBy("symbol", "_m", "_head").agg(*again)
    names = [c for c in whole.columns if c not in ("symbol", "_m", "_head")]
    return whole.groupBy("symbol", "_m").agg(F.min_by(F.struct(*names), "_head").alias("b")).select("symbol", "_m", "b.*")


def ohlcv_arrival(trades: DataFrame, arrival: Sequence[str], width: int = 60_000, ts: str = "timestamp", part: Column | None = None) -> DataFrame:
    """Bars exactly as arrival order makes them, late trades included; with ``part``, a column that never falls along it, no task holds a symbol's history."""
    if part is None:
        return _first_islands(trades, arrival, width, ts).withColumn("_seq", F.struct(*arrival)).groupBy("symbol", F.col("_m").alias("minute_start")).agg(*_ohlcv("_seq"))
    again = [F.min_by("open", "_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "_at").alias("close"), F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count")]
    return _first_runs(trades, arrival, width, ts, part, _ohlcv("_seq"), again).withColumnRenamed("_m", "minute_start")


def _with_ratio(bars: DataFrame) -> DataFrame:
    total = F.col("buy_volume") + F.col("sell_volume")
    delta = F.col("buy_volume") - F.col("sell_volume")
    return bars.select("symbol", "minute", "buy_volume", "sell_volume", delta.alias("delta_volume"), F.when(total > 0, delta / total).otherwise(0.0).alias("delta_ratio"), "trade_count")


def taker_delta(trades: DataFrame, width: int = 60_000, ts: str = "timestamp") -> DataFrame:
    return _with_ratio(trades.groupBy("symbol", bucket(ts, width).alias("minute")).agg(*_taker()))


def taker_delta_arrival(trades: DataFrame, arrival: Sequence[str], width: int = 60_000, ts: str = "timestamp", part: Column | None = None) -> DataFrame:
    """Taker flow as arrival order makes it; ``part`` as in :func:`ohlcv_arrival`."""
    if part is None:
        return _with_ratio(_first_islands(trades, arrival, width, ts).groupBy("symbol", F.col("_m").alias("minute")).agg(*_taker()))
    again = [F.sum(c).alias(c) for c in ("buy_volume", "sell_volume", "trade_count")]
    return _with_ratio(_first_runs(trades, arrival, width, ts, part, _taker(), again).withColumnRenamed("_m", "minute"))
