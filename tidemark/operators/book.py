"""Order books as two arrays of (price, qty) per row, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.parts import grouped, own_rows

TIERS = (5, 10, 20, 50)
STREAM_LEVELS = 20
DEPTH = 50


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def level_notional(side: str, levels: int) -> Column:
    """Sum of price * qty over the first levels, left to right; levels with a null are skipped."""
    full = F.filter(F.slice(side, 1, levels), lambda x: x["price"].isNotNull() & x["qty"].isNotNull())
    return F.aggregate(full, F.lit(0.0), lambda s, x: s + x["price"] * x["qty"])


def notionals(df: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Adds ``_bids`` and ``_asks``: notionals of the first levels of every tier, ascending, in one fold a side.

    The fold goes from tier to tier: each adds its own levels to the sum so far.
    """
    steps = F.array(*[F.struct(F.lit(low + 1).alias("at"), F.lit(high - low).alias("n")) for low, high in zip((0, *tiers[:-1]), tiers, strict=True)])
    valued = lambda side: F.transform(F.slice(side, 1, tiers[-1]), lambda x: F.coalesce(x["price"] * x["qty"], F.lit(0.0)))

    def sums(values: str) -> Column:
        start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("all"))

        def step(held: Column, tier: Column) -> Column:
            total = F.aggregate(F.slice(values, tier["at"], tier["n"]), held["s"], lambda s, v: s + v)
            return F.struct(total.alias("s"), F.concat(held["all"], F.array(total)).alias("all"))

        return F.aggregate(steps, start, step)["all"]

    return df.withColumn("_bids", valued("bids")).withColumn("_asks", valued("asks")).withColumn("_bids", sums("_bids")).withColumn("_asks", sums("_asks"))


def from_wide(df: DataFrame, levels: int) -> DataFrame:
    """Wide bid_price_1.. columns to ``bids`` and ``asks``."""
    side = lambda s: F.array(*[F.struct(F.col(f"{s}_price_{i}").alias("price"), F.col(f"{s}_qty_{i}").alias("qty")) for i in range(1, levels + 1)])
    rest = [c for c in df.columns if not c.startswith(("bid_price_", "bid_qty_", "ask_price_", "ask_qty_"))]
    return df.select(*rest, side("bid").alias("bids"), side("ask").alias("asks"))


def to_wide(df: DataFrame, levels: int = DEPTH) -> DataFrame:
    """The storage layout: price then quantity per level and side, null where a side is short."""
    out = [F.get(F.col(f"{s}s"), F.lit(i))[w].alias(f"{s}_{w}_{i + 1}") for s in ("bid", "ask") for i in range(levels) for w in ("price", "qty")]
    return df.select(*[c for c in df.columns if c not in ("bids", "asks")], *out)


def _deepened(latest: DataFrame, own: int, depth: int) -> DataFrame:
    def side(ours: str, theirs: str) -> Column:
        pad = F.transform(F.sequence(F.lit(0), F.lit(own - 1)), lambda i: F.get(F.col(ours), i))
        return F.concat(pad, F.coalesce(F.slice(theirs, own + 1, depth - own), F.array().cast("array<struct<price:double,qty:double>>")))

    return latest.withColumn("bids", side("bids", "_rb")).withColumn("asks", side("asks", "_ra")).drop("_rb", "_ra")


def _held(snapshots: DataFrame, arrival: str) -> DataFrame:
    return snapshots.select("symbol", arrival, F.col("bids").alias("_rb"), F.col("asks").alias("_ra"))


def merge_depth(stream: DataFrame, snapshots: DataFrame, arrival: str = "received_at", own: int = STREAM_LEVELS, depth: int = DEPTH) -> DataFrame:
    """Stream levels 1..own, deeper levels from the latest snapshot that arrived for the symbol."""
    from tidemark.operators.ordering import asof_latest

    return _deepened(asof_latest(stream, _held(snapshots, arrival), ["_rb", "_ra"], "symbol", arrival), own, depth)


def merge_depth_stream(stream: DataFrame, snapshots: DataFrame, arrival: str = "received_at", own: int = STREAM_LEVELS, depth: int = DEPTH) -> DataFrame:
    """:func:`merge_depth` of two streams: the latest snapshot of a symbol is held in keyed state."""
    from tidemark.streaming.stateful import asof_stream

    return _deepened(asof_stream(stream, _held(snapshots, arrival), ["_rb", "_ra"], "symbol", arrival), own, depth)


def top_of_book(df: DataFrame) -> DataFrame:
    """Adds best levels, spread, mid and spread in basis points; rows without a best level go."""
    bid, ask = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    best = df.withColumn("best_bid_price", bid["price"]).withColumn("best_bid_qty", bid["qty"]).withColumn("best_ask_price", ask["price"]).withColumn("best_ask_qty", ask["qty"])
    best = best.dropna(subset=["best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty"])
    spread, mid = F.col("best_ask_price") - F.col("best_bid_price"), (F.col("best_ask_price") + F.col("best_bid_price")) / 2.0
    return best.withColumn("spread", spread).withColumn("mid_price", mid).withColumn("spread_bps", F.when(mid != 0, spread / mid * 10000.0).otherwise(0.0))


def book_imbalance(df: DataFrame) -> DataFrame:
    at = lambda side, i: F.element_at(side, i + 1)
    tiers = notionals(df.select("timestamp", "symbol", "bids", "asks"))
    return tiers.select(
        "timestamp", "symbol", *[_div(at("_bids", i) - at("_asks", i), at("_bids", i) + at("_asks", i)).alias(f"imbalance_{n}") for i, n in enumerate(TIERS)],
        at("_bids", len(TIERS) - 1).alias("bid_notional"), at("_asks", len(TIERS) - 1).alias("ask_notional"),
    )


def liquidity_stress(df: DataFrame, arrival: str = "timestamp", wide: str | None = None, drop: float = -0.15, skew: float = 0.35, part: Column | None = None) -> DataFrame:
    """Depth change against the previous stored snapshot, and the stress flag; ``part`` as in :mod:`tidemark.operators.parts`."""
    # Notionals come first: a window then sorts two numbers a row, no book.
    base = df.withColumn("bid_depth_notional", level_notional("bids", DEPTH)).withColumn("ask_depth_notional", level_notional("asks", DEPTH)).withColumn("_wide", F.coalesce(F.col(wide), F.lit(False)) if wide else F.lit(False))
    base, keys = grouped(base.select(*dict.fromkeys(["timestamp", "symbol", arrival]), "bid_depth_notional", "ask_depth_notional", "_wide"), part, rows=1)
    total = F.col("bid_depth_notional") + F.col("ask_depth_notional")
    base = base.withColumn("_t", total).withColumn("_p", F.lag("_t").over(W.partitionBy(*keys).orderBy(arrival)))
    base = own_rows(base).withColumn("depth_imbalance", _div(F.col("bid_depth_notional") - F.col("ask_depth_notional"), F.col("_t")))
    base = base.withColumn("depth_change_1m", F.when(F.col("_p") > 0, (F.col("_t") - F.col("_p")) / F.col("_p")).otherwise(0.0))
    stress = (F.col("depth_change_1m") <= drop) | (F.col("_wide") & (F.abs("depth_imbalance") >= skew))
    return base.select("timestamp", "symbol", "bid_depth_notional", "ask_depth_notional", "depth_imbalance", "depth_change_1m", stress.alias("is_stress_event"))
