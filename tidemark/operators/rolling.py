"""Rolling state: open-interest changes, spread regimes, funding windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.parts import grouped, own_rows

MINUTE = 60_000
HISTORY = 120


def _order(arrival: str, tie: str | None) -> list[str]:
    return [arrival] if tie is None else [arrival, tie]


def oi_change(df: DataFrame, arrival: str = "timestamp", history: int | None = HISTORY, part: Column | None = None, tie: str | None = None) -> DataFrame:
    """Deltas to the previous sample and to the oldest within 5, 15 and 60 minutes (of ``history`` samples at most).

    Samples that tie in ``arrival`` come in order of the column ``tie``; without one their order is open. With ``part`` a symbol's history is dealt to groups, each with the samples
    before it that the window reaches (see :mod:`tidemark.operators.parts`).
    """
    reach = {"time": "timestamp", "span": 60 * MINUTE, "rows": 1} if history is None else {"rows": history}
    out, keys = grouped(df, part, **reach)
    w = W.partitionBy(*keys).orderBy(*_order(arrival, tie))
    out = out.withColumn("_p", F.lag("open_interest").over(w))
    if arrival == "timestamp":
        # Of samples at one time the first stands for all where a window by time begins with them.
        ahead = F.col("open_interest") if tie is None else F.first("open_interest").over(W.partitionBy(*keys, "timestamp").orderBy(tie))
        out = out.withColumn("_ahead", ahead)
        # Samples in time order: the oldest within the span, unless the one ``history`` samples back is younger.
        oldest = lambda m: F.first("_ahead").over(W.partitionBy(*keys).orderBy("timestamp").rangeBetween(-m * MINUTE, 0))
        if history is None:
            first = oldest
        else:
            out = out.withColumn("_t", F.lag("timestamp", history - 1).over(w)).withColumn("_o", F.lag("open_interest", history - 1).over(w))
            first = lambda m: F.when(F.col("_t") >= F.col("timestamp") - m * MINUTE, F.col("_o")).otherwise(F.col(f"_w{m}"))
        for m in (5, 15, 60):
            out = out.withColumn(f"_w{m}", oldest(m))
        first = first if history is not None else (lambda m: F.col(f"_w{m}"))
    elif history is None:
        raise ValueError("samples out of time order need a bounded history")
    else:
        out = out.withColumn("_h", F.collect_list(F.struct("timestamp", "open_interest")).over(w.rowsBetween(1 - history, 0)))
        first = lambda m: F.get(F.filter("_h", lambda x: x["timestamp"] >= F.col("timestamp") - m * MINUTE), F.lit(0))["open_interest"]
    delta = F.coalesce(F.col("open_interest") - F.col("_p"), F.lit(0.0))
    return own_rows(out).select(
        "timestamp",
        "symbol",
        F.col("open_interest").alias("oi"),
        delta.alias("oi_delta"),
        F.when(F.col("_p").isNull() | (F.col("_p") == 0), 0.0).otherwise(delta / F.col("_p")).alias("oi_delta_pct"),
        *[(F.col("open_interest") - first(m)).alias(f"rolling_{m}m_delta") for m in (5, 15, 60)],
    )


def spread_state(df: DataFrame, arrival: str = "timestamp", window: int = 300, threshold: float = 2.0, scale: int | None = None, part: Column | None = None, tie: str | None = None, least: float = 0.0) -> DataFrame:
    """Rolling mean, population deviation and z-score of ``spread_bps`` over the last rows.

    With ``scale`` the statistics come from sums of integers ``round(x * scale)``,
    whose value does not depend on the order of addition; they are differences
    of running sums, so a row costs the same whatever the window. With ``part``
    a symbol's history is dealt to groups, each with the ``window`` rows before
    it (see :mod:`tidemark.operators.parts`). Rows that tie in ``arrival`` come
    in order of the column ``tie``; without one their order is open. Where the
    deviation is ``least`` or less, the z-score is 0.
    """
    stats, keys = grouped(df, part, rows=window)
    each = W.partitionBy(*keys).orderBy(*_order(arrival, tie))
    w = each.rowsBetween(1 - window, 0)
    so_far = each.rowsBetween(W.unboundedPreceding, 0)
    if scale is None:
        # The mean comes from running sums of decimals, so that it is that of the values as they are written, whatever the order.
        stats = stats.withColumn("_x", F.col("spread_bps").try_cast("decimal(28,18)"))
        stats = stats.withColumn("_a", F.sum(F.coalesce("_x", F.lit(0).cast("decimal(28,18)"))).over(so_far)).withColumn("_n", F.count("spread_bps").over(so_far)).withColumn("_k", F.count("_x").over(so_far))
        held = lambda c: F.col(c) - F.coalesce(F.lag(c, window).over(each), F.lit(0))
        stats = stats.withColumn("_s", held("_a").cast("double")).withColumn("_m", held("_n")).withColumn("_all", held("_k") == F.col("_m"))
        stats = stats.withColumn("_mean", F.when(F.col("_all"), F.try_divide("_s", "_m")).otherwise(F.avg("spread_bps").over(w))).withColumn("_std", F.stddev_pop("spread_bps").over(w))
    else:
        stats = stats.withColumn("_i", F.round(F.col("spread_bps") * scale).cast("long"))
        # Squares of a whole history may exceed 64 bits: their running sums are decimals.
        square = (F.col("_i") * F.col("_i")).cast("decimal(20,0)")
        stats = stats.withColumn("_a", F.sum("_i").over(so_far)).withColumn("_b", F.sum(square).over(so_far)).withColumn("_n", F.least(F.row_number().over(each), F.lit(window)).cast("long"))
        gone = lambda c: F.coalesce(F.lag(c, window).over(each), F.lit(0))
        stats = stats.withColumn("_s", F.col("_a") - gone("_a")).withColumn("_q", (F.col("_b") - gone("_b")).cast("long"))
        stats = stats.withColumn("_mean", F.col("_s").cast("double") / (F.col("_n") * scale)).withColumn("_std", F.sqrt((F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")) / (F.col("_n") * scale))
    z = F.when(F.col("_std") > least, (F.col("spread_bps") - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    return own_rows(stats).withColumn("spread_zscore", z).select("timestamp", "symbol", "spread_bps", "spread_zscore", (F.col("spread_zscore") >= threshold).alias("is_wide_spread"), F.col("_mean").alias("rolling_spread_mean"), F.col("_std").alias("rolling_spread_std"))


def funding_direction(rate: Column, neutral: float = 1e-5) -> Column:
    return F.when(F.abs(rate) < neutral, 0).when(rate > 0, 1).otherwise(-1).cast("byte")


def funding_event(df: DataFrame, neutral: float = 1e-5, period_ms: int = 8 * 60 * MINUTE) -> DataFrame:
    """Where each funding sample stands between two settlements; at the settlement itself, NORMAL."""
    ts, nxt = F.col("timestamp"), F.col("next_funding_time")
    to = F.when(ts < nxt, (nxt - ts) / F.lit(60000.0)).otherwise(0.0)
    previous = F.when(ts < nxt, nxt - period_ms).otherwise(nxt)
    since = F.greatest(F.lit(0.0), (ts - previous) / F.lit(60000.0))
    out = df.withColumn("minutes_to_funding", to).withColumn("minutes_since_previous_funding", since)
    pre = lambda m: (F.col("minutes_to_funding") > 0) & (F.col("minutes_to_funding") <= m)
    post = lambda m: (F.col("minutes_since_previous_funding") > 0) & (F.col("minutes_since_previous_funding") <= m)
    window = F.when(pre(5), "PRE_5M").when(pre(15), "PRE_15M").when(pre(30), "PRE_30M").when(pre(60), "PRE_60M")
    window = window.when(post(5), "POST_5M").when(post(15), "POST_15M").when(post(30), "POST_30M").when(post(60), "POST_60M").otherwise("NORMAL")
    return out.select(
        "timestamp", "symbol", F.col("funding_rate").alias("predicted_funding_rate"), "next_funding_time", "minutes_to_funding", "minutes_since_previous_funding", window.alias("funding_window"),
        *[pre(m).alias(f"is_pre_funding_{m}m") for m in (60, 30, 15, 5)], *[post(m).alias(f"is_post_funding_{m}m") for m in (5, 15, 30, 60)],
        funding_direction(F.col("funding_rate"), neutral).alias("funding_direction"),
    )
