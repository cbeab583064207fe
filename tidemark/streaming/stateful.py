"""Streaming forms: keyed state for guards, gaps, as-of merges, bars, taker flow, spread, open interest, alerts; bounded key memory.

Keyed operators take a batch's rows of a key in order of ``seq`` and keep what
they need of the past in the state store, bounded per key. They run on
``transformWithState``, whose rows keep their types (a long beside a null
stays a long); it needs the RocksDB state store, which :func:`use_state_store` sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

Fold = Callable[[Any, Any, list[Row]], tuple[Any, list[tuple]]]

_BAR = "symbol string, minute_start long, open double, high double, low double, close double, volume double, trade_count long"
_TAKER = "symbol string, minute long, buy_volume double, sell_volume double, delta_volume double, delta_ratio double, trade_count long"


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _in_order(rows: Iterator[Row], seq: Sequence[str]) -> list[Row]:
    """By ``seq``, nulls first; rows that tie keep the order in which they came."""
    return sorted(rows, key=lambda r: [(r[c] is not None, r[c]) for c in seq])


class _Folded(StatefulProcessor):
    """Runs ``fold(key, state, rows in order) -> (state, result rows)`` on every batch of a key."""

    def __init__(self, fold: Fold, state: str, names: list[str], seq: Sequence[str]):
        self._fold, self._schema, self._row, self._seq = fold, state, Row(*names), list(seq)

    def init(self, handle) -> None:
        self._held = handle.getValueState("held", self._schema)

    def handleInputRows(self, key, rows, timerValues):
        now, made = self._fold(key[0], self._held.get(), _in_order(rows, self._seq))
        if now is not None:
            self._held.update(now)
        for m in made:
            yield self._row(*m)

    def close(self) -> None:
        pass


def _per_key(rows: DataFrame, out: str | T.StructType, state: str, fold: Fold, seq: str | Sequence[str], by: str = "symbol") -> DataFrame:
    out = T.StructType.fromDDL(out) if isinstance(out, str) else out
    return rows.groupBy(by).transformWithState(_Folded(fold, state, out.names, [seq] if isinstance(seq, str) else seq), out, "append", "none")


class _Closing(StatefulProcessor):
    """Open bars: a bar closes when its symbol's next bucket begins, or when its timer says that the stream has left it behind."""

    def __init__(self, add: Callable[[Any, Row, int], Any], result: Callable[[Any, Any], tuple], state: str, names: list[str], width: int, seq: Sequence[str], timed: bool):
        self._add, self._result, self._schema, self._row, self._width, self._seq, self._timed = add, result, state, Row(*names), width, list(seq), timed

    def init(self, handle) -> None:
        self._handle, self._held = handle, handle.getValueState("bar", self._schema)

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None:  # the mark of the end, which only moves the watermark
            return
        before = bar = self._held.get()
        for r in _in_order(rows, self._seq):
            minute = r["timestamp"] // self._width * self._width
            if bar is not None and bar[0] != minute:
                yield self._row(*self._result(key[0], bar))
                bar = None
            bar = self._add(bar, r, minute)
        self._held.update(bar)
        if self._timed and (before is None or before[0] != bar[0]):
            for at in list(self._handle.listTimers()):
                self._handle.deleteTimer(at)
            self._handle.registerTimer(bar[0] + self._width)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        bar = self._held.get()
        if bar is not None:
            yield self._row(*self._result(key[0], bar))
        self._held.clear()

    def close(self) -> None:
        pass


def _closing(trades: DataFrame, out: str, state: str, add, result, width: int, seq: str | Sequence[str], late: str | None, ends: DataFrame | None) -> DataFrame:
    schema = T.StructType.fromDDL(out)
    if ends is not None:
        trades = trades.unionByName(ends.select("timestamp"), allowMissingColumns=True)
    if late is not None:
        trades = trades.withColumn("_ts", F.timestamp_millis("timestamp")).withWatermark("_ts", late)
    processor = _Closing(add, result, state, schema.names, width, [seq] if isinstance(seq, str) else seq, late is not None)
    return trades.groupBy("symbol").transformWithState(processor, schema, "append", "none" if late is None else "eventTime")


def ohlcv_stream(trades: DataFrame, width: int = 60_000, seq: str | Sequence[str] = "trade_id", late: str | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Bars by arrival: a bar closes when its symbol's next bucket begins. A late trade opens a bar whose key is
    already stored; :func:`first_wins` drops it.

    With ``late`` a bar also closes once the stream's latest trade, of any symbol, is that far past its end; trades
    older than that are dropped. ``ends`` is a stream of (timestamp) marks, such as :func:`mark_end` writes, that
    move the time on where no trade does, so that the last bars close in the stream itself.
    """

    def add(bar, r, minute):
        p, q = r["price"], r["quantity"]
        return (minute, p, p, p, p, q, 1) if bar is None else (minute, bar[1], max(bar[2], p), min(bar[3], p), p, bar[5] + q, bar[6] + 1)

    state = "minute long, open double, high double, low double, close double, volume double, n long"
    return _closing(trades, _BAR, state, add, lambda key, bar: (key, *bar), width, seq, late, ends)


def taker_delta_stream(trades: DataFrame, width: int = 60_000, seq: str | Sequence[str] = "trade_id", late: str | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Taker flow by arrival; bars close as in :func:`ohlcv_stream`."""

    def add(bar, r, minute):
        buy, sell, n = bar[1:] if bar is not None else (0.0, 0.0, 0)
        return (minute, buy, sell + r["quantity"], n + 1) if r["is_buyer_maker"] else (minute, buy + r["quantity"], sell, n + 1)

    def result(key, bar):
        minute, buy, sell, n = bar
        return key, minute, buy, sell, buy - sell, (buy - sell) / (buy + sell) if buy + sell > 0 else 0.0, n

    return _closing(trades, _TAKER, "minute long, buy double, sell double, n long", add, result, width, seq, late, ends)


def mark_end(spark: SparkSession, path: str, timestamp: int) -> None:
    """Writes a mark (a Parquet row of ``timestamp``, in milliseconds) for a stream's ``ends``; a mark past the last bar's end by ``late`` closes it."""
    spark.createDataFrame([(timestamp,)], "timestamp long").coalesce(1).write.mode("append").parquet(path)


def oi_delta_stream(samples: DataFrame) -> DataFrame:
    def fold(key, state, rows):
        last, made = state[0] if state else None, []
        for r in rows:
            oi = r["open_interest"]
            made.append((r["timestamp"], key, oi, 0.0 if last is None else oi - last))
            last = oi
        return (last,), made

    return _per_key(samples, "timestamp long, symbol string, oi double, oi_delta double", "oi double", fold, "timestamp")


def ohlcv_watermark(trades: DataFrame, delay: str = "2 minutes", width: str = "1 minute", seq: str = "trade_id") -> DataFrame:
    """Bars that a watermark closes; later trades are dropped."""
    timed = trades.withColumn("ts", F.timestamp_millis("timestamp")).withWatermark("ts", delay)
    bars = timed.groupBy("symbol", F.window("ts", width).alias("w")).agg(
        F.min_by("price", seq).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", seq).alias("close"), F.sum("quantity").alias("volume"), F.count(F.lit(1)).alias("trade_count")
    )
    return bars.select("symbol", F.unix_millis("w.start").alias("minute_start"), "open", "high", "low", "close", "volume", "trade_count")


def first_wins(rows: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """Drops repeated keys within the watermark."""
    return rows.withColumn("_ts", F.timestamp_millis(time)).withWatermark("_ts", delay).dropDuplicatesWithinWatermark(keys).drop("_ts")


def recent_keys(rows: DataFrame, keys: Sequence[str], seq: str | Sequence[str], size: int = 500_000, shards: int = 64) -> DataFrame:
    """Drops rows whose key is among the last ``size`` different keys; the oldest key is forgotten first, and seeing it again does not make it younger.

    Keys are dealt to ``shards`` memories of an equal share each by a hash, so
    with one shard this is one memory for all rows, and with more a hot symbol
    is spread. A memory holds 16 bytes a key, in order, whatever the keys are;
    null keys are equal.
    """
    most, columns = -(-size // shards), rows.columns
    a, b = F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)
    dealt = rows.withColumn("_a", a).withColumn("_b", b).withColumn("_shard", F.pmod(F.xxhash64(F.lit(2), *keys), F.lit(shards)))

    def fold(_, state, batch):
        held = dict.fromkeys(map(tuple, np.frombuffer(state[0], np.int64).reshape(-1, 2).tolist())) if state else {}
        made = []
        for r in batch:
            key = r["_a"], r["_b"]
            if key in held:
                continue
            held[key] = None
            if len(held) > most:
                del held[next(iter(held))]
            made.append(tuple(r[c] for c in columns))
        return (np.array(list(held), np.int64).tobytes(),), made

    return _per_key(dealt, rows.schema, "held binary", fold, seq, by="_shard")


def guard_stream(rows: DataFrame, value: str, seq: str, width: int = 1) -> DataFrame:
    """Rows whose ``value // width`` exceeds all that came before: trade ids that rise (width 1), or the first row of each second (1000)."""

    def fold(_, state, batch):
        last, made = state[0] if state else None, []
        for r in batch:
            mark = r[value] // width
            if last is None or mark > last:
                last = mark
                made.append(tuple(r))
        return (last,), made

    return _per_key(rows, rows.schema, "last long", fold, seq)


def gaps_stream(rows: DataFrame, seq: str, id_col: str = "trade_id") -> DataFrame:
    """Rows whose id exceeds all before, with the range that is missing just ahead of them (``first_missing``, ``last_missing``; null if none is)."""
    out = T.StructType([*rows.schema.fields, T.StructField("first_missing", T.LongType()), T.StructField("last_missing", T.LongType())])

    def fold(_, state, batch):
        last, made = state[0] if state else None, []
        for r in batch:
            now = r[id_col]
            if last is None or now > last:
                made.append((*r, last + 1, now - 1) if last is not None and now > last + 1 else (*r, None, None))
                last = now
        return (last,), made

    return _per_key(rows, out, "last long", fold, seq)


def recover_gaps_stream(live: DataFrame, backfill: DataFrame, seq: str, id_col: str = "trade_id", bucket: int = 1000) -> DataFrame:
    """The live rows in rising order of id and, ahead of each, the backfilled rows of the range missing there (``is_recovered``).

    ``backfill`` is a table (its columns are those of ``live``). Missing ranges
    meet it by buckets of ids, an equality join, so neither side is broadcast.
    ``ahead_of`` is the id of the live row that a row comes with: in order of
    (symbol, ahead_of, id) every row has its place.
    """
    first, last = F.col("first_missing"), F.col("last_missing")
    missing = F.when(first.isNotNull(), F.sequence(F.floor(first / bucket), F.floor(last / bucket)))
    asked = gaps_stream(live, seq, id_col).withColumn("_b", F.explode(F.concat(F.array(F.lit(None).cast("long")), F.coalesce(missing, F.array().cast("array<long>")))))
    columns = [c for c in live.columns if c != "symbol"]
    table = backfill.select("symbol", F.floor(F.col(id_col) / bucket).alias("_b"), F.struct(*columns).alias("_found"))
    met = asked.join(table, ["symbol", "_b"], "left")
    own = F.col("_b").isNull()
    met = met.where(own | F.col(f"_found.{id_col}").between(first, last))
    return met.select("symbol", *[F.when(own, F.col(c)).otherwise(F.col(f"_found.{c}")).alias(c) for c in columns], (~own).alias("is_recovered"), F.col(id_col).alias("ahead_of"))


def asof_stream(left: DataFrame, right: DataFrame, values: Sequence[str], by: str, arrival: str) -> DataFrame:
    """Left rows with the latest right values that arrived no later, null before the first: the stream form of ``asof_latest``.

    Both streams meet in one keyed state that holds the values of the last
    right row, as JSON, whatever their types; doubles come back as they were.
    """
    held = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    tagged = left.withColumn("_side", F.lit(1)).withColumn("_held", F.lit(None).cast("string"))
    both = tagged.unionByName(right.select(by, arrival, F.lit(0).alias("_side"), held.alias("_held")), allowMissingColumns=True)
    out, columns = T.StructType([*left.schema.fields, T.StructField("_held", T.StringType())]), left.columns

    def fold(_, state, batch):
        now, made = state[0] if state else None, []
        for r in batch:
            if r["_side"]:
                made.append((*(r[c] for c in columns), now))
            else:
                now = r["_held"]
        return (now,) if now is not None else None, made

    found = _per_key(both, out, "held string", fold, [arrival, "_side"], by)
    kind = T.StructType([right.schema[v] for v in values])
    return found.withColumn("_held", F.from_json("_held", kind)).select(*left.columns, *[F.col(f"_held.{v}").alias(v) for v in values])


def chain_breaks_stream(rows: DataFrame, seq: str, update: str = "final_update_id", previous: str = "prev_final_update_id") -> DataFrame:
    """Rows whose previous-update id differs from the last known update id (``expected``)."""
    out = T.StructType([*rows.schema.fields, T.StructField("expected", T.LongType())])

    def fold(_, state, batch):
        known, made = state[0] if state else None, []
        for r in batch:
            if known is not None and r[previous] is not None and r[previous] != known:
                made.append((*r, known))
            known = known if r[update] is None else r[update]
        return (known,) if known is not None else None, made

    return _per_key(rows, out, "known long", fold, seq)


def depth_change_stream(rows: DataFrame, seq: str, total: str) -> DataFrame:
    """Adds ``depth_change_1m``: the change of ``total`` against the symbol's row before, 0 where that is not above zero."""
    out = T.StructType([*rows.schema.fields, T.StructField("depth_change_1m", T.DoubleType())])

    def fold(_, state, batch):
        before, made = state[0] if state else None, []
        for r in batch:
            made.append((*r, (r[total] - before) / before if before is not None and before > 0 else 0.0))
            before = r[total]
        return (before,), made

    return _per_key(rows, out, "total double", fold, seq)


def throttle_stream(events: DataFrame, key: str, ts: str, span: int) -> DataFrame:
    """(key, sent_at): events that are sent, none within ``span`` of the last one sent of its kind."""

    def fold(k, state, batch):
        last, made = state[0] if state else None, []
        for r in batch:
            if last is None or r[ts] - last >= span:
                last = r[ts]
                made.append((k, last))
        return (last,), made

    return _per_key(events.where(F.col(ts).isNotNull()), T.StructType([events.schema[key], T.StructField("sent_at", T.LongType())]), "last long", fold, ts, key)


def reconnect_stream(events: DataFrame, key: str, ts: str, span: int, limit: int) -> DataFrame:
    """(key, alert_at): times at which ``limit`` events lie within ``span``; the count starts anew after each. The state holds fewer than ``limit`` times."""

    def fold(k, state, batch):
        held, made = list(state[0]) if state else [], []
        for r in batch:
            held = [x for x in held if r[ts] - x <= span] + [r[ts]]
            if len(held) >= limit:
                made.append((k, r[ts]))
                held = []
        return (held,), made

    return _per_key(events.where(F.col(ts).isNotNull()), T.StructType([events.schema[key], T.StructField("alert_at", T.LongType())]), "held array<long>", fold, ts, key)


def spread_state_stream(rows: DataFrame, window: int = 300, threshold: float = 2.0, scale: int = 10_000, seq: str = "timestamp") -> DataFrame:
    """Mean, population deviation and z-score over the last ``window`` rows, from sums of integers ``round(x * scale)`` as in the batch form."""
    out = "timestamp long, symbol string, spread_bps double, spread_zscore double, is_wide_spread boolean, rolling_spread_mean double, rolling_spread_std double"

    def fold(key, state, batch):
        held = list(state[0]) if state else []
        s, q, made = sum(held), sum(x * x for x in held), []
        at = 0  # values before it have left the window
        for r in batch:
            x = r["spread_bps"]
            i = math.floor(abs(x) * scale + 0.5) * (1 if x >= 0 else -1)
            held.append(i)
            s, q = s + i, q + i * i
            if len(held) - at > window:
                old = held[at]
                at, s, q = at + 1, s - old, q - old * old
            n = len(held) - at
            mean, std = s / (n * scale), math.sqrt(n * q - s * s) / (n * scale)
            z = (x - mean) / std if std > 0 else 0.0
            made.append((r["timestamp"], key, x, z, z >= threshold, mean, std))
        return (held[at:],), made

    return _per_key(rows, out, "held array<long>", fold, seq)


def oi_change_stream(samples: DataFrame, history: int = 120, seq: str = "timestamp") -> DataFrame:
    """Deltas to the previous sample and to the oldest of the last ``history`` samples within 5, 15 and 60 minutes."""
    out = "timestamp long, symbol string, oi double, oi_delta double, oi_delta_pct double, rolling_5m_delta double, rolling_15m_delta double, rolling_60m_delta double"

    def fold(key, state, batch):
        times, values = (list(state[0]), list(state[1])) if state else ([], [])
        made = []
        for r in batch:
            ts, oi, last = r["timestamp"], r["open_interest"], values[-1] if values else None
            times, values = [*times, ts][-history:], [*values, oi][-history:]
            oldest = [next(v for t, v in zip(times, values, strict=True) if t >= ts - m * 60_000) for m in (5, 15, 60)]
            delta = 0.0 if last is None else oi - last
            made.append((ts, key, oi, delta, delta / last if last else 0.0, *(oi - v for v in oldest)))
        return (times, values), made

    return _per_key(samples, out, "times array<long>, opens array<double>", fold, seq)
