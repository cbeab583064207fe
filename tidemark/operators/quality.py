"""Daily quality report: counts, missing minutes, gaps, shortfalls, growth, alerts, throttling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.parts import grouped, numbered, own_rows

DAY = 86_400_000
GAP = 300_000
MISSING_MINUTES, RECONNECTS, DISK_PERCENT = 5, 20, 80.0
THROTTLE, RECONNECT_SPAN, RECONNECT_LIMIT = 900, 900, 3
#: Spans of time, or of places, that one task follows.
BLOCK = 256


def utc_day(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def row_counts(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """Rows of every (symbol, day) of the grid, zero where there are none."""
    counted = rows.groupBy("symbol", "day").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counted, ["symbol", "day"], "left").select("symbol", "day", F.coalesce("n", F.lit(0)).alias("n_rows"))


def missing_minutes(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    """1440 less the distinct minutes of each day that has rows; ``day`` is the UTC day of ``ts``."""
    return missing_in_bitmaps(minute_bitmaps(rows, ts))


def large_gaps(rows: DataFrame, ts: str = "timestamp", gap: int = GAP, most: int = 20) -> DataFrame:
    """The first gaps of each symbol and day that exceed ``gap`` milliseconds (a report of the first ``most``)."""
    w = W.partitionBy("symbol", "day").orderBy(ts)
    found = rows.withColumn("prev", F.lag(ts).over(w)).where(F.col(ts) - F.col("prev") > gap)
    ranked = found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)
    return ranked.select("symbol", "day", F.col("prev").alias("gap_start"), F.col(ts).alias("gap_end"), (F.col(ts) - F.col("prev")).alias("gap_ms"))


def expected_intervals(seconds: int, tolerance: float = 0.90) -> int:
    return max(1, int(86400 / seconds * tolerance))


def interval_shortfall(counts: DataFrame, seconds: int) -> DataFrame:
    need = expected_intervals(seconds)
    return counts.where((F.col("n_rows") > 0) & (F.col("n_rows") < need)).select("symbol", "day", "n_rows", F.lit(need).cast("long").alias("expected"))


def growth_trend(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean of a day and up to ``days`` earlier reports, delta to the nearest earlier one, projections; ``daily`` has one row per day."""
    number = F.datediff(F.col("day"), F.lit("1970-01-01"))
    one = W.partitionBy(F.lit(0))  # one row per day: a small table by nature
    span = one.orderBy(number).rangeBetween(-days, 0)
    out = daily.withColumn("mean_bytes", F.sum("bytes").over(span).cast("double") / F.count(F.lit(1)).over(span))
    out = out.withColumn("delta_bytes", F.col("bytes") - F.lag("bytes").over(one.orderBy("day")))
    return out.select("day", "bytes", "mean_bytes", "delta_bytes", (F.col("mean_bytes") * 30).alias("projected_30d"), (F.col("mean_bytes") * 90).alias("projected_90d"))


def fire(states: DataFrame, rules: list[tuple[Column, str, Column, Column]], *keep: str) -> DataFrame:
    """(*keep, severity, type, message) of every rule (severity, type, when, message) that holds for a row, in one pass."""
    found = F.array(*[F.when(when, F.struct(severity.alias("severity"), F.lit(kind).alias("type"), message.alias("message"))) for severity, kind, when, message in rules])
    return states.select(*keep, F.inline(F.array_compact(found)))


def alerts(facts: DataFrame) -> DataFrame:
    """(severity, type, message) of one row of daily facts per report; shortfalls are the symbols' names, listed in order."""
    names = lambda c: F.array_join(F.array_sort(c), ", ")
    rules = [
        ("CRITICAL", "reconnect_storm", F.col("reconnects") > RECONNECTS, F.format_string("%d reconnects", "reconnects")),
        ("CRITICAL", "disk_usage_high", F.col("disk_percent") > DISK_PERCENT, F.format_string("disk at %.2f%%", "disk_percent")),
        ("WARNING", "missing_minutes", F.col("missing_minutes") > MISSING_MINUTES, F.format_string("%d minutes missing", "missing_minutes")),
        ("WARNING", "oi_missing", F.size("oi_shortfalls") > 0, F.concat(F.lit("short: "), names("oi_shortfalls"))),
        ("WARNING", "funding_missing", F.size("funding_shortfalls") > 0, F.concat(F.lit("short: "), names("funding_shortfalls"))),
        ("WARNING", "empty_partitions", F.col("empty_partitions") > 0, F.format_string("%d partitions empty", "empty_partitions")),
        ("CRITICAL", "storage_failures", F.col("storage_failures") > 0, F.format_string("%d storage failures", "storage_failures")),
        ("WARNING", "rest_failures", F.col("rest_failures") > 0, F.format_string("%d request failures", "rest_failures")),
    ]
    return fire(facts, [(F.lit(severity), kind, when, message) for severity, kind, when, message in rules])


def overall_status(found: DataFrame, *by: str) -> DataFrame:
    """(*by, status): critical if any alert is, else warning if any is, else ok."""
    rank = F.max(F.when(F.col("severity") == "CRITICAL", 2).when(F.col("severity") == "WARNING", 1).otherwise(0))
    ranked = found.groupBy(*by).agg(F.coalesce(rank, F.lit(0)).alias("r"))
    return ranked.select(*by, F.when(F.col("r") == 2, "critical").when(F.col("r") == 1, "warning").otherwise("ok").alias("status"))


def stale(state: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Sources whose last value is older than ``minutes``, once the service is up as long."""
    return state.where(((now - F.col("last_ms")) > minutes * 60_000) & (F.col("uptime_ms") >= minutes * 60_000))


def _followed(at: np.ndarray, span: int) -> np.ndarray:
    """Where the path from each place ends that goes on to the first place at least ``span`` further, by doubling pointers."""
    ahead = np.searchsorted(at, at + span)
    ahead = np.where(ahead < len(at), ahead, np.arange(len(at)))
    while True:
        further = ahead[ahead]
        if (further == ahead).all():
            return ahead
        ahead = further


def spaced(events: DataFrame, key: str, at: str, span: int) -> DataFrame:
    """(key, at): of a key's places in order the first, then always the first that is ``span`` or more past the last one taken.

    Places are dealt to blocks of ``BLOCK`` spans. A block finds from each of
    its first places the last one that its path takes there; paths that start
    close together soon meet, so this is a step function with few steps. One
    small scan along a key's blocks then says where each is entered, and
    blocks list their places. No task holds more of a key than a block.
    """
    kind = events.schema[key].dataType.simpleString()
    rows = events.select(key, F.col(at).cast("long").alias("_at")).where(F.col("_at").isNotNull()).distinct()
    rows = rows.withColumn("_block", F.floor(F.col("_at") / (span * BLOCK)).cast("long"))

    def steps(table: pa.Table) -> pa.Table:
        places, block = np.sort(table.column("_at").to_numpy()), table.column("_block")[0].as_py()
        last = places[_followed(places, span)]
        # An earlier block's place allows nothing past the first span of this one.
        n = min(len(places), int(np.searchsorted(places, block * span * BLOCK + span)) + 1)
        step = np.flatnonzero(np.append(last[1:n] != last[: n - 1], True))
        one = table.column(key).combine_chunks()[:1]
        return pa.table({key: pa.concat_arrays([one] * len(step)), "_block": pa.array([block] * len(step), pa.int64()), "upto": places[step], "last": last[step]})

    found = rows.groupBy(key, "_block").applyInArrow(steps, f"`{key}` {kind}, _block long, upto long, last long")
    scanned = found.repartition(key).sortWithinPartitions(key, "_block", "upto")

    def entries(batches):
        current, last, block, done = object(), None, None, False
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for k, b, upto, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    current, last, block = k, None, None
                if b != block:
                    block, done = b, False
                    for column, value in zip(out, (k, b, None if last is None else last + span), strict=True):
                        column.append(value)
                if not done and (last is None or upto >= last + span):
                    last, done = end, True
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=[key, "_block", "_from"])

    entered = scanned.mapInArrow(entries, f"`{key}` {kind}, _block long, _from long").withColumnRenamed(key, "_key")
    met = rows.join(entered, F.col(key).eqNullSafe(F.col("_key")) & (rows["_block"] == entered["_block"])).select(key, rows["_block"], "_at", "_from")

    def path(table: pa.Table) -> pa.Table:
        places, start = np.sort(table.column("_at").to_numpy()), table.column("_from")[0].as_py()
        taken, i = [], 0 if start is None else int(np.searchsorted(places, start))
        while i < len(places):  # one a span at most
            taken.append(int(places[i]))
            i = int(np.searchsorted(places, places[i] + span))
        one = table.column(key).combine_chunks()[:1]
        return pa.table({key: pa.concat_arrays([one] * len(taken)) if taken else one[:0], "at": pa.array(taken, pa.int64())})

    return met.groupBy(key, "_block").applyInArrow(path, f"`{key}` {kind}, at long")


def throttle(events: DataFrame, key: str, ts: str, span: int = THROTTLE) -> DataFrame:
    """Events that are sent: none within ``span`` (above 0) seconds of the last one sent of its kind."""
    return spaced(events, key, ts, span).withColumnRenamed("at", "sent_at")


def reconnect_alerts(events: DataFrame, key: str, ts: str, span: int = RECONNECT_SPAN, limit: int = RECONNECT_LIMIT) -> DataFrame:
    """Times at which ``limit`` events lie within ``span`` seconds; the count starts anew after each.

    An event ends a run if ``limit`` events up to it lie within the span,
    whatever came before; of these, alerts are the ones spaced by ``limit``
    places among all events of the key.
    """
    rows = events.select(key, F.col(ts).cast("long").alias("_t")).where(F.col("_t").isNotNull())
    part = F.floor(F.col("_t") / (span * BLOCK))
    # Events at one time keep their places among themselves: a number parts them.
    placed = numbered(rows, "_place", "_t", part, by=key)
    held, keys = grouped(placed, part, by=key, rows=limit)
    back = F.lag("_t", limit - 1).over(W.partitionBy(*keys).orderBy("_place"))
    ends = own_rows(held.withColumn("_back", back)).where(F.col("_t") - F.col("_back") <= span).select(key, "_t", "_place")
    alerts = spaced(ends, key, "_place", limit).withColumnRenamed(key, "_key")
    return ends.join(alerts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_place") == F.col("at"))).select(key, F.col("_t").alias("alert_at"))


def minute_bitmaps(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    """(symbol, day, minutes): the minutes of the day that have rows, as a bitmap of 180 bytes.

    Tasks send a bitmap for each symbol and day, not their minutes, and
    bitmaps of more data are merged without reading what is in them.
    """
    minute = F.floor(F.pmod(F.col(ts), F.lit(DAY)) / 60_000) + 1
    return _trimmed(rows.groupBy("symbol", "day").agg(F.bitmap_construct_agg(F.bitmap_bit_position(minute)).alias("minutes")))


def merge_bitmaps(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    return _trimmed(stored.unionByName(fresh).groupBy("symbol", "day").agg(F.bitmap_or_agg("minutes").alias("minutes")))


def _trimmed(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.withColumn("minutes", F.substring("minutes", 1, 180))


def missing_in_bitmaps(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.select("symbol", "day", (F.lit(1440) - F.bitmap_count("minutes")).cast("long").alias("missing_minutes"))
