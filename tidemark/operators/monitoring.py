"""Live monitoring: alert rules over service states, health checks, queue peaks, summaries, backup checks, the written report."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import fire, utc_day

T = TypeVar("T")
MINUTE = 60_000
FREE_GB = 10.0
#: Minutes after which a feed counts as stale, once the service is up as long.
STALE_ALERT = {"last_oi_ms": 5, "last_funding_ms": 15}
STALE_CHECK = {"last_oi_ms": 5, "last_funding_ms": 15, "last_trade_ms": 2, "last_depth_ms": 5}
#: Uptime from which compaction failures fail the health check.
GRACE = 15 * MINUTE


def is_stale(last: str, now: Column, minutes: int) -> Column:
    """Whether a feed has no value, or none in the last ``minutes``, though the service is up as long."""
    old = F.col(last).isNull() | (now - F.col(last) > minutes * MINUTE)
    return (F.col("uptime_ms") >= minutes * MINUTE) & old


def live_alerts(states: DataFrame, now: Column, free_gb: float = FREE_GB) -> DataFrame:
    """(instance, severity, type, message) of every rule that a service state breaks, in one pass.

    A state has instance, uptime_ms, free_gb, last_oi_ms, last_funding_ms,
    integrity_errors, integrity_seen (at the check before), and backup_ok
    (null if there is no backup status).
    """
    low, new = F.col("free_gb") < free_gb, F.col("integrity_errors") - F.col("integrity_seen")
    rules = [
        (F.when(F.col("free_gb") < free_gb / 2, "CRITICAL").otherwise("WARNING"), "disk_usage_high", low, F.format_string("%.2f GB free", "free_gb")),
        (F.lit("WARNING"), "oi_updates_missing", is_stale("last_oi_ms", now, STALE_ALERT["last_oi_ms"]), F.lit("no open interest of late")),
        (F.lit("WARNING"), "funding_updates_missing", is_stale("last_funding_ms", now, STALE_ALERT["last_funding_ms"]), F.lit("no funding of late")),
        (F.lit("CRITICAL"), "data_integrity_failure", new > 0, F.format_string("%d new errors", new)),
        (F.lit("CRITICAL"), "backup_failure", ~F.col("backup_ok"), F.lit("backup failed")),
    ]
    return fire(states, rules, "instance")


def health_failures(states: DataFrame, now: Column) -> DataFrame:
    """(instance, type) of every health check that fails; a healthy instance has no row."""
    rules = [
        ("symbols", ~F.coalesce(F.col("symbols") > 0, F.lit(False))),
        ("uptime", ~F.coalesce(F.col("uptime_ms") >= 0, F.lit(False))),
        ("integrity", (F.col("uptime_ms") >= GRACE) & (F.col("integrity_errors") > 0)),
        *((name, is_stale(name, now, minutes)) for name, minutes in STALE_CHECK.items()),
    ]
    return fire(states, [(F.lit("CRITICAL"), name, when, F.lit("")) for name, when in rules], "instance").select("instance", "type")


def queue_peaks(samples: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The largest size of every queue on every UTC day, from (queue, size) samples; days start anew."""
    return samples.groupBy(utc_day(F.col(ts)).cast("string").alias("day"), "queue").agg(F.max("size").alias("peak"))


def peak_of_peaks(peaks: DataFrame) -> DataFrame:
    """(day, peak): the largest of a day's queue peaks."""
    return peaks.groupBy("day").agg(F.max("peak").alias("peak"))


#: The fields of a status snapshot, in order.
STATUS = (
    "uptime_hours", "symbols", "trades_received", "liquidations_received", "depth_snapshots_received", "mark_price_updates_received", "top_of_book_updates_received",
    "last_trade_update", "last_depth50_update", "last_funding_update", "last_oi_update", "last_metadata_update", "websocket_reconnects", "integrity_error_count",
)


def status_snapshot(states: DataFrame) -> DataFrame:
    """The 14 fields of every service state: hours to two places, times in ISO form (UTC), counters that are missing as 0."""

    def one(name: str) -> Column:
        if name == "uptime_hours":
            return F.round(F.col("uptime_ms") / 3_600_000, 2)
        if name.startswith("last_"):
            return F.date_format(F.timestamp_millis(name), "yyyy-MM-dd'T'HH:mm:ss'Z'") if name in states.columns else F.lit(None).cast("string")
        return F.coalesce(F.col(name), F.lit(0)) if name in states.columns else F.lit(0)

    return states.select("instance", *[one(n).alias(n) for n in STATUS])


def truncated(message: Column, most: int = 500) -> Column:
    """The first characters of an error's text, as alerts quote it."""
    return F.substring(message, 1, most)


def legacy_paths(listing: DataFrame, most: int = 50) -> DataFrame:
    """(path) of the first files outside the new layout, for display."""
    new = F.col("path").rlike(r"/date=\d{4}-\d{2}-\d{2}/[^/]+$")
    return listing.where(~new).select("path").orderBy("path").limit(most)


def failure_counts(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Events of every kind and UTC day."""
    return events.groupBy(utc_day(F.col(ts)).cast("string").alias("day"), "kind").agg(F.count(F.lit(1)).alias("n"))


def daily_summary(checks: DataFrame, hour: int, minute: int, ts: str = "timestamp") -> DataFrame:
    """(day, sent_at): the first check of a day at or after ``minute`` within ``hour``, UTC."""
    of_day = F.pmod(F.col(ts), F.lit(86_400_000))
    due = (of_day >= (hour * 60 + minute) * MINUTE) & (of_day < (hour + 1) * 60 * MINUTE)
    return checks.where(due).groupBy(utc_day(F.col(ts)).cast("string").alias("day")).agg(F.min(ts).alias("sent_at"))


def disk_usage_percent(total: Column, free: Column) -> Column:
    """Percentage of a disk in use, to two places; 0 where the size is unknown."""
    return F.when(total > 0, F.round((total - free) / total * 100, 2)).otherwise(0.0)


def backup_complete(local: DataFrame, remote: DataFrame, keys: list[str], share: float = 0.9) -> DataFrame:
    """(keys, ok): whether the copy of (files, bytes) holds objects and bytes, and at least ``share`` of the bytes."""
    copy = remote.select(*keys, F.col("files").alias("_files"), F.col("bytes").alias("_bytes"))
    held = (F.col("_files") > 0) & (F.col("_bytes") > 0) & (F.col("_bytes") >= share * F.col("bytes"))
    return local.join(copy, keys, "left").select(*keys, F.coalesce(held, F.lit(False)).alias("ok"))


def backoff(first: float = 1.0, most: float = 60.0) -> Iterator[float]:
    """Delays that double up to a largest one."""
    delay = first
    while True:
        yield min(delay, most)
        delay = min(2 * delay, most)


def with_retries(job: Callable[[], T], sleep: Callable[[float], None], attempts: int = 3, first: float = 2.0) -> T:
    """Runs a job again after growing delays; the last failure is raised."""
    delays = backoff(first)
    for left in reversed(range(attempts)):
        try:
            return job()
        except Exception:
            if left == 0:
                raise
            sleep(next(delays))
    raise ValueError("at least one attempt is needed")


def _table(rows: DataFrame) -> list[str]:
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "-|" * len(rows.columns)]
    return lines + ["| " + " | ".join("" if v is None else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else str(v) for v in r) + " |" for r in rows.toLocalIterator()]


def written_report(day: str, status: str, sections: dict[str, DataFrame]) -> tuple[str, str]:
    """(JSON, Markdown) of a day's report from its small sections: a few rows per symbol, rendered on the driver."""
    parts = {name: [json.loads(r) for r in rows.toJSON().collect()] for name, rows in sections.items()}
    lines = [f"# Data quality, {day}: {status}"]
    for name, rows in sections.items():
        lines += ["", f"## {name}", "", *(_table(rows) if parts[name] else ["None."])]
    return json.dumps({"day": day, "status": status, **parts}, indent=2, sort_keys=True), "\n".join(lines) + "\n"
