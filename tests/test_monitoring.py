import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitoring, quality
from tidemark.sources import layout

STATE = "instance int, symbols int, uptime_ms long, free_gb double, last_oi_ms long, last_funding_ms long, last_trade_ms long, last_depth_ms long, integrity_errors int, integrity_seen int, backup_ok boolean"
M = 60_000
NOW = 100 * M


def state(n, **changes):
    base = dict(instance=n, symbols=25, uptime_ms=60 * M, free_gb=50.0, last_oi_ms=NOW, last_funding_ms=NOW, last_trade_ms=NOW, last_depth_ms=NOW, integrity_errors=0, integrity_seen=0, backup_ok=True)
    return tuple({**base, **changes}.values())


def test_live_alerts(spark):
    rows = [
        state(0), state(1, free_gb=10.0), state(2, free_gb=9.99), state(3, free_gb=4.99), state(4, last_oi_ms=NOW - 5 * M), state(5, last_oi_ms=NOW - 5 * M - 1),
        state(6, last_funding_ms=None, uptime_ms=15 * M), state(7, last_funding_ms=None, uptime_ms=15 * M - 1), state(8, integrity_errors=3, integrity_seen=3),
        state(9, integrity_errors=4, integrity_seen=3, backup_ok=False), state(10, backup_ok=None),
    ]
    found = {(r.instance, r.severity, r.type) for r in monitoring.live_alerts(spark.createDataFrame(rows, STATE), F.lit(NOW)).collect()}
    assert found == {
        (2, "WARNING", "disk_usage_high"), (3, "CRITICAL", "disk_usage_high"), (5, "WARNING", "oi_updates_missing"), (6, "WARNING", "funding_updates_missing"),
        (9, "CRITICAL", "data_integrity_failure"), (9, "CRITICAL", "backup_failure"),
    }


def test_health_failures(spark):
    rows = [
        state(0), state(1, symbols=0), state(2, symbols=None), state(3, uptime_ms=-1), state(4, integrity_errors=1, uptime_ms=15 * M), state(5, integrity_errors=1, uptime_ms=15 * M - 1),
        state(6, last_trade_ms=NOW - 2 * M - 1), state(7, last_depth_ms=None),
    ]
    found = {(r.instance, r.type) for r in monitoring.health_failures(spark.createDataFrame(rows, STATE), F.lit(NOW)).collect()}
    assert found == {(1, "symbols"), (2, "symbols"), (3, "uptime"), (4, "integrity"), (6, "last_trade_ms"), (7, "last_depth_ms")}


def test_summary_is_due_once_a_day(spark):
    at = [h * 60 * M + m * M for h, m in ((8, 14), (8, 15), (8, 59), (9, 0), (32, 20))]
    found = monitoring.daily_summary(spark.createDataFrame([(t,) for t in at], "timestamp long"), 8, 15).collect()
    assert sorted(map(tuple, found)) == [("1970-01-01", 8 * 60 * M + 15 * M), ("1970-01-02", 32 * 60 * M + 20 * M)]


def test_backup_needs_nine_tenths(spark):
    local = spark.createDataFrame([(k, 2, 100) for k in range(5)], "k int, files long, bytes long")
    remote = spark.createDataFrame([(0, 2, 90), (1, 2, 89), (2, 0, 100), (3, 1, 0)], "k int, files long, bytes long")
    assert dict(map(tuple, monitoring.backup_complete(local, remote, ["k"]).collect())) == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_retries_back_off():
    slept, calls = [], []

    def job():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    assert monitoring.with_retries(job, slept.append) == "done"
    assert slept == [2.0, 4.0]
    calls.clear()
    with pytest.raises(OSError):
        monitoring.with_retries(job, slept.append, attempts=2)
    delays = monitoring.backoff()
    assert [next(delays) for _ in range(8)] == [1, 2, 4, 8, 16, 32, 60, 60]


def test_written_report(spark):
    counts = spark.createDataFrame([("AAAUSDT", 184523)], "symbol string, trades long")
    none = quality.alerts(spark.createDataFrame([(0, 0, 1.0, [], [], 0, 0, 0)], "missing_minutes int, reconnects int, disk_percent double, oi_shortfalls array<string>, funding_shortfalls array<string>, empty_partitions int, storage_failures int, rest_failures int"))
    as_json, text = monitoring.written_report("2026-06-11", "ok", {"Counts": counts, "Alerts": none})
    assert json.loads(as_json) == {"day": "2026-06-11", "status": "ok", "Counts": [{"symbol": "AAAUSDT", "trades": 184523}], "Alerts": []}
    assert "| AAAUSDT | 184,523 |" in text and text.endswith("## Alerts\n\nNone.\n")


def test_layout_moves(spark, tmp_path):
    def put(path, text):
        full = tmp_path / path
        full.parent.mkdir(parents=True, exist_ok=True)
        full.write_text(text)
        return full

    put("trades/BTCUSDT/2026-06-01/a.parquet", "deep")
    put("trades/BTCUSDT/2026-06-02/b.parquet", "conflict")
    put("trades/symbol=BTCUSDT/date=2026-06-02/b.parquet", "new")
    put("trades/BTCUSDT/2026-06-03.parquet", "flat")
    put("trades/ETHUSDT/2026-06-04.parquet", "flat conflict")
    put("trades/symbol=ETHUSDT/date=2026-06-04/2026-06-04.parquet", "new")
    changed = put("trades/ETHUSDT/part.parquet", "by time")
    put("metadata/2026-06-01/m.parquet", "meta")
    put("trades/other.parquet", "odd")
    os.utime(changed, (1_780_315_200, 1_780_315_200))
    day = datetime.datetime.fromtimestamp(1_780_315_200, datetime.UTC).date().isoformat()
    assert layout.migrate(spark, str(tmp_path)) == {"move": 4, "skip": 1, "quarantine": 1, "unknown": 1}
    held = {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*.parquet")}
    assert held == {
        "trades/symbol=BTCUSDT/date=2026-06-01/a.parquet": "deep", "trades/BTCUSDT/2026-06-02/b.parquet": "conflict", "trades/symbol=BTCUSDT/date=2026-06-02/b.parquet": "new",
        "trades/symbol=BTCUSDT/date=2026-06-03/2026-06-03.parquet": "flat", "_layout_quarantine/trades/symbol=ETHUSDT/date=2026-06-04/2026-06-04.parquet": "flat conflict",
        "trades/symbol=ETHUSDT/date=2026-06-04/2026-06-04.parquet": "new", f"trades/symbol=ETHUSDT/date={day}/part.parquet": "by time",
        "metadata/date=2026-06-01/m.parquet": "meta", "trades/other.parquet": "odd",
    }
    assert layout.migrate(spark, str(tmp_path)) == {"skip": 1, "unknown": 1}


def test_status_and_display(spark):
    rows = spark.createDataFrame([(1, 5_400_000, 25, 7, 1_000, None)], "instance int, uptime_ms long, symbols int, trades_received long, last_trade_update long, last_oi_update long")
    r = monitoring.status_snapshot(rows).first()
    assert (r.uptime_hours, r.symbols, r.trades_received, r.last_trade_update, r.last_oi_update, r.websocket_reconnects) == (1.5, 25, 7, "1970-01-01T00:00:01Z", None, 0)
    assert tuple(r.asDict())[1:] == monitoring.STATUS
    paths = spark.createDataFrame([(f"/d/trades/AUSDT/2026-01-{i:02d}/a.parquet",) for i in range(1, 30)] + [("/d/trades/symbol=A/date=2026-01-01/a.parquet",)], "path string")
    assert [r.path for r in monitoring.legacy_paths(paths, 2).collect()] == ["/d/trades/AUSDT/2026-01-01/a.parquet", "/d/trades/AUSDT/2026-01-02/a.parquet"]
    assert spark.range(1).select(monitoring.truncated(F.lit("x" * 600))).first()[0] == "x" * 500
