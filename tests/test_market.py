"""Market operators against small specifications and known values."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.symbols import normalize_symbols, parse_symbols
from tidemark.operators import bars, book, ordering, quality, rolling
from tidemark.registry import SPECS
from tidemark.sources import parse, storage
from tidemark.streaming import stateful

TRADE = "seq long, symbol string, timestamp long, price double, quantity double, is_buyer_maker boolean"


def random_trades(seed, late):
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(300):
        now += rng.randint(0, 20_000)
        ts = now - (rng.randint(0, 120_000) if late and rng.random() < 0.2 else 0)
        rows.append((i, rng.choice("AB"), max(0, ts), float(rng.randint(1, 50)), float(rng.randint(1, 9)), rng.random() < 0.5))
    return rows


def bars_by_arrival(rows):
    """First bar of a minute wins; another minute's trade closes it."""
    stored, current = {}, {}
    for _, s, ts, p, q, m in rows:
        minute = ts // 60_000 * 60_000
        b = current.get(s)
        if b is None or b[0] != minute:
            if b is not None:
                stored.setdefault((s, b[0]), tuple(b[1:]))
            current[s] = b = [minute, p, p, p, p, 0.0, 0, 0.0]
        b[2], b[3], b[4], b[5], b[6] = max(b[2], p), min(b[3], p), p, b[5] + q, b[6] + 1
        b[7] += -q if m else q
    for s, b in current.items():
        stored.setdefault((s, b[0]), tuple(b[1:]))
    return stored


@pytest.mark.parametrize("late", [False, True])
def test_bars_match_a_sequential_run(spark, late):
    rows = random_trades(7, late)
    want = bars_by_arrival(rows)
    df = spark.createDataFrame(rows, TRADE)
    got = {(r.symbol, r.minute_start): (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in bars.ohlcv_arrival(df, ["seq"]).collect()}
    assert got == {k: v[:6] for k, v in want.items()}
    taker = {(r.symbol, r.minute): r.delta_volume for r in bars.taker_delta_arrival(df, ["seq"]).collect()}
    assert taker == {k: v[6] for k, v in want.items()}
    if not late:
        assert {(r.symbol, r.minute_start): r.volume for r in bars.ohlcv(df, "seq").collect()} == {k: v[4] for k, v in want.items()}


def test_guards_gaps_and_recovery(spark):
    rows = spark.createDataFrame([(1, "A", 10), (2, "A", 13), (3, "A", 12), (4, "A", 13), (5, "A", 15)], "seq long, symbol string, trade_id long")
    assert [r.trade_id for r in ordering.monotonic_guard(rows, ["seq"]).orderBy("seq").collect()] == [10, 13, 15]
    live = spark.createDataFrame([("A", 10), ("A", 13)], "symbol string, trade_id long")
    fill = spark.createDataFrame([("A", i) for i in range(9, 15)], "symbol string, trade_id long")
    got = ordering.recover_gaps(live, fill, ["trade_id"]).orderBy("trade_id").collect()
    assert [(r.trade_id, r.is_recovered) for r in got] == [(10, False), (11, True), (12, True), (13, False)]


def test_parts_give_what_one_window_gives(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("AB"), i + rng.randint(-40, 5), i if rng.random() < 0.6 else None, i - 1 - rng.randint(0, 1) if rng.random() < 0.7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, symbol string, trade_id long, final_update_id long, prev_final_update_id long")
    part = F.floor(F.col("seq") / 30)
    both = lambda f: [sorted(map(tuple, f(p).collect()), key=str) for p in (None, part)]
    for form in (lambda p: ordering.monotonic_guard(df, ["seq"], part=p), lambda p: ordering.chain_breaks(df, ["seq"], part=p), lambda p: ordering.sample_per_bucket(df, "trade_id", ["seq"], 10, part=p)):
        one, split = both(form)
        assert one == split and one
    right = df.where("seq % 17 = 0").select("symbol", "seq", F.col("trade_id").alias("v"))
    one, split = both(lambda p: ordering.asof_latest(df.select("symbol", "seq"), right, ["v"], "symbol", "seq", part=p))
    assert one == split and any(r[2] is not None for r in one)


def test_sampling_drops_late_seconds(spark):
    rows = spark.createDataFrame([(1, "A", 1000), (2, "A", 1500), (3, "A", 2100), (4, "A", 1900), (5, "A", 3000)], "seq long, symbol string, ts long")
    assert [r.seq for r in ordering.sample_per_bucket(rows, "ts", ["seq"]).orderBy("seq").collect()] == [1, 3, 5]


def test_dedup_keeps_the_first_and_equals_nulls(spark):
    rows = spark.createDataFrame([(1, "A", None), (2, "A", None), (3, "A", 5)], "seq long, k string, o long")
    assert [r.seq for r in ordering.dedup_first(rows, ["k", "o"], ["seq"]).orderBy("seq").collect()] == [1, 3]


def test_parsers(spark):
    at = 99
    raw = lambda x: spark.createDataFrame([(json.dumps(x), at)], "data string, received_at long")
    t = parse.agg_trades(raw({"T": 5, "s": "btcusdt", "p": "1.5", "q": "2", "m": True, "a": 7})).first()
    assert (t.symbol, t.price, t.trade_id, t.is_buyer_maker, t.is_recovered) == ("BTCUSDT", 1.5, 7, True, False)
    assert parse.agg_trades(raw({"T": 5, "s": "btcusdt", "p": "x", "q": "2", "m": True, "a": 7})).count() == 0
    q = parse.liquidations(raw({"E": 1, "o": {"s": "ethusdt", "S": "SELL", "p": "3500", "ap": "3498", "q": "2", "z": "1.5"}})).first()
    assert (q.price, q.quantity, q.notional, q.order_timestamp) == (3498.0, 1.5, 5247.0, None)
    f = parse.funding(raw({"symbol": "A", "markPrice": "1", "lastFundingRate": "0.0001", "nextFundingTime": 8})).first()
    assert f.timestamp == at
    b = parse.depth(raw({"E": 1, "T": 2, "s": "a", "U": 1, "u": 2, "pu": 0, "b": [["1", "2"], ["0.9", "1"]], "a": [["1.1", "3"]]}))
    wide = book.to_wide(b, 20).first()
    assert wide.ask_price_1 == 1.1 and wide.ask_price_20 is None and wide.bid_qty_2 == 1.0
    m = parse.exchange_metadata(
        raw({"symbols": [{"symbol": "A", "filters": [{"filterType": "PRICE_FILTER", "tickSize": "0.1"}, {"filterType": "LOT_SIZE", "stepSize": "0.01", "minQty": "0.02"}, {"filterType": "MIN_NOTIONAL", "notional": "5"}]}, {"symbol": "Z", "filters": []}]}),
        spark.createDataFrame([("A",)], "symbol string"),
    ).collect()
    assert [(r.symbol, r.tick_size, r.min_qty, r.min_notional, r.timestamp) for r in m] == [("A", 0.1, 0.02, 5.0, at)]


LEVELS = "array<struct<price:double,qty:double>>"


def test_depth_merge_takes_deep_levels_from_the_snapshot(spark):
    deep = [(100.0 - i, 1.0) for i in range(50)]
    stream = spark.createDataFrame([("A", 10, [(200.0 - i, 1.0) for i in range(20)], []), ("A", 1, [(7.0, 1.0)], [])], f"symbol string, received_at long, bids {LEVELS}, asks {LEVELS}")
    snaps = spark.createDataFrame([("A", 5, deep, deep)], f"symbol string, received_at long, bids {LEVELS}, asks {LEVELS}")
    rows = {r.received_at: r for r in book.to_wide(book.merge_depth(stream, snaps)).collect()}
    assert (rows[10].bid_price_1, rows[10].bid_price_21, rows[10].bid_price_50) == (200.0, 80.0, 51.0)
    assert rows[1].bid_price_21 is None and rows[10].ask_price_1 is None and rows[10].ask_price_21 == 80.0


def test_book_metrics(spark):
    df = spark.createDataFrame([("A", 1, [(65000.0, 1.0)], [(65001.0, 1.0)]), ("A", 2, [], [(1.0, 1.0)]), ("A", 3, [(65000.0, 1.0)], [(65001.0, 1.0)])], f"symbol string, timestamp long, bids {LEVELS}, asks {LEVELS}")
    top = book.top_of_book(df).orderBy("timestamp").collect()
    assert len(top) == 2 and top[0].mid_price == 65000.5 and top[0].spread_bps == 1 / 65000.5 * 10000
    stress = book.liquidity_stress(df.where("timestamp <> 2")).orderBy("timestamp").collect()
    assert [r.depth_change_1m for r in stress] == [0.0, 0.0] and not stress[0].is_stress_event


def test_rolling(spark):
    oi = rolling.oi_change(spark.createDataFrame([("A", 0, 1000.0), ("A", 60_000, 1100.0), ("A", 600_000, 0.0), ("A", 660_000, 5.0)], "symbol string, timestamp long, open_interest double")).orderBy("timestamp").collect()
    assert (oi[1].oi_delta, oi[1].oi_delta_pct, oi[3].oi_delta_pct, oi[2].rolling_5m_delta, oi[2].rolling_15m_delta) == (100.0, 0.1, 0.0, 0.0, -1000.0)
    sp = rolling.spread_state(spark.createDataFrame([("A", i, x) for i, x in enumerate([10.0, 10.0, 10.0, 10.0, 100.0])], "symbol string, timestamp long, spread_bps double"), window=5, threshold=1.0).orderBy("timestamp").collect()
    assert [r.is_wide_spread for r in sp] == [False] * 4 + [True]
    h = 8 * 3_600_000
    at = lambda minutes: (h + minutes * 60_000)
    ev = spark.createDataFrame([("A", at(m), 0.0001, 2 * h if m >= 0 else h) for m in (-10, 20, 90, -3, -30)] + [("A", h, -1e-4, h)], "symbol string, timestamp long, funding_rate double, next_funding_time long")
    got = {r.timestamp: (r.funding_window, r.funding_direction) for r in rolling.funding_event(ev).collect()}
    assert [got[at(m)][0] for m in (-10, 20, 90, -3, -30)] == ["PRE_15M", "POST_30M", "NORMAL", "PRE_5M", "PRE_30M"]
    assert got[h] == ("NORMAL", -1)


def test_throttle_and_reconnects_match_a_sequential_run(spark):
    rng = random.Random(3)
    times = sorted(rng.randint(0, 20_000) for _ in range(80))
    sent, last = [], None
    for t in times:
        if last is None or t - last >= 900:
            sent.append(t)
            last = t
    fired, held = [], []
    for t in times:
        held = [x for x in held if t - x <= 900] + [t]
        if len(held) >= 3:
            fired.append(t)
            held = []
    df = spark.createDataFrame([("k", t) for t in times], "k string, t long")
    assert sorted(r.sent_at for r in quality.throttle(df, "k", "t").collect()) == sent
    assert sorted(r.alert_at for r in quality.reconnect_alerts(df, "k", "t").collect()) == fired


def test_gap_of_exactly_the_limit_is_none(spark):
    df = spark.createDataFrame([("A", "d", 0), ("A", "d", 300_000), ("A", "d", 600_001)], "symbol string, day string, timestamp long")
    assert [r.gap_ms for r in quality.large_gaps(df).collect()] == [300_001]
    assert (quality.expected_intervals(60), quality.expected_intervals(300)) == (1296, 259)


def test_symbols():
    assert parse_symbols("btcusdt, ETHUSDT ,BTCUSDT,") == ["BTCUSDT", "ETHUSDT"]
    for bad in (["BTCUSD"], [], ["  "]):
        with pytest.raises(ValueError):
            normalize_symbols(bad)


def test_store_appends_rejects_and_compacts(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *ids: spark.createDataFrame([(86_399_999 + i % 2, "A", 1.0, 1.0, True, i, False, i) for i in ids] + [(1, "A", None, 1.0, True, 5, False, 1)], SPECS["trades"].schema.simpleString()[7:-1].replace(":", " "))
    assert storage.append(rows(100, 101), "trades", root).count() == 1
    storage.append(rows(100, 102), "trades", root)
    assert storage.compact(spark, "trades", root, "symbol = 'A'") == 3
    got = storage.read(spark, "trades", root)
    assert sorted((str(r.date), r.trade_id) for r in got.collect()) == [("1970-01-01", 100), ("1970-01-01", 102), ("1970-01-02", 101)]
    listing = storage.files(spark, f"{root}/trades")
    assert storage.audit(listing).first().layout == "hive" and storage.backup_scope(listing).first().files == 2
    with pytest.raises(ValueError):
        storage.append(rows(1), "depth20", root)
    assert len(SPECS) == 16 and len(SPECS["depth50"].schema) == 207 and len(SPECS["depth20"].schema) == 87


def test_append_reads_its_source_once_unless_rows_are_rejected(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    schema = SPECS["trades"].schema.simpleString()[7:-1].replace(":", " ")
    whole, broken = (1, "A", 1.0, 1.0, True, 1, False, 1), (1, "A", None, 1.0, True, 2, False, 1)
    source = lambda *rows: spark.createDataFrame(list(rows), schema).mapInPandas(counted, schema)
    assert storage.append(source(whole), "trades", f"{tmp_path}/a").count() == 0 and reads.value == 1
    assert [r.trade_id for r in storage.append(source(whole, broken), "trades", f"{tmp_path}/b").collect()] == [2] and reads.value == 5
    assert storage.append(source(), "trades", f"{tmp_path}/c").count() == 0
    assert [r.trade_id for r in storage.append(source(broken), "trades", f"{tmp_path}/d").collect()] == [2]
    assert storage.read(spark, "trades", f"{tmp_path}/b").count() == 1


def test_streams_equal_batch(spark, tmp_path):
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in random_trades(5, False)]
    src = str(tmp_path / "in")
    df = spark.createDataFrame(rows, "trade_id long, symbol string, timestamp long, price double, quantity double")
    df.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    got = {}
    for name, out in (("bars", stateful.ohlcv_stream(stream)), ("oi", stateful.oi_delta_stream(stream.withColumnRenamed("price", "open_interest")))):
        q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        got[name] = spark.table(name).collect()
    batch = {(r.symbol, r.minute_start): tuple(r[2:]) for r in bars.ohlcv(df, "trade_id").collect()}
    assert got["bars"] and all(batch[r.symbol, r.minute_start] == tuple(r[2:]) for r in got["bars"])
    assert len(batch) - len(got["bars"]) == 2  # the last bar of each symbol is still open
    assert len(got["oi"]) == len(rows)


def test_watermark_bars_and_dedup_plan(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A", 1_000, 1.0, 1.0), (2, "A", 61_000, 2.0, 1.0), (2, "A", 61_000, 2.0, 1.0), (3, "A", 600_000, 3.0, 1.0)], "trade_id long, symbol string, timestamp long, price double, quantity double")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = stateful.first_wins(stream, ["symbol", "trade_id"], "timestamp").writeStream.format("memory").queryName("dd").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.trade_id for r in spark.table("dd").collect()) == [1, 2, 3]
    assert stateful.ohlcv_watermark(stream).isStreaming


def test_report_alerts(spark):
    facts = spark.createDataFrame([(25, 81.0, 6, [], ["ZUSDT", "AUSDT"], 0, 0, 2)], "reconnects int, disk_percent double, missing_minutes int, oi_shortfalls array<string>, funding_shortfalls array<string>, empty_partitions int, storage_failures int, rest_failures int")
    found = quality.alerts(facts)
    assert {r.type for r in found.collect()} == {"reconnect_storm", "disk_usage_high", "missing_minutes", "funding_missing", "rest_failures"}
    assert {r.message for r in found.where("type = 'funding_missing'").collect()} == {"short: AUSDT, ZUSDT"}
    assert quality.overall_status(found).first().status == "critical"
    assert quality.overall_status(found.where("false")).first().status == "ok"
    assert quality.stale(spark.createDataFrame([("a", 0, 10**9), ("b", 0, 0)], "s string, last_ms long, uptime_ms long"), F.lit(10**6), 5).count() == 1
