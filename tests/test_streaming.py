"""Streams equal batch, after a restart too; the sink's segments, rejects, recovery and finalisation."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, book, monitoring, ordering, quality, rolling
from tidemark.registry import SPECS
from tidemark.sources import footers, parse, storage, streams
from tidemark.streaming import metrics, stateful
from tidemark.streaming.store import StoreSink

TRADE = "trade_id long, symbol string, timestamp long, price double, quantity double, is_buyer_maker boolean"


def trades(seed, n=240):
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(n):
        now += rng.randint(0, 9_000)
        rows.append((i, rng.choice("AB"), now, float(rng.randint(1, 50)), float(rng.randint(1, 9)), rng.random() < 0.5))
    return rows


def run(stream, out, tmp, name):
    q = out(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp}/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def in_two_parts(spark, rows, schema, tmp):
    """A stream over a folder, half of whose rows come after the first run."""
    half = len(rows) // 2
    source = f"{tmp}/in"
    put = lambda part: spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    put(rows[:half])
    return source, lambda: put(rows[half:])


@pytest.mark.parametrize("name", ["guard", "second", "taker", "spread", "oi"])
def test_stateful_streams_equal_batch_after_a_restart(spark, tmp_path, name):
    rows = [(i, s, ts - (40_000 if i % 9 == 0 and i > 20 else 0), p, q, m) for i, s, ts, p, q, m in trades(3)] if name == "second" else trades(3)
    if name == "guard":
        rows = [(i - (30 if i % 7 == 0 else 0), *r) for i, *r in rows]
    schema = "seq long, " + TRADE + ", spread_bps double, open_interest double"
    rows = [(k, *r, round(r[3] / 7, 3), r[3] * 10) for k, r in enumerate(rows)]
    source, more = in_two_parts(spark, rows, schema, str(tmp_path))
    forms = {
        "guard": (lambda d: stateful.guard_stream(d, "trade_id", "seq"), lambda d: ordering.monotonic_guard(d, ["seq"])),
        "second": (lambda d: stateful.guard_stream(d, "timestamp", "seq", 1000), lambda d: ordering.sample_per_bucket(d, "timestamp", ["seq"])),
        "taker": (lambda d: stateful.taker_delta_stream(d, seq="seq"), lambda d: bars.taker_delta_arrival(d, ["seq"])),
        "spread": (lambda d: stateful.spread_state_stream(d, 20, seq="seq"), lambda d: rolling.spread_state(d, "seq", 20, scale=10_000)),
        "oi": (lambda d: stateful.oi_change_stream(d, 15, seq="seq"), lambda d: rolling.oi_change(d, "seq", 15)),
    }
    live, batch = forms[name]
    files = spark.readStream.schema(schema).parquet(source)
    sink = f"{tmp_path}/out"
    for _ in range(2):  # the second run goes on from the checkpoint of the first
        q = live(files).writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        more()
        more = lambda: None
    got = spark.read.parquet(sink)
    want = batch(spark.createDataFrame(rows, schema)).select(*got.columns)
    got, want = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
    if name == "taker":  # the last bar of each symbol is open
        assert len(want) - len(got) == 2 and set(got) <= set(want)
    else:
        assert [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got] == [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want]


@pytest.mark.parametrize("name", ["bars", "taker"])
def test_timers_close_every_bar_in_the_stream(spark, tmp_path, name):
    rows = trades(4)
    schema, width, late = TRADE, 60_000, 600_000
    source, more = in_two_parts(spark, rows, schema, str(tmp_path))
    live, batch = {"bars": (stateful.ohlcv_stream, bars.ohlcv(spark.createDataFrame(rows, schema), "trade_id")), "taker": (stateful.taker_delta_stream, bars.taker_delta(spark.createDataFrame(rows, schema)))}[name]
    marks, sink = f"{tmp_path}/marks", f"{tmp_path}/out"
    stateful.mark_end(spark, marks, 0)

    def go():
        ends = spark.readStream.schema("timestamp long").parquet(marks)
        out = live(spark.readStream.schema(schema).parquet(source), late=f"{late} milliseconds", ends=ends)
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(sink).collect()))

    want = sorted(map(tuple, batch.collect()))
    assert len(go()) < len(want)
    more()
    got = go()
    assert len(want) - len(got) == 2 and set(got) <= set(want)  # the last bar of each symbol is open, after a restart too
    stateful.mark_end(spark, marks, rows[-1][2] + width + late)
    assert go() == want


def streamed(spark, out, tmp, name):
    out.writeStream.format("parquet").option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/{name}-c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{tmp}/{name}")


def in_three_runs(spark, rows, schema, tmp, name, build):
    """What a stream gives that is stopped and started again between thirds of its rows."""
    for at in range(3):
        spark.createDataFrame(rows[at * len(rows) // 3 : (at + 1) * len(rows) // 3], schema).coalesce(1).write.mode("append").parquet(f"{tmp}/{name}-in")
        got = streamed(spark, build(spark.readStream.schema(schema).parquet(f"{tmp}/{name}-in")), tmp, name)
    return got


def test_depth_merge_on_streams_equals_batch_after_restarts(spark, tmp_path):
    rng = random.Random(11)
    level = lambda n: [(round(rng.random() * 100, 4), float(rng.randint(1, 9))) for _ in range(n)]
    big = 9_007_199_254_740_993
    rows = [(rng.choice("AB"), t, rng.random() < 0.3, level(rng.randint(1, 3)), level(3), big + t if t % 3 else None) for t in range(90)]
    rows = [(s, t, snap, level(6) if snap else b, level(rng.randint(2, 6)) if snap else a, u) for s, t, snap, b, a, u in rows]
    rows += [("A", 90, True, level(6), level(6), None), ("A", 90, False, level(2), level(2), 1)]  # a snapshot and a book that arrive at once
    schema = "symbol string, received_at long, snapshot boolean, bids array<struct<price:double,qty:double>>, asks array<struct<price:double,qty:double>>, final_update_id long"
    build = lambda d: book.merge_depth_stream(d.where("NOT snapshot").drop("snapshot"), d.where("snapshot").drop("snapshot"), own=3, depth=6)
    got = in_three_runs(spark, rows, schema, str(tmp_path), "depth", build)
    df = spark.createDataFrame(rows, schema)
    want = book.merge_depth(df.where("NOT snapshot").drop("snapshot"), df.where("snapshot").drop("snapshot"), own=3, depth=6)
    key = lambda r: (r.symbol, r.received_at)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == sorted(map(tuple, want.select(*got.columns).collect()), key=lambda r: r[:2])
    assert {key(r) for r in got.collect()} == {(s, t) for s, t, snap, *_ in rows if not snap}


def test_gap_recovery_on_streams_equals_batch_after_restarts(spark, tmp_path):
    rng = random.Random(12)
    every = [(s, i, float(i)) for s in "AB" for i in range(1, 400)]
    live = [(k, *r) for k, r in enumerate(sorted((r for r in every if rng.random() < 0.5 or 100 < r[1] < 105), key=lambda r: r[1] + rng.randint(0, 3)))]
    backfill = spark.createDataFrame([(0, *r) for r in every if r[1] % 17], "seq long, symbol string, trade_id long, price double")
    schema = "seq long, symbol string, trade_id long, price double"
    got = in_three_runs(spark, live, schema, str(tmp_path), "gaps", lambda d: stateful.recover_gaps_stream(d, backfill, "seq", bucket=10)).collect()
    guarded = ordering.monotonic_guard(spark.createDataFrame(live, schema), ["seq"])
    want = ordering.recover_gaps(guarded, backfill, ["seq"], bucket=10).collect()
    assert sorted((r.symbol, r.trade_id, r.price, r.is_recovered) for r in got) == sorted((r.symbol, r.trade_id, r.price, r.is_recovered) for r in want)
    assert any(r.is_recovered for r in got)
    for s in "AB":  # in the stated order ids rise: recovered rows come ahead of their live row
        ids = [r.trade_id for r in sorted((r for r in got if r.symbol == s), key=lambda r: (r.ahead_of, r.trade_id))]
        assert ids == sorted(set(ids))


def test_key_memory_equals_a_sequential_run(spark, tmp_path):
    rng = random.Random(13)
    rows = [(k, rng.choice(["A", None]), rng.randint(1, 60)) for k in range(600)]
    schema, size = "seq long, symbol string, trade_id long", 25
    held, want = [], []
    for k, *key in rows:
        if key not in held:
            want.append(k)
            held = [*held, key][-size:]
    got = in_three_runs(spark, rows, schema, str(tmp_path), "keys", lambda d: stateful.recent_keys(d, ["symbol", "trade_id"], "seq", size, shards=1))
    assert sorted(r.seq for r in got.collect()) == want
    state = spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/keys-c").select(F.length("value.held")).collect()
    assert [r[0] for r in state] == [16 * size]
    # More memories forget at other times, but never let a key through that they hold.
    spread = in_three_runs(spark, rows, schema, str(tmp_path), "spread", lambda d: stateful.recent_keys(d, ["symbol", "trade_id"], "seq", 4 * 120, shards=4))
    assert spread.count() == len({tuple(r[1:]) for r in rows})


def test_alert_chain_and_depth_streams_equal_batch(spark, tmp_path):
    rng = random.Random(14)
    now, rows = 0, []
    for i in range(240):
        now += rng.choice([0, 1, 5, 40])
        rows.append((i, rng.choice("AB"), now, i if rng.random() < 0.8 else None, i - rng.choice([1, 2]) if rng.random() < 0.9 else None, float(rng.randint(0, 5))))
    schema = "seq long, symbol string, t long, final_update_id long, prev_final_update_id long, total double"
    df = spark.createDataFrame(rows, schema)
    go = lambda name, build: in_three_runs(spark, rows, schema, str(tmp_path), name, build)
    plain = lambda d: sorted(map(tuple, d.collect()))
    assert plain(go("throttle", lambda d: stateful.throttle_stream(d, "symbol", "t", 60))) == plain(quality.throttle(df, "symbol", "t", 60))
    assert plain(go("reconnect", lambda d: stateful.reconnect_stream(d, "symbol", "t", 30, 3))) == plain(quality.reconnect_alerts(df, "symbol", "t", 30, 3))
    chain = go("chain", lambda d: stateful.chain_breaks_stream(d, "seq")).select("seq", "expected")
    assert plain(chain) == plain(ordering.chain_breaks(df, ["seq"]).select("seq", "expected"))
    before, want = {}, []
    for r in rows:
        p = before.get(r[1])
        want.append((r[0], (r[5] - p) / p if p else 0.0))
        before[r[1]] = r[5]
    assert plain(go("depth", lambda d: stateful.depth_change_stream(d, "seq", "total")).select("seq", "depth_change_1m")) == want


def test_longs_beside_nulls_stay_exact(spark, tmp_path):
    rows = [(k, "A", k, 9_007_199_254_740_993 if k % 2 else None) for k in range(30)]
    got = in_three_runs(spark, rows, "seq long, symbol string, trade_id long, big long", str(tmp_path), "exact", lambda d: stateful.guard_stream(d, "trade_id", "seq"))
    assert sorted(map(tuple, got.collect())) == rows


def test_two_streams_with_their_own_checkpoints_keep_all_rows(spark, tmp_path):
    root = f"{tmp_path}/store"
    schema = SPECS["trades"].schema.simpleString()[7:-1].replace(":", " ")
    for name, start in (("one", 0), ("two", 50)):
        spark.createDataFrame([(5, "AUSDT", 1.0, 1.0, True, i, False, i) for i in range(start, start + 50)], schema).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}")
        sink = StoreSink("trades", root, look_up=name == "one")
        sink.start(stream, f"{tmp_path}/c-{name}").awaitTermination()
    assert storage.read(spark, "trades", root).count() == 100
    assert sink.finalize(spark) == 100 and storage.read(spark, "trades", root).count() == 100


def test_compaction_refuses_a_damaged_file(spark, tmp_path):
    root, schema = str(tmp_path), SPECS["trades"].schema.simpleString()[7:-1].replace(":", " ")
    for at in (0, 100):
        storage.append(spark.createDataFrame([(5, "AUSDT", 1.0, 1.0, True, i, False, i) for i in range(at, at + 100)], schema), "trades", root)
    folder = tmp_path / "trades/symbol=AUSDT/date=1970-01-01"
    damaged = sorted(folder.glob("*.parquet"))[0]
    whole = damaged.read_bytes()
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    damaged.write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        storage.compact(spark, "trades", root, "symbol = 'AUSDT'")
    assert len(list(folder.glob("*.parquet"))) == 2  # nothing was removed
    assert storage.read(spark, "trades", root).count() == 100
    damaged.write_bytes(whole)
    assert storage.compact(spark, "trades", root, "symbol = 'AUSDT'") == 200 and storage.read(spark, "trades", root).count() == 200


def test_counts_come_from_footers(spark, tmp_path):
    root, schema = str(tmp_path), SPECS["trades"].schema.simpleString()[7:-1].replace(":", " ")
    storage.append(spark.createDataFrame([(5, s, 1.0, 1.0, True, i, False, i) for s in ("AUSDT", "BUSDT") for i in range(7)], schema), "trades", root)
    counts = footers.footer_counts(spark, f"{root}/trades", partitions=["symbol", "date"], by=["symbol"])
    assert sorted(map(tuple, counts.collect())) == [("AUSDT", 7), ("BUSDT", 7)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "trade_id" not in plan
    assert tuple(footers.footer_range(spark, f"{root}/trades", "trade_id").first()) == (0, 6, 14)


def test_every_dropped_payload_is_a_reject_once(spark, tmp_path):
    good = {"T": 5, "s": "ausdt", "p": "1.5", "q": "2", "m": False, "a": 7}
    given = [good, {**good, "a": 8}, {**good, "p": "n/a"}, {k: v for k, v in good.items() if k != "q"}, {**good, "s": None}, {**good, "T": "soon", "q": None}, good]
    texts = [*map(json.dumps, given), "[1]", "no json", "", None]
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(t, 9) for t in texts], "data string, received_at long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    sink = StoreSink("trades", f"{tmp_path}/store", parser=parse.agg_trades, fields=("T", "s", "p", "q", "m", "a"))
    stream = spark.readStream.schema("data string, received_at long").parquet(f"{tmp_path}/in")
    sink.start(stream, f"{tmp_path}/c").awaitTermination()
    assert sorted(r.trade_id for r in storage.read(spark, "trades", f"{tmp_path}/store").collect()) == [7, 8]
    rejects = spark.read.parquet(f"{tmp_path}/store/_rejects/trades").collect()
    dropped = [(texts[2], "malformed p"), (texts[3], "missing q"), (texts[4], "missing s"), (texts[5], "malformed T"), ("[1]", "no object"), ("no json", "no object"), ("", "no object"), (None, "no object")]
    assert sorted(((r.payload, r.reject) for r in rejects), key=str) == sorted(dropped, key=str)
    assert {k: v for k, v in sink.counted.items() if v} == {"rows": 3, "rejects": 8, "no object": 4, "malformed p": 1, "missing q": 1, "missing s": 1, "malformed T": 1}
    # Every other parser gives each payload once as well.
    for parser in (parse.liquidations, parse.mark_prices, parse.funding, parse.open_interest, parse.depth, parse.rest_depth):
        rows = spark.createDataFrame([(t, 9, "AUSDT") for t in texts], "data string, received_at long, symbol string")
        checked = parser(rows, rejects=True)
        assert checked.count() == len(texts) and parser(rows).count() == checked.where("reject IS NULL").count() and checked.where("reject = 'no object'").count() == 4


def test_running_streams_report_peaks_and_failures(spark, tmp_path):
    listener = metrics.QueryMetrics(spark)
    spark.createDataFrame([(i, "A", i) for i in range(40)], "seq long, symbol string, trade_id long").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("seq long, symbol string, trade_id long").parquet(f"{tmp_path}/in")

    def fails(batch, number):
        raise OSError("disk full")

    stateful.guard_stream(stream, "trade_id", "seq").writeStream.format("noop").queryName("guarded").option("checkpointLocation", f"{tmp_path}/a").trigger(availableNow=True).start().awaitTermination()
    query = stream.writeStream.foreachBatch(fails).queryName("broken").option("checkpointLocation", f"{tmp_path}/b").trigger(availableNow=True).start()
    with pytest.raises(Exception):
        query.awaitTermination()
    import time

    until = time.time() + 20
    while time.time() < until and not {"guarded", "broken"} <= {r.queue for r in listener.rows().where("kind <> 'progress'").collect()}:
        time.sleep(0.2)
    listener.stop()
    assert listener.flush(f"{tmp_path}/metrics") >= 3 and listener.rows().count() == 0
    stored = metrics.stored_metrics(spark, f"{tmp_path}/metrics")
    got = {r.queue: r for r in metrics.state_peaks(stored).collect()}
    assert (got["guarded"].peak_size, got["guarded"].peak_state_rows, got["guarded"].failures) == (40, 1, 0) and got["broken"].failures == 1
    assert "disk full" in stored.where("queue = 'broken' AND kind = 'failed'").first().message
    assert {r.queue: r.peak for r in monitoring.queue_peaks(stored.where("kind = 'progress'")).collect()}["guarded"] == 40
    assert [(r.kind, r.n) for r in monitoring.failure_counts(stored.where("kind = 'failed'")).collect()] == [("failed", 1)]


def test_unwrap_goes_by_the_parsed_type(spark):
    given = {
        1: '{"stream": "a@b", "data": {"k": 1}}', 2: '{"stream": "a@b", "data": "{\\"k\\": 1}"}', 3: '  {"k": 1}', 4: "{abc", 5: '{"stream": "a@b", "data": [1]}',
        6: '{"stream": "a@b", "data": null}', 7: "[1]", 8: '"text"', 9: None, 10: "", 11: '{"data": {"k": 2}}', 12: '{"s": 1, "S": 2}',
    }
    rows = parse.unwrap(spark.createDataFrame(list(given.items()), "i int, value string")).collect()
    assert {r.i: (r.stream, json.loads(r.data)) for r in rows} == {1: ("a@b", {"k": 1}), 3: (None, {"k": 1}), 11: (None, {"k": 2}), 12: (None, {"s": 1, "S": 2})}


def test_sink_rejects_dedups_restarts_and_finalises(spark, tmp_path):
    root, source = f"{tmp_path}/store", f"{tmp_path}/in"
    day = 86_400_000
    put = lambda rows: spark.createDataFrame(rows, SPECS["trades"].schema.simpleString()[7:-1].replace(":", " ")).coalesce(1).write.mode("append").parquet(source)
    row = lambda i, ts=5, price=1.0: (ts, "AUSDT", price, 1.0, True, i, False, i)
    put([row(1), row(2), row(2, price=9.0), row(3, price=None), row(4, day + 1)])
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    sink = StoreSink("trades", root)
    sink.start(stream, f"{tmp_path}/c").awaitTermination()
    ids = lambda: sorted(r.trade_id for r in storage.read(spark, "trades", root).collect())
    assert ids() == [1, 2, 4]
    assert spark.read.parquet(f"{root}/_rejects/trades").count() == 1
    import datetime

    assert sink.finalize(spark, datetime.date(1970, 1, 2)) == 2 and ids() == [1, 2, 4]
    assert storage.segments(spark, "trades", root).count() == 1  # the open day's
    put([row(2), row(5), row(4, day + 1), row(6, day + 2)])  # a past day's late row, repeats
    query = sink.start(stream, f"{tmp_path}/c", seconds=0.2)
    assert sink.close(query) == 5
    assert ids() == [1, 2, 4, 5, 6] and storage.segments(spark, "trades", root) is None
    # A batch that runs again leaves one copy.
    batch = spark.createDataFrame([row(7)], SPECS["trades"].schema.simpleString()[7:-1].replace(":", " "))
    sink(batch, 99)
    sink(batch, 99)
    assert ids() == [1, 2, 4, 5, 6, 7]
    with pytest.raises(ValueError):
        StoreSink("depth20", root)


def test_recovery_finishes_or_drops_a_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = spark.createDataFrame([(5, "AUSDT", 1.0, 1.0, True, i, False, i) for i in (1, 2)], SPECS["trades"].schema.simpleString()[7:-1].replace(":", " "))
    storage.append(rows, "trades", root)
    real = storage._swap

    def die(*_):
        raise OSError("lost")

    monkeypatch.setattr(storage, "_swap", die)
    with pytest.raises(OSError):
        storage.compact(spark, "trades", root, "symbol = 'AUSDT'")
    monkeypatch.setattr(storage, "_swap", real)
    assert storage.read(spark, "trades", root).count() == 2
    (tmp_path / "_staging/trades/half/new").mkdir(parents=True)
    assert storage.recover(spark, root) == {"finished": 1, "dropped": 1}
    assert storage.read(spark, "trades", root).count() == 2 and not storage._children(spark, f"{root}/_staging/trades")
    listing = storage.files(spark, root)
    assert [(r.directory, r.day) for r in storage.dataset_bytes(listing).collect()] == [("trades", "1970-01-01")]


def test_envelope_stream_polls_and_reports(spark, tmp_path):
    lines = [{"received_at": 7, "message": {"stream": "a@aggTrade", "data": {"T": 5, "s": "ausdt", "p": "1.5", "q": "2", "m": False, "a": 7}}}, {"received_at": 8, "message": [1]}, {"message": {}}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text("\n".join(map(json.dumps, lines)) + "\nno json\n")
    q = run(streams.envelopes(spark, f"{tmp_path}/in"), parse.agg_trades, str(tmp_path), "env")
    assert q.exception() is None
    assert [(r.symbol, r.trade_id, r.received_at) for r in spark.table("env").collect()] == [("AUSDT", 7, 7)]
    assert parse.agg_trades(streams.envelopes_batch(spark, f"{tmp_path}/in")).count() == 1
    (tmp_path / "polled").mkdir()
    (tmp_path / "polled/1.json").write_text(json.dumps({"symbol": "AUSDT", "data": json.dumps({"symbol": "AUSDT", "openInterest": "5", "time": 3}), "received_at": 9}))
    run(streams.poll_answers(spark, f"{tmp_path}/polled"), parse.open_interest, str(tmp_path), "polled")
    assert spark.table("polled").count() == 1
    (tmp_path / "reports").mkdir()
    (tmp_path / "reports/a.json").write_text(json.dumps({"day": "d", "total": 5}, indent=2))
    (tmp_path / "reports/b.json").write_text("{broken")
    assert [tuple(r) for r in streams.reports(spark, f"{tmp_path}/reports", "day string, total long").collect()] == [("d", 5)]
    stored = spark.createDataFrame([("x", 1)], "symbol string, n int").withColumn("date", F.to_date(F.lit("1970-01-01")))
    now = spark.createDataFrame([(5,), (86_400_005,)], "timestamp long")
    assert [r.timestamp for r in streams.metadata_due(stored, now).collect()] == [86_400_005]
    assert len(streams.directories()) == len(set(streams.directories()))
