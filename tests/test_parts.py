"""Windows in parts give what one window over the whole history gives, however small parts and groups are."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, book, ordering, parts, quality, rolling

SCHEMA = "seq long, symbol string, timestamp long, price double, quantity double, is_buyer_maker boolean, trade_id long"


def trades(seed, late, n=400):
    rng, rows, now = random.Random(seed), [], 0
    for i in range(n):
        now += rng.choice([1, 500, 20_000, 70_000])
        ts = now - (rng.randint(0, 200_000) if late and rng.random() < 0.3 else 0)
        rows.append((i, rng.choice("AAAB"), max(0, ts), float(rng.randint(1, 50)), float(rng.randint(1, 9)), rng.random() < 0.5, i + rng.randint(0, 3) * (i % 5)))
    return rows


def same(one, other):
    a, b = (sorted(map(tuple, d.collect()), key=str) for d in (one, other.select(*one.columns)))
    assert a == b and a


@pytest.fixture(params=[1, 7, 60])
def small(request, monkeypatch):
    monkeypatch.setattr(parts, "GROUP_ROWS", request.param)
    return request.param


@pytest.mark.parametrize("width", [1, 13, 1000])
def test_bars_by_arrival_in_parts(spark, width):
    part = F.floor(F.col("seq") / width)
    df = spark.createDataFrame(trades(1, True), SCHEMA)
    same(bars.ohlcv_arrival(df, ["seq"]), bars.ohlcv_arrival(df, ["seq"], part=part))
    same(bars.taker_delta_arrival(df, ["seq"], 300_000), bars.taker_delta_arrival(df, ["seq"], 300_000, part=part))


def test_rolling_windows_in_parts(spark, small):
    df = spark.createDataFrame([(i, s, ts + i, p, *r) for i, s, ts, p, *r in trades(2, False)], SCHEMA)
    oi, spread = df.withColumnRenamed("price", "open_interest"), df.withColumn("spread_bps", F.round(F.col("price") / 7, 3))
    part = F.floor(F.col("timestamp") / 400_000)
    same(rolling.oi_change(oi, history=12), rolling.oi_change(oi, history=12, part=part))
    same(rolling.oi_change(oi, history=None), rolling.oi_change(oi, history=None, part=part))
    same(rolling.oi_change(oi, "seq", 5), rolling.oi_change(oi, "seq", 5, part=F.floor(F.col("seq") / 9)))
    same(rolling.spread_state(spread, window=30, scale=1000), rolling.spread_state(spread, window=30, scale=1000, part=part))


def test_gaps_and_depth_change_in_parts(spark, small):
    df = spark.createDataFrame(trades(3, False), SCHEMA).dropDuplicates(["symbol", "trade_id"])
    same(ordering.id_gaps(df), ordering.id_gaps(df, part=F.floor(F.col("trade_id") / 11)))
    live = df.where("trade_id % 5 <> 3")
    same(ordering.recover_gaps(live, df, ["seq"], bucket=10), ordering.recover_gaps(live, df, ["seq"], bucket=10, part=F.floor(F.col("seq") / 20), id_part=F.floor(F.col("trade_id") / 20)))
    level = lambda x: F.array(F.struct(F.col(x).alias("price"), F.col("quantity").alias("qty")))
    books = df.select("symbol", "seq", F.col("seq").alias("timestamp"), level("price").alias("bids"), level("quantity").alias("asks"))
    same(book.liquidity_stress(books), book.liquidity_stress(books, part=F.floor(F.col("timestamp") / 17)))


def test_a_group_holds_its_rows_and_a_bounded_halo(spark, monkeypatch):
    monkeypatch.setattr(parts, "GROUP_ROWS", 50)
    df = spark.createDataFrame([("A", i) for i in range(1000)], "symbol string, seq long")
    got = parts.with_halo(df, F.floor(F.col("seq") / 10), rows=15).groupBy("_group").agg(F.count_if("_own").alias("own"), F.count_if(~F.col("_own")).alias("halo")).collect()
    assert sorted(r.own for r in got) == [50] * 20 and sum(r.halo for r in got) == 19 * 20
    assert parts.with_halo(df.where("false"), F.col("seq"), rows=5).count() == 0


def test_tier_notionals_equal_a_fold_each(spark):
    rng = random.Random(4)
    side = lambda: None if rng.random() < 0.1 else [(rng.choice([None, round(rng.random() * 9, 3)]) if rng.random() < 0.1 else round(rng.random() * 9, 3), float(rng.randint(1, 9))) for _ in range(rng.randint(0, 60))]
    level = "array<struct<price:double,qty:double>>"
    df = spark.createDataFrame([(i, "A", side(), side()) for i in range(60)], f"timestamp long, symbol string, bids {level}, asks {level}")
    tiers = book.notionals(df).select("timestamp", "_bids", "_asks", *[book.level_notional(s, n).alias(f"{s}{n}") for s in ("bids", "asks") for n in book.TIERS])
    for r in tiers.collect():
        for s in ("bids", "asks"):
            each = [r[f"{s}{n}"] for n in book.TIERS]
            assert (r[f"_{s}"] or [None] * 4) == each


@pytest.mark.parametrize("block", [1, 2, 256])
def test_spaced_events_and_alerts_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    monkeypatch.setattr(parts, "GROUP_ROWS", 5)
    rng, rows, sent, fired = random.Random(block), [], [], []
    for k in ("a", "b", None):
        now, last, held = rng.randint(0, 50), None, []
        for _ in range(300):
            now += rng.choice([0, 1, 7, 40, 41, 500]) if k else rng.choice([0, 1])
            rows.append((k, now))
            if last is None or now - last >= 40:
                last = now
                sent.append((k, now))
            held = [x for x in held if now - x <= 40] + [now]
            if len(held) >= 3:
                fired.append((k, now))
                held = []
    rows += [("a", None), ("lone", 5)]
    sent.append(("lone", 5))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t long")
    order = lambda found: sorted(found, key=lambda r: (str(r[0]), r[1]))
    assert order(map(tuple, quality.throttle(df, "k", "t", 40).collect())) == order(sent)
    assert order(map(tuple, quality.reconnect_alerts(df, "k", "t", 40, 3).collect())) == order(fired)
    assert quality.throttle(df.where("false"), "k", "t", 40).count() == 0


def test_day_bitmaps_merge_without_reading_again(spark):
    rng = random.Random(5)
    rows = [(rng.choice("AB"), "1970-01-01", rng.choice([0, 59_999, 86_399_999, rng.randint(0, 86_399_999)])) for _ in range(300)]
    df = lambda part: spark.createDataFrame(part, "symbol string, day string, timestamp long")
    one = quality.minute_bitmaps(df(rows))
    two = quality.merge_bitmaps(quality.minute_bitmaps(df(rows[:100])), quality.minute_bitmaps(df(rows[100:])))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    want = {s: 1440 - len({t // 60_000 for x, _, t in rows if x == s}) for s in "AB"}
    assert {r.symbol: r.missing_minutes for r in quality.missing_in_bitmaps(two).collect()} == want
    assert {len(r.minutes) for r in two.collect()} == {180}
