"""Streaming operators as named queries: a stream over a table, stopped and started again from its checkpoint, run to its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.folders import shared_folder
from tidemark.operators import book
from tidemark.sources import storage
from tidemark.streaming import stateful
from tidemark.streaming.store import StoreSink

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_HOUR = 3_600_000
_EV = """ev AS (SELECT event_type AS symbol, epoch_us(ts)//1000 AS timestamp, value AS price, CAST(user_id AS DOUBLE) AS quantity, event_id AS trade_id, user_id,
  event_id + CASE WHEN event_id % 97 = 0 THEN 500 ELSE 0 END AS arrival FROM events)"""


def _query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[name], _SQL[name] = f, sql
        return f

    return add


#: Rows of a share, as far as ``order`` parts them: what a run's tasks hold does not grow with the input.
SHARE_ROWS = 1_500_000


def _edges(rows: DataFrame, order: str, runs: int) -> list:
    """Values of ``order`` at which a new share begins, from a count of every value's neighbourhood: shares of ``SHARE_ROWS`` at most, ``runs`` at least."""
    ends = rows.agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count(order).alias("n")).first()
    if not ends.n:
        return []
    # Cells narrow enough for many of them to a share; equal values stay together.
    shares = max(runs, -(-ends.n // SHARE_ROWS))
    width = max(1, (ends.hi - ends.lo + 1) // (64 * shares))
    cell = F.floor((F.col(order) - F.lit(ends.lo)) / width)
    most, edges, held = -(-ends.n // shares), [], 0
    for at, n in sorted((r[0], r[1]) for r in rows.where(F.col(order).isNotNull()).groupBy(cell.alias("cell")).count().collect()):  # at most about 64 a share
        if held and held + n > most:
            edges.append(ends.lo + at * width)
            held = 0
        held += n
    return edges


def in_runs(spark: SparkSession, rows: DataFrame, order: str, base: str, start: Callable[[DataFrame, int | None, int | None], StreamingQuery], runs: int = 2, before_last: Callable[[], None] = lambda: None) -> None:
    """Gives ``rows`` to a stream in ``runs`` shares or more along ``order``; each is taken to its end by a query of its own, from what the one before left.

    ``start`` gets the stream and the values of ``order`` at which the share begins and the next one does (None at the ends).
    A share has ``SHARE_ROWS`` rows at most, so that a keyed operator, which
    puts a batch's rows of a key in order, holds no more, however long the input is.
    """
    edges = _edges(rows, order, runs)
    share = sum(((F.col(order) >= F.lit(e)).cast("int") for e in edges), F.lit(0)) if len(edges) < 32 else F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(order)))
    rows.withColumn("_share", F.coalesce(share, F.lit(0))).write.partitionBy("_share").parquet(f"{base}/shares")
    shares = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_share", T.IntegerType())])).parquet(f"{base}/shares")
    for run in range(len(edges) + 1):
        shares.where(F.col("_share") == run).drop("_share").write.mode("append").parquet(f"{base}/in")
        if run == len(edges):
            before_last()
        start(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), *[edges[i] if 0 <= i < len(edges) else None for i in (run - 1, run)]).awaitTermination()


def finished(spark: SparkSession, rows: DataFrame, order: str, build: Callable[..., DataFrame], label: str, runs: int = 2, before_last: Callable[[], None] = lambda: None, bounds: bool = False) -> DataFrame:
    """What ``build`` makes of ``rows`` as a stream that is stopped and started again from its checkpoint; with ``bounds`` it gets those of the share, too."""
    base = shared_folder(spark, f"stream-{label}")
    stateful.use_state_store(spark)
    kinds = []

    def start(stream: DataFrame, since: int | None, until: int | None) -> StreamingQuery:
        out = build(stream, since, until) if bounds else build(stream)
        kinds.append(out.schema)
        return out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()

    in_runs(spark, rows, order, base, start, runs, before_last)
    return spark.read.schema(kinds[0]).parquet(f"{base}/out")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    late = F.col("event_id") + F.when(F.col("event_id") % 97 == 0, 500).otherwise(0)
    return e.select(
        F.col("event_type").alias("symbol"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("value").alias("price"), F.col("user_id").cast("double").alias("quantity"),
        F.col("event_id").alias("trade_id"), "user_id", late.alias("arrival"),
    )


@_query("guard_stream", f"""WITH {_EV} SELECT symbol, trade_id, timestamp FROM (SELECT *, max(trade_id) OVER (PARTITION BY symbol ORDER BY arrival, trade_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM ev) WHERE b IS NULL OR trade_id > b""")
def _(s, d):
    rows = _events(s, d).select("symbol", "trade_id", "timestamp", (F.col("arrival") * 2 + (F.col("trade_id") == F.col("arrival")).cast("long")).alias("seq"))
    return finished(s, rows, "seq", lambda x: stateful.guard_stream(x, "trade_id", "seq"), "guard").drop("seq")


@_query("recover_gaps_stream", f"""WITH {_EV}, live AS (SELECT * FROM ev WHERE trade_id % 5 <> 3), b AS (SELECT symbol, min(trade_id) AS lo, max(trade_id) AS hi FROM live GROUP BY symbol)
  SELECT symbol, trade_id, price, false AS is_recovered FROM live UNION ALL
  SELECT e.symbol, trade_id, price, true FROM ev e JOIN b ON e.symbol = b.symbol WHERE trade_id % 5 = 3 AND trade_id > lo AND trade_id < hi""")
def _(s, d):
    every = _events(s, d).select("symbol", "trade_id", "price")
    live = every.where("trade_id % 5 <> 3")

    def build(x, since, until):
        # What a share misses lies behind the last id of a symbol before it, and ahead of the next share.
        backfill = every if until is None else every.where(F.col("trade_id") < until)
        if since is not None:
            last = live.where(F.col("trade_id") < since).groupBy("symbol").agg(F.max("trade_id").alias("last")).agg(F.min("last")).first()[0]
            backfill = backfill.where(F.col("trade_id") > last)
        return stateful.recover_gaps_stream(x, backfill, "trade_id")

    return finished(s, live, "trade_id", build, "gaps", bounds=True).drop("ahead_of")


@_query("recent_keys_stream", f"WITH {_EV} SELECT symbol, user_id, min(trade_id) AS trade_id FROM ev GROUP BY 1, 2")
def _(s, d):
    """A memory that holds all keys drops just the repeats."""
    return finished(s, _events(s, d).select("symbol", "user_id", "trade_id"), "trade_id", lambda x: stateful.recent_keys(x, ["symbol", "user_id"], "trade_id", shards=4), "keys")


@_query("ohlcv_timed_stream", f"""WITH {_EV} SELECT symbol, timestamp // {_HOUR} * {_HOUR} AS minute_start, arg_min(price, trade_id) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, trade_id) AS close, sum(quantity) AS volume, count(*) AS trade_count FROM ev GROUP BY ALL""")
def _(s, d):
    """Hourly bars; a mark past the last trade closes the bars that are open then. An hour's trades come in one share and in order of id."""
    rows = _events(s, d).select("symbol", "timestamp", "price", "quantity", "trade_id").withColumn("hour", F.floor(F.col("timestamp") / _HOUR))
    marks = f"{shared_folder(s, 'marks')}/ends"
    seen = rows.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    stateful.mark_end(s, marks, seen.lo or 0)  # moves nothing; the folder must be there
    end = lambda: stateful.mark_end(s, marks, (seen.hi or 0) + 3 * _HOUR)
    ends = lambda: s.readStream.schema("timestamp long").parquet(marks)
    return finished(s, rows, "hour", lambda x: stateful.ohlcv_stream(x, _HOUR, ["hour", "trade_id"], late="1 hour", ends=ends()), "bars", runs=1, before_last=end)


@_query("asof_stream", f"""WITH {_EV} SELECT v.user_id, v.trade_id, s.price AS signup_value FROM (SELECT * FROM ev WHERE symbol = 'view') v
  ASOF LEFT JOIN (SELECT * FROM ev WHERE symbol = 'signup') s ON v.user_id = s.user_id AND v.trade_id >= s.trade_id""")
def _(s, d):
    def build(x):
        views, signups = x.where("symbol = 'view'").select("user_id", "trade_id"), x.where("symbol = 'signup'").select("user_id", "trade_id", F.col("price").alias("signup_value"))
        return stateful.asof_stream(views, signups, ["signup_value"], "user_id", "trade_id")

    return finished(s, _events(s, d).select("symbol", "user_id", "trade_id", "price"), "trade_id", build, "asof")


@_query("depth_merge_stream", """WITH bk AS (SELECT l_suppkey AS symbol, l_suppkey * 100 + year(l_shipdate) - 1990 AS received_at, list({'p': l_extendedprice, 'q': l_quantity} ORDER BY l_extendedprice DESC, l_quantity DESC) AS b FROM lineitem GROUP BY 1, 2)
  SELECT v.received_at, v.symbol, v.b[20].p AS bid_price_20, s.b[21].p AS bid_price_21, s.b[50].q AS bid_qty_50
  FROM bk v ASOF LEFT JOIN (SELECT * FROM bk WHERE received_at % 3 = 0) s ON v.symbol = s.symbol AND v.received_at >= s.received_at""")
def _(s, d):
    level = F.struct(F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("double").alias("qty"))
    li = s.read.parquet(f"{d}/lineitem.parquet").withColumn("received_at", (F.col("l_suppkey") * 100 + F.year("l_shipdate") - 1990).cast("long"))
    books = li.groupBy(F.col("l_suppkey").cast("long").alias("symbol"), "received_at").agg(F.slice(F.sort_array(F.collect_list(level), asc=False), 1, 50).alias("bids")).withColumn("asks", F.col("bids"))

    def build(x):
        return book.merge_depth_stream(x, x.where("received_at % 3 = 0"))

    got = finished(s, books, "received_at", build, "depth")
    at = lambda i, c: F.get("bids", F.lit(i - 1))[c].alias(f"bid_{c}_{i}")
    return got.select("received_at", "symbol", at(20, "price"), at(21, "price"), at(50, "qty"))


@_query("throttle_stream", f"""WITH RECURSIVE {_EV}, t AS (SELECT symbol, timestamp // 1000 AS t FROM ev), sent AS (
  SELECT symbol, min(t) AS t FROM t GROUP BY symbol UNION ALL
  SELECT s.symbol, (SELECT min(x.t) FROM t x WHERE x.symbol = s.symbol AND x.t >= s.t + 14400) FROM sent s WHERE s.t IS NOT NULL)
  SELECT symbol, t AS sent_at FROM sent WHERE t IS NOT NULL""")
def _(s, d):
    rows = _events(s, d).select("symbol", F.floor(F.col("timestamp") / 1000).alias("t"))
    return finished(s, rows, "t", lambda x: stateful.throttle_stream(x, "symbol", "t", 14_400), "throttle")


# Every tenth trade comes again, later and at another price: the first one stays.
_KEPT = f"WITH {_EV} SELECT symbol, trade_id, price, CAST(CAST(make_timestamp(timestamp * 1000) AS DATE) AS VARCHAR) AS day, trade_id AS received_at FROM ev"


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf).select("timestamp", "symbol", "price", "quantity", (F.col("trade_id") % 2 == 0).alias("is_buyer_maker"), "trade_id", F.lit(False).alias("is_recovered"), F.col("trade_id").alias("received_at"))
    again = e.where("trade_id % 10 = 0").withColumn("price", F.col("price") + 1).withColumn("received_at", F.col("received_at") + 1_000_000_000)
    return e.unionByName(again)


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return storage.read(spark, "trades", root).select("symbol", "trade_id", "price", F.col("date").cast("string").alias("day"), "received_at")


@_query("store_sink", _KEPT)
def _(s, d):
    """Trades through the streaming sink in two runs, of which the second brings the repeats; one part of the days is finalised, the rest are segments."""
    root, base = shared_folder(s, "sink"), shared_folder(s, "sink-stream")
    sink = StoreSink("trades", root)
    rows = _repeated(s, d)
    in_runs(s, rows, "received_at", base, lambda stream, *_: sink.start(stream, f"{base}/checkpoint"))
    days = rows.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).select(F.to_date(F.timestamp_millis(F.floor((F.col("lo") + F.col("hi")) / 2)))).first()[0]
    sink.finalize(s, days)
    return _stored(s, root)


@_query("store_compacted", _KEPT)
def _(s, d):
    """Trades appended in two lots, repeats in the second, and compacted."""
    root, rows = shared_folder(s, "store"), _repeated(s, d)
    for lot in (rows.where("trade_id % 3 = 0 AND received_at < 1000000000"), rows.where("trade_id % 3 <> 0 OR received_at >= 1000000000")):
        storage.append(lot, "trades", root)
    storage.compact(s, "trades", root, "date IS NOT NULL")
    return _stored(s, root)


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
