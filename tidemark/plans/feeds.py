"""Named queries of parsers, sources and storage views: payloads and file listings are made of the driver's tables, and their SQL reads the tables direct."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import symbols
from tidemark.operators import book, monitoring, ordering, quality, rolling
from tidemark.sources import footers, layout, parse, storage, streams

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[name], _SQL[name] = f, sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _object(**fields: Column) -> Column:
    """A JSON object; null fields are left out. A leading ``up_`` stands for a name in upper case."""
    return F.to_json(F.struct(*[v.alias(k.removeprefix("up_").upper() if k.startswith("up_") else k) for k, v in fields.items()]))


def _ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


# Prices below 1 are written as no number: such rows must go.
def _trade_payloads(s: SparkSession, d: str, with_symbol: bool) -> DataFrame:
    e = _t(s, d, "events")
    price = F.when(F.col("value") < 1, "n/a").otherwise(_text("value"))
    named = {"s": F.lower("event_type")} if with_symbol else {}
    data = _object(up_t=_ms("ts"), **named, p=price, q=_text("user_id"), m=F.col("event_type") == "view", a=F.col("event_id"))
    return e.select(data.alias("data"), (_ms("ts") + 5).alias("received_at"), F.lower("event_type").alias("symbol"))


def _trades_sql(recovered: str) -> str:
    return f"""SELECT epoch_us(ts)//1000 AS timestamp, upper(event_type) AS symbol, value AS price, CAST(user_id AS DOUBLE) AS quantity, event_type = 'view' AS is_buyer_maker,
  event_id AS trade_id, {recovered} AS is_recovered, epoch_us(ts)//1000 + 5 AS received_at FROM events WHERE value >= 1"""


@_query("parse_trades", _trades_sql("false"))
def _(s, d):
    return parse.agg_trades(_trade_payloads(s, d, True))


@_query("parse_backfilled_trades", _trades_sql("true"))
def _(s, d):
    return parse.agg_trades(_trade_payloads(s, d, False), symbol="symbol")


@_query("unwrap_envelopes", """SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type || '@trade' END AS stream, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'""")
def _(s, d):
    e = _t(s, d, "events")
    # Sign-ups come bare, errors as a list, the others in an envelope.
    bare, body = F.col("event_type") == "signup", F.from_json("props", "k bigint")
    wrapped = _object(stream=F.concat("event_type", F.lit("@trade")), data=body)
    message = F.when(bare, F.col("props")).when(F.col("event_type") == "error", F.lit("[1, 2]")).otherwise(wrapped)
    return parse.unwrap(e.select("event_id", message.alias("value"))).select("event_id", "stream", F.from_json("data", "k bigint")["k"].alias("k"))


@_query("parse_liquidations", """WITH a AS (SELECT l_orderkey AS timestamp, 'S' || l_suppkey AS symbol, CASE WHEN l_linestatus = 'O' THEN 'SELL' ELSE 'BUY' END AS side,
  CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE l_tax END AS price, CASE WHEN l_quantity > 25 THEN l_quantity ELSE 1.0 END AS quantity, CASE WHEN l_linenumber > 1 THEN l_partkey END AS order_timestamp FROM lineitem)
  SELECT timestamp, symbol, side, price, quantity, price * quantity AS notional, order_timestamp, timestamp + 1 AS received_at FROM a""")
def _(s, d):
    li = _t(s, d, "lineitem")
    order = F.struct(
        F.concat(F.lit("s"), "l_suppkey").alias("s"), F.when(F.col("l_linestatus") == "O", "SELL").otherwise("BUY").alias("S"), _text("l_tax").alias("p"),
        F.when(F.col("l_discount") > 0.05, _text("l_extendedprice")).alias("ap"), F.lit("1").alias("q"), F.when(F.col("l_quantity") > 25, _text("l_quantity")).otherwise("").alias("z"),
        F.when(F.col("l_linenumber") > 1, F.col("l_partkey")).alias("T"),
    )
    return parse.liquidations(li.select(_object(up_e=F.col("l_orderkey"), o=order).alias("data"), (F.col("l_orderkey") + 1).alias("received_at")))


@_query("parse_mark_prices", """SELECT p_partkey AS event_time, upper(p_type) AS symbol, p_partkey + 3 AS received_at, p_retailprice AS mark_price, p_retailprice / 2 AS index_price,
  CASE WHEN p_size > 25 THEN p_retailprice * 2 END AS estimated_settle_price, CAST(p_size AS DOUBLE) AS predicted_funding_rate, p_partkey * 10 AS next_funding_time FROM part WHERE p_brand <> 'Brand#1'""")
def _(s, d):
    p = _t(s, d, "part")
    rate = F.when(F.col("p_brand") != "Brand#1", _text("p_size"))  # without it the payload is incomplete
    data = _object(up_e=F.col("p_partkey"), s=F.lower("p_type"), p=_text("p_retailprice"), i=_text(F.col("p_retailprice") / 2), r=rate, up_t=F.col("p_partkey") * 10, up_p=F.when(F.col("p_size") > 25, _text(F.col("p_retailprice") * 2)))
    return parse.mark_prices(p.select(data.alias("data"), (F.col("p_partkey") + 3).alias("received_at")))


# Open orders carry their time, filled ones no time at all, pending ones a malformed one.
_TIMED = "CASE WHEN o_orderstatus = 'O' THEN o_custkey ELSE o_orderkey END AS timestamp"


def _polled(s: SparkSession, d: str, **fields: Column) -> DataFrame:
    o = _t(s, d, "orders")
    time = F.when(F.col("o_orderstatus") == "O", _text("o_custkey")).when(F.col("o_orderstatus") == "P", F.lit("soon"))
    return o.select(_object(symbol=F.lower("o_orderpriority"), time=time, **fields).alias("data"), F.col("o_orderkey").alias("received_at"))


@_query("parse_funding", f"""SELECT {_TIMED}, upper(o_orderpriority) AS symbol, o_totalprice / 1e9 AS funding_rate, o_orderkey * 2 AS next_funding_time, o_totalprice AS mark_price, o_orderkey AS received_at
  FROM orders WHERE o_orderstatus <> 'P'""")
def _(s, d):
    return parse.funding(_polled(s, d, markPrice=_text("o_totalprice"), lastFundingRate=_text(F.col("o_totalprice") / 1e9), nextFundingTime=F.col("o_orderkey") * 2))


@_query("parse_open_interest", f"SELECT {_TIMED}, upper(o_orderpriority) AS symbol, o_totalprice AS open_interest, o_orderkey AS received_at FROM orders WHERE o_orderstatus <> 'P'")
def _(s, d):
    return parse.open_interest(_polled(s, d, openInterest=_text("o_totalprice")))


def _sides(s: SparkSession, d: str) -> DataFrame:
    """(id, k, bids, asks), one book a supplier and year, as arrays of [price, quantity] texts: open lines by falling, shipped lines by rising price."""
    level = F.struct(F.col("l_extendedprice").alias("p"), F.col("l_quantity").alias("q"))
    side = lambda status, rising: F.transform(F.sort_array(F.collect_list(F.when(F.col("l_linestatus") == status, level)), asc=rising), lambda x: F.array(_text(x["p"]), _text(x["q"])))
    year = F.year("l_shipdate") - 1990
    return _t(s, d, "lineitem").groupBy((F.col("l_suppkey") * 100 + year).cast("long").alias("id"), F.col("l_suppkey").alias("k")).agg(side("O", False).alias("b"), side("F", True).alias("a"))


def _sides_sql() -> str:
    one = lambda status, way: f"list({{'p': l_extendedprice, 'q': l_quantity}} ORDER BY l_extendedprice {way}, l_quantity {way}) FILTER (WHERE l_linestatus = '{status}')"
    return f"bk AS (SELECT CAST(l_suppkey * 100 + year(l_shipdate) - 1990 AS BIGINT) AS id, l_suppkey AS k, {one('O', 'DESC')} AS b, {one('F', 'ASC')} AS a FROM lineitem GROUP BY 1, 2)"


def _wide_sql(levels: int, own: int | None = None) -> str:
    """The columns of a wide book; levels past ``own`` come from the snapshot s."""
    of = lambda i: "" if own is None else "v." if i <= own else "s."
    return ", ".join(f"{of(i)}{x}[{i}].{w[0]} AS {n}_{w}_{i}" for n, x in (("bid", "b"), ("ask", "a")) for i in range(1, levels + 1) for w in ("price", "qty"))


@_query("parse_depth", f"""WITH {_sides_sql()} SELECT id AS timestamp, 'S' || k AS symbol, id * 3 AS first_update_id, id * 3 + 2 AS final_update_id,
  CASE WHEN id % 2 = 0 THEN id * 3 - 1 END AS prev_final_update_id, id + 1 AS transaction_time, id + 9 AS received_at, {_wide_sql(20)} FROM bk""")
def _(s, d):
    o = F.col("id")
    data = _object(up_e=o, up_t=o + 1, s=F.concat(F.lit("s"), "k"), up_u=o * 3, b=F.col("b"), a=F.col("a"), lastUpdateId=o * 3 + 2, pu=F.when(o % 2 == 0, o * 3 - 1))
    return book.to_wide(parse.depth(_sides(s, d).select(data.alias("data"), (o + 9).alias("received_at"))), 20)


@_query("parse_rest_depth", f"WITH {_sides_sql()} SELECT id + 9 AS timestamp, 'S' || k AS symbol, id * 3 AS final_update_id, id + 9 AS received_at, {_wide_sql(50)} FROM bk")
def _(s, d):
    data = _object(lastUpdateId=F.col("id") * 3, bids=F.col("b"), asks=F.col("a"))
    polled = _sides(s, d).select(data.alias("data"), (F.col("id") + 9).alias("received_at"), F.concat(F.lit("s"), "k").alias("symbol"))
    return book.to_wide(parse.rest_depth(polled), 50)


@_query("merge_depth", f"""WITH {_sides_sql()}, snaps AS (SELECT * FROM bk WHERE id % 3 = 0) SELECT v.id AS received_at, v.k AS symbol, {_wide_sql(50, 20)}
  FROM bk v ASOF LEFT JOIN snaps s ON v.k = s.k AND v.id >= s.id""")
def _(s, d):
    typed = lambda c: F.transform(c, lambda x: F.struct(F.get(x, F.lit(0)).cast("double").alias("price"), F.get(x, F.lit(1)).cast("double").alias("qty")))
    rows = _sides(s, d).select(F.col("k").alias("symbol"), F.col("id").alias("received_at"), typed("b").alias("bids"), typed("a").alias("asks"))
    return book.to_wide(book.merge_depth(rows, rows.where("received_at % 3 = 0")), 50)


@_query("rejected_payloads", """WITH p AS (SELECT *, o_custkey % 7 AS k FROM orders) SELECT o_orderkey AS received_at,
  CASE WHEN k = 0 THEN 'no object' WHEN o_orderstatus = 'P' THEN 'malformed time' WHEN k = 1 THEN 'missing lastFundingRate' WHEN k = 2 THEN 'malformed markPrice' END AS reject FROM p
  WHERE k < 3 OR o_orderstatus = 'P'""")
def _(s, d):
    """Funding payloads that give no row, each once, with the first reason."""
    o = _t(s, d, "orders").withColumn("k", F.col("o_custkey") % 7)
    time = F.when(F.col("o_orderstatus") == "O", _text("o_custkey")).when(F.col("o_orderstatus") == "P", F.lit("soon"))
    price = F.when(F.col("k") == 2, "n/a").otherwise(_text("o_totalprice"))
    data = _object(symbol=F.lower("o_orderpriority"), time=time, markPrice=price, lastFundingRate=F.when(F.col("k") != 1, _text("o_totalprice")), nextFundingTime=F.col("o_orderkey"))
    checked = parse.funding(o.select(F.when(F.col("k") == 0, F.concat(F.lit("["), data, F.lit("]"))).otherwise(data).alias("data"), F.col("o_orderkey").alias("received_at")), rejects=True)
    return parse.split(checked)[1].select("received_at", "reject")


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@_query("footer_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def _(s, d):
    """Rows of every table from the footers of its files."""
    counts = [footers.footer_counts(s, f"{d}/{t}.parquet").select(F.lit(t).alias("name"), "n_rows") for t in _COUNTED]
    return functools.reduce(DataFrame.unionByName, counts)


@_query("footer_range", "SELECT min(l_orderkey) AS least, max(l_orderkey) AS most, count(*) AS n_rows FROM lineitem")
def _(s, d):
    return footers.footer_range(s, f"{d}/lineitem.parquet", "l_orderkey")


#: Part keys that an answer of the exchange reaches over.
ANSWER_KEYS = 20_000


@_query("exchange_metadata", """SELECT upper(p_brand) || '-' || p_partkey AS symbol, p_retailprice AS tick_size, CAST(p_size AS DOUBLE) AS step_size, 0.0 AS min_qty, CAST(p_size AS DOUBLE) AS min_notional,
  CAST(NULL AS DOUBLE) AS maker_fee, CAST(NULL AS DOUBLE) AS taker_fee, CAST(p_size AS BIGINT) AS timestamp, p_partkey AS pos FROM part WHERE p_retailprice > 950""")
def _(s, d):
    p = _t(s, d, "part").withColumn("symbol", F.concat(F.lower("p_brand"), F.lit("-"), "p_partkey"))
    one = lambda kind, **kv: F.create_map(F.lit("filterType"), F.lit(kind), *[x for k, v in kv.items() for x in (F.lit(k), _text(v))])
    filters = F.array(one("PRICE_FILTER", tickSize=F.col("p_retailprice")), one("LOT_SIZE", stepSize=F.col("p_size")), one("NOTIONAL", minNotional=F.col("p_size")))
    # Answers for each brand and size list its parts, those of one stretch of keys in each: an answer is no longer for more parts.
    payload = p.groupBy("p_brand", "p_size", F.floor(F.col("p_partkey") / ANSWER_KEYS)).agg(F.to_json(F.struct(F.collect_list(F.struct("symbol", filters.alias("filters"))).alias("symbols"))).alias("data"))
    configured = p.where("p_retailprice > 950").select(F.upper("symbol").alias("symbol"), F.col("p_partkey").alias("pos"))
    return parse.exchange_metadata(payload.select("data", F.col("p_size").cast("long").alias("received_at")), configured)


@_query("active_perpetuals", "SELECT upper(c_name) AS symbol FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 0 AND c_nationkey < 20")
def _(s, d):
    c = _t(s, d, "customer")
    one = F.struct(
        F.col("c_name").alias("symbol"), F.when(F.col("c_mktsegment") == "MACHINERY", "PERPETUAL").otherwise("CURRENT_QUARTER").alias("contractType"),
        F.when(F.col("c_acctbal") > 0, "USDT").otherwise("BUSD").alias("quoteAsset"), F.when(F.col("c_nationkey") < 20, "TRADING").otherwise("BREAK").alias("status"),
    )
    return parse.active_perpetuals(c.groupBy("c_nationkey", "c_mktsegment").agg(F.to_json(F.struct(F.collect_list(one).alias("symbols"))).alias("data")))


@_query("depth_dedup", """WITH k AS (SELECT *, coalesce(CASE WHEN l_linenumber < 3 THEN l_partkey END, l_orderkey) AS u FROM lineitem)
  SELECT l_suppkey AS symbol, u AS update, min(l_orderkey * 10 + l_linenumber) AS received_at FROM k GROUP BY 1, 2""")
def _(s, d):
    li = _t(s, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.when(F.col("l_linenumber") < 3, F.col("l_partkey")).alias("final_update_id"), F.col("l_orderkey").alias("timestamp"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("received_at"))
    return ordering.dedup_first(ordering.depth_key(li), ["symbol", "update"], ["received_at"]).select("symbol", "update", "received_at")


@_query("spread_state_plain", """WITH a AS (SELECT event_type AS symbol, epoch_us(ts)//1000 AS timestamp, value AS x FROM events),
  w AS (SELECT *, avg(x) OVER f AS m, stddev_pop(x) OVER f AS sd FROM a WINDOW f AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 299 PRECEDING AND CURRENT ROW))
  SELECT timestamp, symbol, x AS spread_bps, CAST(round(CASE WHEN sd > 1e-9 THEN (x - m) / sd ELSE 0 END * 9999.1) AS BIGINT) AS z4, CAST(round(m * 9999.1) AS BIGINT) AS mean4, CAST(round(sd * 9999.1) AS BIGINT) AS std4 FROM w""")
def _(s, d):
    e = _t(s, d, "events").select(F.col("event_type").alias("symbol"), _ms("ts").alias("timestamp"), F.col("value").alias("spread_bps"), "event_id")
    four = lambda c: F.round(F.col(c) * 9999.1).cast("long")
    return rolling.spread_state(e, tie="event_id", least=1e-9).select("timestamp", "symbol", "spread_bps", four("spread_zscore").alias("z4"), four("rolling_spread_mean").alias("mean4"), four("rolling_spread_std").alias("std4"))


# A listing of files: one per order, in the new layout (filled), the old one (open), or outside of both; some are no Parquet.
_LISTED = """ls AS (SELECT o_orderkey, o_custkey, o_orderstatus AS st, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, 'SYM0' || (o_custkey % 5) AS sym, o_custkey AS length FROM orders)"""


def _listing(s: SparkSession, d: str) -> DataFrame:
    o = _t(s, d, "orders")
    day, sym, n = F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("SYM0"), F.col("o_custkey") % 5), F.col("o_orderkey")
    path = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/d/trades/symbol="), sym, F.lit("/date="), day, F.lit("/"), n, F.lit(".parquet")))
    path = path.when(F.col("o_orderstatus") == "O", F.concat(F.lit("/d/trades/"), sym, F.lit("/"), day, F.lit("/"), n, F.lit(".parquet")))
    other = F.concat(F.lit("/d/logs/"), n, F.when(F.col("o_orderpriority") < "3", ".tmp").otherwise(".log"))
    return o.select(path.otherwise(other).alias("path"), F.col("o_custkey").alias("length"))


@_query("layout_audit", f"""WITH {_LISTED}, a AS (SELECT CASE st WHEN 'F' THEN 'hive' WHEN 'O' THEN 'legacy' ELSE 'other' END AS layout, CASE WHEN st = 'P' THEN '' ELSE sym || day END AS part, length FROM ls)
  SELECT layout, count(DISTINCT part) AS partitions, CAST(sum(length) AS BIGINT) AS bytes FROM a GROUP BY 1""")
def _(s, d):
    return storage.audit(_listing(s, d))


@_query("dataset_bytes", f"WITH {_LISTED} SELECT 'trades' AS directory, day, CAST(sum(length) AS BIGINT) AS bytes FROM ls WHERE st = 'F' GROUP BY 2")
def _(s, d):
    return storage.dataset_bytes(_listing(s, d))


@_query("backup_scope", "SELECT count(*) AS files, CAST(sum(o_custkey) AS BIGINT) AS bytes FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority >= '3'")
def _(s, d):
    return storage.backup_scope(_listing(s, d))


@_query("legacy_paths", f"""WITH {_LISTED} SELECT p AS path FROM (SELECT CASE WHEN st = 'O' THEN '/d/trades/SYM0' || (o_custkey % 5) || '/' || day || '/' || o_orderkey || '.parquet'
  ELSE '/d/logs/' || o_orderkey || CASE WHEN (SELECT o_orderpriority FROM orders o WHERE o.o_orderkey = ls.o_orderkey) < '3' THEN '.tmp' ELSE '.log' END END AS p FROM ls WHERE st <> 'F') ORDER BY 1 LIMIT 50""")
def _(s, d):
    return monitoring.legacy_paths(_listing(s, d))


@_query("duplicate_partitions", f"WITH {_LISTED} SELECT DISTINCT 'trades' AS directory, 'SYM0' || (o_custkey % 5) AS symbol, day FROM ls WHERE st = 'O' AND sym || day IN (SELECT sym || day FROM ls WHERE st = 'F')")
def _(s, d):
    return layout.duplicate_partitions(_listing(s, d))


@_query("metadata_due", """SELECT epoch_us(ts)//1000 AS timestamp FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE value > 250)""")
def _(s, d):
    e = _t(s, d, "events").select(_ms("ts").alias("timestamp"), "value")
    stored = e.where("value > 250").select(quality.utc_day(F.col("timestamp")).alias("date"))
    return streams.metadata_due(stored, e.select("timestamp"))


@_query("day_peak", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, max(user_id) AS peak FROM events GROUP BY 1")
def _(s, d):
    samples = _t(s, d, "events").select(_ms("ts").alias("timestamp"), F.col("event_type").alias("queue"), F.col("user_id").alias("size"))
    return monitoring.peak_of_peaks(monitoring.queue_peaks(samples))


@_query("error_messages", "SELECT p_partkey, substring(repeat(p_name, 60), 1, 500) AS message FROM part")
def _(s, d):
    return _t(s, d, "part").select("p_partkey", monitoring.truncated(F.repeat("p_name", 60)).alias("message"))


_SNAPSHOT = {  # field: (of an order, in SQL)
    "liquidations_received": ("o_custkey % 11", "o_custkey % 11"), "depth_snapshots_received": ("o_orderkey % 1000", "o_orderkey % 1000"), "mark_price_updates_received": ("o_custkey % 13", "o_custkey % 13"),
    "top_of_book_updates_received": ("o_custkey % 17", "o_custkey % 17"), "websocket_reconnects": ("o_custkey % 3", "o_custkey % 3"), "integrity_error_count": ("o_orderkey % 4", "o_orderkey % 4"),
}
#: Days after the order at which a feed was last seen; filled orders have seen no funding, pending ones no metadata.
_SEEN = {"last_trade_update": (0, ""), "last_depth50_update": (1, ""), "last_funding_update": (2, "F"), "last_oi_update": (3, ""), "last_metadata_update": (4, "P")}
_SEEN_SQL = ", ".join(f"CASE WHEN o_orderstatus <> '{no}' THEN strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL {n} DAY, '%Y-%m-%dT%H:%M:%SZ') END AS {c}" for c, (n, no) in _SEEN.items())


@_query("status_snapshot", f"""SELECT o_orderkey AS instance, round(o_custkey * 60000 / 3600000.0::DOUBLE, 2) AS uptime_hours, o_custkey % 9 AS symbols, o_orderkey AS trades_received,
  {', '.join(f'{q} AS {c}' for c, (_, q) in _SNAPSHOT.items())}, {_SEEN_SQL} FROM orders""")
def _(s, d):
    o = _t(s, d, "orders")
    seen = [F.when(F.col("o_orderstatus") != no, _ms("o_orderdate") + n * 86_400_000).alias(c) for c, (n, no) in _SEEN.items()]
    counts = [F.expr(e).alias(c) for c, (e, _) in _SNAPSHOT.items()]
    states = o.select(F.col("o_orderkey").alias("instance"), (F.col("o_custkey") * 60_000).alias("uptime_ms"), (F.col("o_custkey") % 9).alias("symbols"), F.col("o_orderkey").alias("trades_received"), *counts, *seen)
    return monitoring.status_snapshot(states)


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
