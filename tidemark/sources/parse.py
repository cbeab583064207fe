"""Parsers from JSON payloads to typed rows.

A payload without a required value gives no row. With ``rejects=True`` a parser
returns every payload once: ``reject`` is null for a row, else the reason, and
``payload`` the text; :func:`split` parts the two, :func:`count_reasons` counts them
while they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_LEVELS = "array<array<string>>"


def _num(c) -> Column:
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


def _int(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def _payload(df: DataFrame, names: str, keep: tuple[str, ...], payload: str | Column, outer: bool = True) -> DataFrame:
    """The named fields as strings, beside the payload (``_raw``). Names differ by case (s and S), so the object is read as a map."""
    text = F.col(payload) if isinstance(payload, str) else payload
    # Not deterministic in form, so that no filter on the fields is moved below and reads the text again for each of them.
    fields = df.withColumn("_p", F.when(F.spark_partition_id() >= 0, F.from_json(text, "map<string,string>")))
    if outer:
        fields = fields.withColumn("_raw", text).withColumn("_is_object", F.col("_p").isNotNull())
    return fields.select(*[F.try_element_at("_p", F.lit(n)).alias(_alias(n)) for n in names.split()], *keep, "_raw", "_is_object")


def _checked(parsed: DataFrame, columns: dict[str, Column], required: dict[str, str], rejects: bool) -> DataFrame:
    """The columns of rows that have every required one (column -> name of its field in the payload), or of all rows with the reason."""
    raw = {n: F.col(_alias(n)) if _alias(n) in parsed.columns else F.lit(None) for n in required.values()}
    out = parsed.select(*[c.alias(n) for n, c in columns.items()], "_raw", "_is_object", *[c.isNull().alias(f"_no_{i}") for i, c in enumerate(raw.values())])
    gone = [F.col(f"_no_{list(raw).index(n)}") for n in required.values()]
    faults = [F.when(F.col(c).isNull(), F.when(no, f"missing {n}").otherwise(f"malformed {n}")) for (c, n), no in zip(required.items(), gone, strict=True)]
    reason = F.coalesce(F.when(~F.col("_is_object"), F.lit("no object")), *faults)
    if not rejects:
        return out.where(reason.isNull()).select(*columns)
    return out.select(*columns, reason.alias("reject"), F.col("_raw").alias("payload"))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a parser's output with ``rejects=True``; rejects are (payload, reject, received_at)."""
    return checked.where("reject IS NULL").drop("reject", "payload"), checked.where("reject IS NOT NULL").select("payload", "reject", "received_at")


def count_reasons(checked: DataFrame, seen: Observation, fields: Sequence[str]) -> DataFrame:
    """``checked``, observed: rows, rejects and the reasons of these, for the fields that may be missing or malformed."""
    of = lambda reason: F.count_if(F.coalesce(F.col("reject") == reason, F.lit(False))).alias(reason)
    kinds = ["no object", *[f"{fault} {f}" for f in fields for fault in ("missing", "malformed")]]
    return checked.observe(seen, F.count_if(F.col("reject").isNull()).alias("rows"), F.count_if(F.col("reject").isNotNull()).alias("rejects"), *map(of, kinds))


def _time(payload: str | Column, df: DataFrame) -> DataFrame:
    """Adds ``_arrived``: the arrival time where the payload has no ``time`` at all; a malformed or null one is no reason to fall back."""
    has = F.map_contains_key(F.from_json(payload, "map<string,string>"), "time")
    return df.withColumn("_arrived", F.when(~has, F.col("received_at")))


def _alias(name: str) -> str:
    """A column name that stays distinct where case does not count."""
    return f"up_{name}" if name.isupper() else name


def unwrap(df: DataFrame, raw: str = "value") -> DataFrame:
    """(stream, data): an envelope's parts, or the whole object where it has no ``data``; null ``stream`` where it has none.

    Messages that are no JSON object, and data that are none (a string with
    JSON in it is a string), go; types are those of the parsed value.
    """
    parsed = F.try_parse_json(raw)
    data = F.variant_get("_v", "$.data", "variant")
    has_data = F.map_contains_key(F.from_json(raw, "map<string,string>"), "data")
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    rows = df.withColumn("_v", parsed).where(is_object(F.col("_v")) & (~has_data | is_object(data)))
    return rows.withColumn("stream", F.get_json_object(raw, "$.stream")).withColumn("data", F.when(has_data, F.get_json_object(raw, "$.data")).otherwise(F.col(raw))).drop("_v")


def agg_trades(df: DataFrame, payload: str = "data", symbol: str | None = None, rejects: bool = False) -> DataFrame:
    """Trades of the stream, or (with ``symbol``) of a backfill page."""
    keep = ("received_at",) if symbol is None else ("received_at", symbol)
    p = _payload(df, "T s p q m a", keep, payload)
    name = F.col("s") if symbol is None else F.col(symbol)
    columns = {"timestamp": _int("up_T"), "symbol": F.upper(name), "price": _num("p"), "quantity": _num("q"), "is_buyer_maker": F.col("m").try_cast("boolean"), "trade_id": _int("a"), "is_recovered": F.lit(symbol is not None), "received_at": F.col("received_at")}
    return _checked(p, columns, {"timestamp": "T", "symbol": "s" if symbol is None else symbol, "price": "p", "quantity": "q", "is_buyer_maker": "m", "trade_id": "a", "received_at": "received_at"}, rejects)


def first_positive(*values: Column) -> Column:
    """The first value above zero, else the last; null and empty are zero."""
    clean = [F.coalesce(F.nullif(v, F.lit("")).try_cast("double"), F.lit(0.0)) for v in values]
    return F.when(clean[0] > 0, clean[0]).otherwise(clean[1])


def liquidations(df: DataFrame, payload: str = "data", rejects: bool = False) -> DataFrame:
    outer = _payload(df, "E o", ("received_at",), payload)
    p = _payload(outer, "s S p ap q z T", ("up_E", "received_at"), "o", outer=False)
    price, qty = first_positive(F.col("ap"), F.col("p")), first_positive(F.col("z"), F.col("q"))
    columns = {"timestamp": _int("up_E"), "symbol": F.upper("s"), "side": F.col("up_S"), "price": price, "quantity": qty, "notional": price * qty, "order_timestamp": _int("up_T"), "received_at": F.col("received_at")}
    return _checked(p, columns, {"timestamp": "E", "symbol": "s", "side": "S"}, rejects)


def mark_prices(df: DataFrame, payload: str = "data", rejects: bool = False) -> DataFrame:
    p = _payload(df, "E s p i r T P", ("received_at",), payload)
    columns = {"event_time": _int("up_E"), "symbol": F.upper("s"), "received_at": F.col("received_at"), "mark_price": _num("p"), "index_price": _num("i"), "estimated_settle_price": _num("up_P"), "predicted_funding_rate": _num("r"), "next_funding_time": _int("up_T")}
    return _checked(p, columns, {"event_time": "E", "symbol": "s", "received_at": "received_at", "mark_price": "p", "index_price": "i", "predicted_funding_rate": "r", "next_funding_time": "T"}, rejects)


def funding(df: DataFrame, payload: str = "data", rejects: bool = False) -> DataFrame:
    p = _payload(_time(payload, df), "symbol markPrice lastFundingRate nextFundingTime time", ("received_at", "_arrived"), payload)
    columns = {"timestamp": F.coalesce(_int("time"), F.col("_arrived")), "symbol": F.upper("symbol"), "funding_rate": _num("lastFundingRate"), "next_funding_time": _int("nextFundingTime"), "mark_price": _num("markPrice"), "received_at": F.col("received_at")}
    return _checked(p, columns, {"timestamp": "time", "symbol": "symbol", "funding_rate": "lastFundingRate", "next_funding_time": "nextFundingTime", "mark_price": "markPrice", "received_at": "received_at"}, rejects)


def open_interest(df: DataFrame, payload: str = "data", rejects: bool = False) -> DataFrame:
    p = _payload(_time(payload, df), "symbol openInterest time", ("received_at", "_arrived"), payload)
    columns = {"timestamp": F.coalesce(_int("time"), F.col("_arrived")), "symbol": F.upper("symbol"), "open_interest": _num("openInterest"), "received_at": F.col("received_at")}
    return _checked(p, columns, {"timestamp": "time", "symbol": "symbol", "open_interest": "openInterest", "received_at": "received_at"}, rejects)


def _side(*names: str, levels: int) -> Column:
    """The first levels of a side; null if one of them is no pair of numbers, as such a book is dropped whole."""
    level = lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("qty"))
    found = F.transform(F.slice(F.coalesce(*[F.from_json(n, _LEVELS) for n in names]), 1, levels), level)
    return F.when(F.forall(found, lambda x: x["price"].isNotNull() & x["qty"].isNotNull()), found)


def depth(df: DataFrame, payload: str = "data", levels: int = 20, rejects: bool = False) -> DataFrame:
    """Books as two arrays; ids that are missing are null."""
    p = _payload(df, "E T s U u pu lastUpdateId b a bids asks", ("received_at",), payload)
    p = p.withColumns({"b": F.coalesce("b", "bids"), "a": F.coalesce("a", "asks")})
    columns = {
        "timestamp": _int("up_E"), "symbol": F.upper("s"), "bids": _side("b", levels=levels), "asks": _side("a", levels=levels),
        "first_update_id": _int("up_U"), "final_update_id": F.coalesce(_int("u"), _int("lastUpdateId")), "prev_final_update_id": _int("pu"), "transaction_time": _int("up_T"), "received_at": F.col("received_at"),
    }
    return _checked(p, columns, {"timestamp": "E", "symbol": "s", "bids": "b", "asks": "a"}, rejects)


def rest_depth(df: DataFrame, payload: str = "data", symbol: str = "symbol", levels: int = 50, rejects: bool = False) -> DataFrame:
    """A snapshot that carries no symbol or time of its own."""
    p = _payload(df, "lastUpdateId bids asks", ("received_at", symbol), payload)
    columns = {"timestamp": F.col("received_at"), "symbol": F.upper(symbol), "bids": _side("bids", levels=levels), "asks": _side("asks", levels=levels), "final_update_id": _int("lastUpdateId"), "received_at": F.col("received_at")}
    return _checked(p, columns, {"bids": "bids", "asks": "asks"}, rejects)


def filter_metadata(symbols: DataFrame) -> DataFrame:
    """Trading filters of rows (symbol, filters array<map<string,string>>); the last of two equal filters counts. Other columns stay."""
    pick = lambda kind: F.element_at(F.filter("filters", lambda f: F.try_element_at(f, F.lit("filterType")) == kind), -1)

    def value(kind: str, key: str) -> Column:
        found = F.filter("filters", lambda f: F.try_element_at(f, F.lit("filterType")) == kind)
        return F.when(F.size(found) > 0, F.try_element_at(pick(kind), F.lit(key)).try_cast("double"))

    zero = F.lit(0.0)
    nz = lambda c: F.nullif(c, zero)
    notional = lambda kind: F.coalesce(nz(value(kind, "notional")), nz(value(kind, "minNotional")))
    has = F.exists("filters", lambda f: F.try_element_at(f, F.lit("filterType")) == "MIN_NOTIONAL")
    rest = [c for c in symbols.columns if c not in ("symbol", "filters")]
    return symbols.select(
        "symbol", *rest, F.coalesce(value("PRICE_FILTER", "tickSize"), zero).alias("tick_size"), F.coalesce(value("LOT_SIZE", "stepSize"), zero).alias("step_size"), F.coalesce(value("LOT_SIZE", "minQty"), zero).alias("min_qty"),
        F.coalesce(F.when(has, notional("MIN_NOTIONAL")).otherwise(notional("NOTIONAL")), zero).alias("min_notional"), F.lit(None).cast("double").alias("maker_fee"), F.lit(None).cast("double").alias("taker_fee"),
    )


def exchange_metadata(df: DataFrame, configured: DataFrame, payload: str = "data") -> DataFrame:
    """Metadata of the configured symbols, one row for each poll; unknown symbols are passed over.

    ``configured`` is (symbol) or (symbol, pos); a position comes along, so the configured order can be asked for.
    """
    p = df.select(F.explode(F.from_json(payload, "struct<symbols:array<struct<symbol:string,filters:array<map<string,string>>>>>")["symbols"]).alias("s"), F.col("received_at").alias("timestamp"))
    rows = p.select(F.upper("s.symbol").alias("symbol"), F.col("s.filters").alias("filters"), "timestamp")
    known = configured.dropDuplicates(["symbol"])
    return filter_metadata(rows.join(known, "symbol"))


def active_perpetuals(df: DataFrame, payload: str = "data") -> DataFrame:
    p = df.select(F.explode(F.from_json(payload, "struct<symbols:array<struct<symbol:string,contractType:string,quoteAsset:string,status:string>>>")["symbols"]).alias("s")).select("s.*")
    return p.where("contractType = 'PERPETUAL' AND quoteAsset = 'USDT' AND status = 'TRADING'").select(F.upper("symbol").alias("symbol"))
