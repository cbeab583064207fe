"""The stored datasets: schema, first-wins key, event-time column, partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    directory: str
    schema: T.StructType
    key: tuple[str, ...]
    time: str = "timestamp"
    by_symbol: bool = True
    writable: bool = True


_TYPES = {"long": T.LongType, "double": T.DoubleType, "string": T.StringType, "boolean": T.BooleanType, "byte": T.ByteType}


def _schema(ddl: str, nullable: tuple[str, ...] = ()) -> T.StructType:
    fields = [f.split() for f in ddl.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind](), name in nullable) for name, kind in fields])


def depth_schema(levels: int) -> T.StructType:
    wide = [f"{side}_{what}_{i}" for side in ("bid", "ask") for i in range(1, levels + 1) for what in ("price", "qty")]
    tail = ["first_update_id", "final_update_id", "prev_final_update_id", "transaction_time"]
    ddl = ", ".join(["timestamp long", "symbol string", *(f"{c} double" for c in wide), *(f"{c} long" for c in tail), "received_at long"])
    return _schema(ddl, (*wide, *tail))


_PRE_POST = ", ".join(f"is_pre_funding_{m}m boolean" for m in (60, 30, 15, 5)) + ", " + ", ".join(f"is_post_funding_{m}m boolean" for m in (5, 15, 30, 60))

SPECS: dict[str, DatasetSpec] = {
    s.name: s
    for s in (
        DatasetSpec("trades", "trades", _schema("timestamp long, symbol string, price double, quantity double, is_buyer_maker boolean, trade_id long, is_recovered boolean, received_at long"), ("symbol", "trade_id")),
        DatasetSpec("liquidations", "liquidations", _schema("timestamp long, symbol string, side string, price double, quantity double, notional double, order_timestamp long, received_at long", ("order_timestamp",)), ("symbol", "timestamp", "order_timestamp", "side", "price", "quantity")),
        DatasetSpec("funding", "funding", _schema("timestamp long, symbol string, funding_rate double, next_funding_time long, mark_price double, received_at long"), ("symbol", "timestamp")),
        DatasetSpec("open_interest", "oi", _schema("timestamp long, symbol string, open_interest double, received_at long"), ("symbol", "timestamp")),
        DatasetSpec("depth20", "depth", depth_schema(20), ("symbol", "update"), writable=False),
        DatasetSpec("depth50", "depth50", depth_schema(50), ("symbol", "update")),
        DatasetSpec("mark_price", "mark_price", _schema("event_time long, symbol string, received_at long, mark_price double, index_price double, estimated_settle_price double, predicted_funding_rate double, next_funding_time long", ("estimated_settle_price",)), ("symbol", "event_time"), "event_time"),
        DatasetSpec("top_of_book", "top_of_book", _schema("event_time long, symbol string, received_at long, best_bid_price double, best_bid_qty double, best_ask_price double, best_ask_qty double, spread double, spread_bps double, mid_price double"), ("symbol", "event_time"), "event_time"),
        DatasetSpec("ohlcv_1m", "ohlcv_1m", _schema("symbol string, minute_start long, open double, high double, low double, close double, volume double, trade_count long"), ("symbol", "minute_start"), "minute_start"),
        DatasetSpec("metadata", "metadata", _schema("symbol string, timestamp long, tick_size double, step_size double, min_qty double, min_notional double, maker_fee double, taker_fee double", ("maker_fee", "taker_fee")), ("symbol", "timestamp"), by_symbol=False),
        DatasetSpec("oi_change", "oi_change", _schema("timestamp long, symbol string, oi double, oi_delta double, oi_delta_pct double, rolling_5m_delta double, rolling_15m_delta double, rolling_60m_delta double"), ("symbol", "timestamp")),
        DatasetSpec("taker_delta_1m", "taker_delta_1m", _schema("symbol string, minute long, buy_volume double, sell_volume double, delta_volume double, delta_ratio double, trade_count long"), ("symbol", "minute"), "minute"),
        DatasetSpec("book_imbalance", "book_imbalance", _schema("timestamp long, symbol string, imbalance_5 double, imbalance_10 double, imbalance_20 double, imbalance_50 double, bid_notional double, ask_notional double"), ("symbol", "timestamp")),
        DatasetSpec("spread_state", "spread_state", _schema("timestamp long, symbol string, spread_bps double, spread_zscore double, is_wide_spread boolean, rolling_spread_mean double, rolling_spread_std double"), ("symbol", "timestamp")),
        DatasetSpec("liquidity_stress", "liquidity_stress", _schema("timestamp long, symbol string, bid_depth_notional double, ask_depth_notional double, depth_imbalance double, depth_change_1m double, is_stress_event boolean"), ("symbol", "timestamp")),
        DatasetSpec("funding_event", "funding_event", _schema(f"timestamp long, symbol string, predicted_funding_rate double, next_funding_time long, minutes_to_funding double, minutes_since_previous_funding double, funding_window string, {_PRE_POST}, funding_direction byte"), ("symbol", "timestamp")),
    )
}


def conform(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Columns of the schema, in order and cast; missing ones are null, others go."""
    return df.select([(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema])


def complete(df: DataFrame, spec: DatasetSpec):
    """(rows with every required value, the other rows): incomplete rows are rejected one by one."""
    ok = F.lit(True)
    for f in spec.schema:
        if not f.nullable:
            ok = ok & F.col(f.name).isNotNull()
    return df.where(ok), df.where(~ok)
