"""Fixed schemas of the raw inputs and the column lists of the outputs.

Fixed values: field names, types and the order of the output columns follow
the feed and table definitions the pipeline must reproduce.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

# Raw trade executions, one JSON object per line. A file source reads every
# column as nullable; the not-null quality rule enforces trade_id.
TRADE_RAW = StructType([
    StructField("trade_id", StringType(), True),
    StructField("ticker", StringType(), True),
    StructField("side", StringType(), True),
    StructField("quantity", IntegerType(), True),
    StructField("price", DoubleType(), True),
    StructField("order_type", StringType(), True),
    StructField("trader_id", StringType(), True),
    StructField("desk", StringType(), True),
    StructField("counterparty_id", StringType(), True),
    StructField("exchange", StringType(), True),
    StructField("currency", StringType(), True),
    StructField("asset_class", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("_dq_flag", StringType(), True),
])

# Raw market ticks. cumulative_volume only grows: kept as bigint.
TICK_RAW = StructType([
    StructField("tick_id", StringType(), True),
    StructField("ticker", StringType(), True),
    StructField("bid", DoubleType(), True),
    StructField("ask", DoubleType(), True),
    StructField("last_price", DoubleType(), True),
    StructField("spread", DoubleType(), True),
    StructField("tick_volume", IntegerType(), True),
    StructField("cumulative_volume", LongType(), True),
    StructField("high_52w", DoubleType(), True),
    StructField("low_52w", DoubleType(), True),
    StructField("exchange", StringType(), True),
    StructField("asset_class", StringType(), True),
    StructField("timestamp", StringType(), True),
])

_AUDIT = [
    StructField("is_active", BooleanType(), True),
    StructField("created_at", TimestampType(), True),
    StructField("updated_at", TimestampType(), True),
]

INSTRUMENT = StructType([
    StructField("ticker", StringType(), True),
    StructField("company_name", StringType(), True),
    StructField("sector", StringType(), True),
    StructField("asset_class", StringType(), True),
    StructField("currency", StringType(), True),
    StructField("exchange", StringType(), True),
    StructField("base_price", DecimalType(12, 2), True),
])

TRADER = StructType([
    StructField("trader_id", StringType(), True),
    StructField("trader_name", StringType(), True),
    StructField("desk", StringType(), True),
    StructField("desk_full_name", StringType(), True),
    StructField("risk_limit_usd", DecimalType(15, 2), True),
    StructField("manager", StringType(), True),
    StructField("location", StringType(), True),
])

COUNTERPARTY = StructType([
    StructField("counterparty_id", StringType(), True),
    StructField("counterparty_name", StringType(), True),
    StructField("lei_code", StringType(), True),
    StructField("risk_rating", StringType(), True),
    StructField("counterparty_type", StringType(), True),
    StructField("country", StringType(), True),
    StructField("city", StringType(), True),
])

# The seed CSV files carry the business columns only; the database adds the
# audit columns.
REFERENCE_CSV = {"instruments": INSTRUMENT, "traders": TRADER,
                 "counterparties": COUNTERPARTY}
REFERENCE_DB = {k: StructType(list(v.fields) + _AUDIT) for k, v in REFERENCE_CSV.items()}

HISTORICAL_TRADE = StructType([
    StructField("trade_id", StringType(), True),
    StructField("ticker", StringType(), True),
    StructField("side", StringType(), True),
    StructField("quantity", IntegerType(), True),
    StructField("price", DecimalType(12, 2), True),
    StructField("order_type", StringType(), True),
    StructField("trader_id", StringType(), True),
    StructField("desk", StringType(), True),
    StructField("counterparty_id", StringType(), True),
    StructField("exchange", StringType(), True),
    StructField("currency", StringType(), True),
    StructField("asset_class", StringType(), True),
    StructField("trade_status", StringType(), True),
    StructField("trade_date", DateType(), True),
    StructField("settlement_date", DateType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("created_at", TimestampType(), True),
])

# Output column lists (processing-time stamps last).
ENRICHED_TRADE_EXTRA = [
    "event_time", "company_name", "sector", "trader_name", "desk_full_name",
    "risk_limit_usd", "location", "counterparty_name", "risk_rating",
    "counterparty_type", "cp_country", "notional_usd", "trade_date", "trade_hour",
]
ENRICHED_TICK_EXTRA = ["event_time", "mid_price", "spread_bps"]
LATEST_PRICE_COLUMNS = [
    "ticker", "bid", "ask", "last_price", "mid_price", "spread", "spread_bps",
    "tick_volume", "cumulative_volume", "event_time",
]
ANOMALY_COLUMNS = [
    "trade_id", "ticker", "company_name", "side", "quantity", "price",
    "notional_usd", "trader_id", "trader_name", "desk", "desk_full_name",
    "sector", "counterparty_id", "counterparty_name", "risk_rating",
    "cp_country", "is_qty_anomaly", "is_price_anomaly", "is_risk_breach",
    "price_deviation_pct", "avg_qty", "avg_price", "risk_limit_usd",
    "event_time", "trade_date",
]
MTM_COLUMNS = [
    "ticker", "desk", "sector", "asset_class", "position_side", "net_quantity",
    "avg_price", "last_price", "mid_price", "bid", "ask", "spread_bps",
    "net_notional_usd", "market_value_usd", "unrealized_pnl_usd", "pnl_pct",
    "gross_notional_usd", "trade_count", "last_trade_time", "price_as_of",
]
