"""Hand-written frames in the raw shapes."""

from __future__ import annotations

from decimal import Decimal

from marketpulse.schemas import TICK_RAW, TRADE_RAW

TRADE_COLS = [f.name for f in TRADE_RAW.fields]


def trade(trade_id, ticker="AAA", side="BUY", quantity=100, price=10.0, trader_id="TR-1",
          desk="EQ", counterparty_id="CP-1", ts="2026-04-26T14:56:42.345Z", flag=None,
          order_type="LIMIT"):
    return (trade_id, ticker, side, quantity, price, order_type, trader_id, desk, counterparty_id,
            "NYSE", "USD", "EQUITY", ts, flag)


def trades_df(spark, rows):
    return spark.createDataFrame(rows, TRADE_RAW)


def tick(tick_id, ticker="AAA", bid=10.0, ask=10.2, last=10.1, spread=0.2,
         ts="2026-04-26T14:56:42.898Z"):
    return (tick_id, ticker, bid, ask, last, spread, 100, 1000, 12.0, 8.0, "NYSE", "EQUITY", ts)


def ticks_df(spark, rows):
    return spark.createDataFrame(rows, TICK_RAW)


def dims(spark, traders=None, instruments=None, counterparties=None):
    inst = spark.createDataFrame(
        instruments or [("AAA", "Alpha Inc", "Technology"), ("BBB", "Beta Corp", "Energy")],
        "ticker string, company_name string, sector string")
    trd = spark.createDataFrame(
        traders or [("TR-1", "Ann", "Equities Trading", Decimal("5000.00"), "New York"),
                    ("TR-2", "Bob", "Fixed Income", Decimal("1000000.00"), "London")],
        "trader_id string, trader_name string, desk_full_name string, "
        "risk_limit_usd decimal(15,2), location string")
    cps = spark.createDataFrame(
        counterparties or [("CP-1", "Cit", "LOW", "MARKET_MAKER", "US")],
        "counterparty_id string, counterparty_name string, risk_rating string, "
        "counterparty_type string, country string")
    return inst, trd, cps
