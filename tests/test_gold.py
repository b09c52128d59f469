from helpers import dims, tick, ticks_df, trade, trades_df

from marketpulse.operators import gold, silver


def _enriched(spark, rows, **kw):
    inst, trd, cps = dims(spark, **kw)
    return silver.enriched_trades(trades_df(spark, rows), inst, trd, cps)


def test_price_deviation_is_compared_after_rounding(spark):
    # ticker mean 100.0; 102.004 deviates 2.004 % → 2.0 (not flagged); 102.006 → 2.01 (flagged)
    def block(t, p):
        return [trade(f"{t}-a", ticker=t, price=p, quantity=1, trader_id="TR-2"),
                trade(f"{t}-b", ticker=t, price=200.0 - p, quantity=1, trader_id="TR-2")]
    e = _enriched(spark, block("AAA", 102.004) + block("BBB", 102.006))
    got = {r.trade_id: r for r in gold.trade_anomalies(e).collect()}
    assert "AAA-a" not in got
    assert got["BBB-a"].price_deviation_pct == 2.01 and got["BBB-a"].is_price_anomaly


def test_single_trade_has_no_quantity_anomaly(spark):
    e = _enriched(spark, [trade("T-1", quantity=10_000_000, trader_id="TR-2", price=0.01)])
    st = gold.ticker_stats(e).collect()[0]
    assert st.stddev_qty is None
    assert gold.trade_anomalies(e).count() == 0


def test_quantity_spike_and_stddev(spark):
    rows = [trade(f"T-{i}", quantity=100, trader_id="TR-2") for i in range(30)]
    rows.append(trade("T-big", quantity=100_000, trader_id="TR-2"))
    e = _enriched(spark, rows)
    st = gold.ticker_stats(e).collect()[0]
    import statistics
    qs = [100] * 30 + [100_000]
    assert abs(st.stddev_qty - statistics.stdev(qs)) < 1e-6
    got = {r.trade_id: r.is_qty_anomaly for r in gold.trade_anomalies(e).collect()}
    assert got == {"T-big": True}


def test_unknown_trader_breach_is_null(spark):
    rows = [trade("T-1", trader_id="TR-unknown", quantity=10, price=10.0),
            trade("T-2", trader_id="TR-1", quantity=1000, price=10.0),   # 10,000 > 5,000 limit
            trade("T-3", trader_id="TR-1", quantity=100, price=10.0)]
    got = {r.trade_id: r for r in gold.trade_anomalies(_enriched(spark, rows)).collect()}
    assert set(got) == {"T-2"} and got["T-2"].is_risk_breach


def test_desk_ratios_and_exposure(spark):
    rows = [trade("T-1", side="BUY", quantity=1, price=10.0), trade("T-2", side="BUY", quantity=1, price=20.0),
            trade("T-3", side=None, quantity=1, price=5.0, desk="FI", trader_id="TR-2")]
    e = _enriched(spark, rows)
    desks = {r.desk: r for r in gold.desk_pnl(e).collect()}
    assert desks["EQ"].buy_sell_ratio == 2.0 and desks["EQ"].net_pnl_usd == -30.0
    # a missing side counts as a buy in cash flow but is in neither exposure leg
    assert desks["FI"].buy_count == 0 and desks["FI"].net_pnl_usd == -5.0
    sec = gold.risk_exposure_by_sector(e).collect()[0]
    assert sec.long_notional_usd == 35.0 - 5.0 and sec.short_notional_usd == 0.0
    assert sec.long_short_ratio is None and sec.trade_count == 3


def test_mark_to_market_without_price(spark):
    rows = [trade("T-1", side="BUY", quantity=10, price=10.0),
            trade("T-2", ticker="BBB", side="BUY", quantity=5, price=3.0),
            trade("T-3", ticker="BBB", side="SELL", quantity=5, price=3.0)]
    e = _enriched(spark, rows)
    prices = silver.latest_prices(silver.enrich_ticks(ticks_df(spark, [tick("M1", last=12.5)])))
    got = {r.ticker: r for r in gold.mark_to_market_pnl(silver.positions(e), prices).collect()}
    a, b = got["AAA"], got["BBB"]
    assert a.market_value_usd == 125.0 and a.unrealized_pnl_usd == 25.0 and a.pnl_pct == 25.0
    assert b.last_price is None and b.market_value_usd is None and b.pnl_pct == 0.0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_never_expand(spark):
    """Lookups read only the columns a query uses; distinct counts do not multiply rows."""
    from conftest import SF_SMALL
    from marketpulse.plans.queries import QUERIES
    for name in ("desk_pnl", "risk_exposure_by_sector", "counterparty_exposure"):
        assert "Expand" not in _plan(QUERIES[name](spark, SF_SMALL)), name
    trades = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").selectExpr(
        "cast(l_orderkey as string) trade_id", "cast(l_partkey as string) ticker", "l_returnflag unused", "l_linestatus side",
        "cast(l_quantity as int) quantity", "l_tax price", "l_shipdate event_time")
    inst = spark.createDataFrame([("1", "One", "Tech")], "ticker string, company_name string, sector string")
    out = silver.enrich_trades(trades, inst, None, None)
    scan = [x for x in _plan(out.groupBy("sector").sum("quantity")).splitlines() if "lineitem" in x]
    assert scan and all(c not in x for x in scan for c in ("l_returnflag", "l_linestatus", "l_tax", "l_shipdate"))
