import datetime as dt

from helpers import dims, tick, ticks_df, trade, trades_df
from pyspark.sql import functions as F

from marketpulse.functions.timefmt import parse_event_time
from marketpulse.operators import silver
from marketpulse.operators.dedup import dedup_first


def test_event_time_is_literal_wall_clock(spark):
    df = spark.createDataFrame([("2026-04-26T14:56:42.345Z",), ("garbage",), (None,)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.e for r in df.select(parse_event_time("t").alias("e")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2026, 4, 26, 14, 56, 42, 345000), None, None]


def test_bad_first_copy_hides_good_later_copy(spark):
    rows = [trade("T-1", price=-1.0), trade("T-1", price=5.0), trade("T-2")]
    df = trades_df(spark, rows).withColumn("_arrival", F.when(F.col("price") < 0, 0).otherwise(1))
    assert sorted(r.trade_id for r in silver.clean_trades(df).collect()) == ["T-2"]


def test_dedup_first_follows_order_and_folds_nulls(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 1, "p"), (None, 0, "q"), ("b", 9, "z")],
                               "k string, o int, v string")
    got = {r.k: r.v for r in dedup_first(df, ["k"], ["o"]).collect()}
    assert got == {"a": "y", None: "q", "b": "z"}


def test_dedup_hot_key_spread_over_tasks(spark):
    # one key holds most rows, spread over many input partitions
    hot = spark.range(0, 20000, numPartitions=16).select(
        F.lit("HOT").alias("k"), (F.col("id") * 7 % 20000).alias("o"), F.col("id").alias("v"))
    cold = spark.range(0, 100).select(F.concat(F.lit("c"), F.col("id")).alias("k"),
                                      F.col("id").alias("o"), F.col("id").alias("v"))
    out = dedup_first(hot.unionByName(cold), ["k"], ["o"])
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == 101 and got["HOT"] == 0


def test_enrichment_left_joins_and_derived_columns(spark):
    inst, trd, cps = dims(spark)
    rows = [trade("T-1", quantity=3, price=10.05), trade("T-2", ticker="ZZZ", trader_id="TR-9"),
            trade("T-3", trader_id=None, desk=None)]
    out = silver.enriched_trades(trades_df(spark, rows), inst, trd, cps)
    got = {r.trade_id: r for r in out.collect()}
    assert len(got) == 3
    assert got["T-1"].notional_usd == 30.15 and got["T-1"].company_name == "Alpha Inc"
    assert got["T-1"].trade_date == dt.date(2026, 4, 26) and got["T-1"].trade_hour == 14
    assert got["T-2"].company_name is None and got["T-2"].trader_name is None
    assert got["T-3"].risk_limit_usd is None and got["T-3"].counterparty_name == "Cit"


def test_mid_price_half_cent_rounds_up_and_spread(spark):
    df = ticks_df(spark, [tick("M1", bid=1.01, ask=1.02, spread=0.01), tick("M2", bid=10.0, ask=10.2)])
    got = {r.tick_id: r for r in silver.enrich_ticks(df).collect()}
    assert got["M1"].mid_price == 1.02
    assert got["M2"].mid_price == 10.1 and got["M2"].spread_bps == 198.02


def test_latest_price_tie_goes_to_greater_tick_id(spark):
    t = "2026-04-26T14:56:42.898Z"
    df = ticks_df(spark, [tick("MK-1", last=1.0, ts=t), tick("MK-2", last=2.0, ts=t),
                          tick("MK-0", last=0.5, ts="2026-04-26T14:56:41.000Z"),
                          tick("MK-9", ticker="BBB", last=7.0, ts=None)])
    got = {r.ticker: r.last_price for r in silver.latest_prices(silver.enrich_ticks(df)).collect()}
    assert got == {"AAA": 2.0, "BBB": 7.0}


def test_positions_sides(spark):
    inst, trd, cps = dims(spark)
    rows = [trade("T-1", side="BUY", quantity=10, price=2.0), trade("T-2", side="SELL", quantity=10, price=3.0),
            trade("T-3", ticker="BBB", side=None, quantity=5, price=1.0)]
    enr = silver.enriched_trades(trades_df(spark, rows), inst, trd, cps)
    got = {r.ticker: r for r in silver.positions(enr).collect()}
    assert got["AAA"].net_quantity == 0 and got["AAA"].position_side == "FLAT"
    assert got["AAA"].net_notional_usd == -10.0 and got["AAA"].gross_notional_usd == 50.0
    assert got["AAA"].avg_price == 2.5
    # a missing side counts as a sell in positions
    assert got["BBB"].net_quantity == -5 and got["BBB"].position_side == "SHORT"


def test_amounts_no_decimal_holds_keep_their_row(spark):
    """A huge or NaN price stops nothing: the row stays, its amount is a double."""
    import math
    from marketpulse.functions.money import exact_avg, money_sum
    from marketpulse.operators.silver import derive_ticks, enrich_trades
    from pyspark.sql import functions as F
    rows = [trade("T-1", price=1e15, quantity=10), trade("T-2", price=1e300), trade("T-3", price=float("nan")),
            trade("T-4", price=2.5, quantity=2)]
    raw = trades_df(spark, rows)
    out = enrich_trades(silver.clean_trades(raw), *dims(spark))
    got = {r.trade_id: r.notional_usd for r in out.collect()}
    assert got["T-1"] == 1e16 and got["T-2"] == 1e302 and math.isnan(got["T-3"]) and got["T-4"] == 5.0
    r = out.agg(money_sum("notional_usd").alias("s"), exact_avg("price", "decimal(28,6)").alias("a")).first()
    assert r.s == 1e16 + 5 and r.a == (1e15 + 2.5) / 2   # what no decimal holds is left out of both parts of a mean
    pos = {p.ticker: p for p in silver.positions(out).collect()}
    assert pos["AAA"].trade_count == 4
    mid = derive_ticks(ticks_df(spark, [tick("M1", bid=1e300, ask=1e300)])).first().mid_price
    assert mid == 1e300
