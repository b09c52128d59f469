from helpers import trade, trades_df, tick, ticks_df

from marketpulse.operators import silver
from marketpulse.operators.quality import (TICK_RULES, TRADE_RULES, Rule, apply_rules,
                                           rule_report)


def _report(df, rules, name):
    return {r["rule"]: (r["action"], r["passed_records"], r["failed_records"])
            for r in rule_report(df, rules, name).collect()}


def test_null_fails_a_rule(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "price int")
    kept = apply_rules(df, [Rule("valid_price", "price > 0", "drop")])
    assert [r.price for r in kept.collect()] == [1]


def test_warn_rules_never_filter(spark):
    df = spark.createDataFrame([("X",), (None,)], "side string")
    assert apply_rules(df, [Rule("valid_side", "side IN ('BUY','SELL')", "warn")]).count() == 2


def test_sample_shape_batch(spark):
    """Same mix as the feed's sample: the five bad kinds among clean rows."""
    rows = [trade(f"T-{i}") for i in range(10)]
    rows += [trade("T-neg", price=-464.92, flag="negative_price"),
             trade("T-zero", quantity=0, flag="zero_qty"),
             trade("T-null", ticker=None, flag="null_ticker"),
             trade("T-mt", trader_id=None, desk=None, flag="missing_trader"),
             trade("T-fut", ts="2030-12-31T23:59:59.999Z", flag="future_timestamp"),
             trade("T-side", side=None),
             trade("T-bad-ts", ts="not a time")]
    df = trades_df(spark, rows)
    deduped = silver.dedup_trades(df)
    rep = _report(deduped, TRADE_RULES, "enriched_trades")
    n = len(rows)
    assert rep["valid_price"] == ("drop", n - 1, 1)
    assert rep["valid_quantity"] == ("drop", n - 1, 1)
    assert rep["valid_ticker"] == ("drop", n - 1, 1)
    assert rep["valid_trader"] == ("warn", n - 1, 1)
    assert rep["valid_timestamp"] == ("warn", n - 2, 2)   # future + unparseable
    assert rep["valid_side"] == ("warn", n - 1, 1)
    kept = {r.trade_id for r in silver.clean_trades(df).collect()}
    assert kept == {f"T-{i}" for i in range(10)} | {"T-mt", "T-fut", "T-side", "T-bad-ts"}


def test_counts_kept_plus_dropped_is_input(spark):
    rows = [trade(f"T-{i}", price=(i - 3) * 1.0, quantity=i % 4) for i in range(40)]
    df = silver.dedup_trades(trades_df(spark, rows))
    kept = apply_rules(df, TRADE_RULES).count()
    dropped = df.count() - kept
    fails = df.filter("NOT (coalesce(price > 0, false) AND coalesce(quantity > 0, false))").count()
    assert dropped == fails and kept + dropped == 40


def test_tick_rules_and_bid_equal_minus_ask(spark):
    df = ticks_df(spark, [tick("M1"), tick("M2", bid=-10.0, ask=10.0), tick("M3", bid=10.5, ask=10.2),
                          tick(None), tick("M5", bid=None)])
    out = silver.enrich_ticks(df)
    assert sorted(r.tick_id for r in out.collect()) == ["M1", "M3"]
    rep = _report(silver.derive_ticks(df), TICK_RULES, "t")
    assert rep["bid_less_than_ask"] == ("warn", 3, 2)   # M3 and the NULL bid fail
    assert rep["valid_bid"][2] == 2


def test_duplicate_dimension_keys_are_reported(spark):
    import pytest
    from marketpulse.operators.quality import assert_unique, duplicate_keys
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "k string, v int")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [("A", 2)]
    with pytest.raises(ValueError):
        assert_unique(df, ["k"], "dim")
    assert_unique(df, ["k", "v"], "dim")


def test_sample_shape_json_lines(spark, tmp_dir):
    """A JSON-lines batch with the feed sample's mix: 50 records, 6 flagged
    (negative price, 2 zero quantities, null ticker, missing trader, future
    time). Dropping leaves 46; the warnings fire on the last two."""
    import json
    from marketpulse.sources.files import read_trades
    bad = {0: dict(price=-464.92, _dq_flag="negative_price"), 15: dict(quantity=0, _dq_flag="zero_qty"),
           38: dict(quantity=0, _dq_flag="zero_qty"), 23: dict(ticker=None, _dq_flag="null_ticker"),
           39: dict(trader_id=None, desk=None, _dq_flag="missing_trader"),
           43: dict(timestamp="2030-12-31T23:59:59.999Z", _dq_flag="future_timestamp")}
    with open(f"{tmp_dir}/trades.json", "w") as f:
        for i in range(50):
            rec = dict(trade_id=f"T-{i:04d}", ticker="AAA", side="BUY" if i % 2 else "SELL", quantity=100,
                       price=10.5, order_type="LIMIT", trader_id="TR-1", desk="EQ", counterparty_id="CP-1",
                       exchange="NYSE", currency="USD", asset_class="EQUITY",
                       timestamp="2026-04-26T14:56:42.345Z")
            rec.update(bad.get(i, {}))
            f.write(json.dumps(rec) + "\n")
    raw = read_trades(spark, f"{tmp_dir}/trades.json")
    rep = _report(silver.dedup_trades(raw), TRADE_RULES, "enriched_trades")
    assert silver.clean_trades(raw).count() == 46
    assert {k: v[2] for k, v in rep.items() if v[2]} == {
        "valid_price": 1, "valid_quantity": 2, "valid_ticker": 1, "valid_trader": 1, "valid_timestamp": 1}
