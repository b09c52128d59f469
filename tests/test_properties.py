"""Properties over the driver tables and replay safety."""

from decimal import Decimal

from conftest import SF_SMALL
from helpers import dims, trade, trades_df
from pyspark.sql import functions as F

from marketpulse.operators.quality import TRADE_RULES, apply_rules
from marketpulse.operators.scd2 import scd2_history
from marketpulse.plans.queries import Tables
from marketpulse.plans.tables import TableStore
from marketpulse.sources.changelog import read_change_log
from marketpulse.streaming.pipelines import scd2_batch_fn
from marketpulse.streaming.sinks import batch_dir_writer, read_batch_dirs


def test_gross_bounds_net_and_desks_add_up(spark):
    t = Tables(spark, SF_SMALL)
    bad = t.positions.filter(F.col("gross_notional_usd") < F.abs("net_notional_usd") - 1e-6).count()
    assert bad == 0
    total = t.enriched.agg(F.sum(F.when(F.col("side") == "SELL", F.col("notional_usd"))
                                 .otherwise(-F.col("notional_usd")).cast("decimal(38,2)"))).first()[0]
    desks = t.desk_pnl.agg(F.sum(F.col("net_pnl_usd").cast("decimal(38,2)"))).first()[0]
    assert total == desks
    assert t.desk_pnl.agg(F.sum("trade_count")).first()[0] == t.enriched.count()


def test_kept_plus_dropped_is_input(spark):
    t = Tables(spark, SF_SMALL)
    n = t.deduped.count()
    kept = apply_rules(t.deduped, TRADE_RULES).count()
    report = {r["rule"]: r["failed_records"] for r in t_report(t)}
    assert kept < n and kept + (n - kept) == n
    # each drop rule's failures are no more than the rows dropped in total
    assert all(report[r] <= n - kept for r in ("valid_ticker", "valid_price", "valid_quantity"))


def t_report(t):
    from marketpulse.operators.quality import rule_report
    return rule_report(t.deduped, TRADE_RULES, "enriched_trades").collect()


def test_replayed_trade_batch_replaces_itself(spark, tmp_dir):
    inst, trd, cps = dims(spark)
    sink = f"{tmp_dir}/sink"
    write = batch_dir_writer(sink)
    batch = trades_df(spark, [trade("T-1"), trade("T-2")])
    write(batch, 0)
    write(batch, 0)          # replay after a crash before the checkpoint commit
    assert read_batch_dirs(spark, sink).count() == 2


def test_replayed_scd2_batch_adds_no_version(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/tables")
    log = f"{tmp_dir}/log"
    fn = scd2_batch_fn(spark, log, store, "h", ["k"], "seq")
    b0 = spark.createDataFrame([("A", "x", 1), ("B", "y", 1)], "k string, v string, seq int")
    b1 = spark.createDataFrame([("A", "z", 3), ("A", "w", 2)], "k string, v string, seq int")
    fn(b0, 0)
    fn(b1, 1)
    fn(b1, 1)                # replay
    got = sorted((r["k"], r["v"], r["__START_AT"], r["__END_AT"]) for r in store.read("h").collect())
    assert got == [("A", "w", 2, 3), ("A", "x", 1, 2), ("A", "z", 3, None), ("B", "y", 1, None)]
    batch = scd2_history(read_change_log(spark, log), ["k"], "seq")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, store.read("h").select(*batch.columns).collect()))


def test_decimal_money_is_exact(spark):
    from marketpulse.functions.money import money_sum, notional
    df = spark.createDataFrame([(0.1, 3), (0.2, 3), (1.005, 1)], "price double, quantity int")
    out = df.select(notional("price", "quantity").alias("n"))
    assert [r.n for r in out.collect()] == [0.3, 0.6, 1.01]
    assert out.agg(money_sum("n")).first()[0] == float(Decimal("1.91"))


def test_bucketed_scd2_batches_equal_batch_history(spark, tmp_dir):
    from marketpulse.plans.tables import BucketedVersions
    from marketpulse.streaming.pipelines import scd2_bucketed_batch_fn
    hist = BucketedVersions(spark, f"{tmp_dir}/hist", 4)
    fn = scd2_bucketed_batch_fn(spark, f"{tmp_dir}/log", hist, ["k"], "seq", track=["v"])
    rows = [(f"K{i % 7}", "abc"[i % 3] if i % 5 else "a", i) for i in range(60)]
    batches = [rows[:20], rows[40:], rows[20:40]]          # the last batch is late
    schema = "k string, v string, seq int"
    for i, b in enumerate(batches):
        fn(spark.createDataFrame(b, schema), i)
    fn(spark.createDataFrame(batches[2], schema), 2)        # replay of the last batch
    want = scd2_history(spark.createDataFrame(rows, schema), ["k"], "seq", track=["v"])
    got = hist.read()
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
    assert hist.vacuum()                                      # superseded versions go
    assert sorted(map(tuple, hist.read().select(*want.columns).collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
    # a batch touching one key writes only that key's bucket
    fn(spark.createDataFrame([("K1", "z", 100)], schema), 3)
    assert len(hist.paths(before=4)) >= 1
    import os
    assert len([d for d in os.listdir(f"{tmp_dir}/hist/__version=3") if d.startswith("__bucket=")]) == 1


def test_refresh_all_with_backfill(spark, tmp_dir):
    import datetime as dt
    from helpers import tick, ticks_df
    from marketpulse.plans.pipeline import Inputs, refresh_all
    inst, trd, cps = dims(spark)
    when = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hist = spark.createDataFrame(
        [("T-H", "AAA", "BUY", 10, Decimal("11.00"), "TR-1", "EQ", "CP-1", dt.datetime(2024, 1, 2, 3, 0)),
         ("T-1", "AAA", "BUY", 10, Decimal("99.00"), "TR-1", "EQ", "CP-1", dt.datetime(2024, 1, 2, 4, 0))],
        "trade_id string, ticker string, side string, quantity int, price decimal(12,2), trader_id string, "
        "desk string, counterparty_id string, timestamp timestamp_ntz")
    inputs = Inputs(raw_trades=trades_df(spark, [trade("T-1"), trade("T-2", side="SELL")]),
                    raw_ticks=ticks_df(spark, [tick("M1")]), instruments=inst,
                    trader_changes=trd.withColumn("updated_at", when),
                    counterparty_changes=cps.withColumn("updated_at", when), backfill=hist)
    store = TableStore(spark, f"{tmp_dir}/tables")
    written = refresh_all(store, inputs)
    assert len(written) == 17
    trades = {r.trade_id: r for r in store.read("enriched_trades").collect()}
    assert set(trades) == {"T-1", "T-2", "T-H"}            # the backfill copy of T-1 is a duplicate
    assert trades["T-H"].price == 11.0 and trades["T-H"].trader_name == "Ann"
