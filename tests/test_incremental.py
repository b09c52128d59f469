"""Incremental aggregates must equal a full recompute, also when a batch is
offered again (crash before the next step)."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from marketpulse.plans.incremental import BatchLog, live_anomalies, read_anomalies, refresh_incremental
from marketpulse.plans.queries import Tables
from marketpulse.plans.tables import TableStore


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_incremental_equals_full_recompute(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    part = lambda df, c, i: df.filter(F.pmod(F.xxhash64(c), F.lit(3)) == i)
    trades = {i: part(t.enriched, "trade_id", i) for i in range(3)}
    ticks = {i: part(t.ticks, "tick_id", i) for i in range(3)}
    store = TableStore(spark, f"{tmp_dir}/tables")

    def reader(parts):
        def read(ids):
            out = parts[ids[0]]
            for i in ids[1:]:
                out = out.unionByName(parts[i])
            return out
        return read
    rt, rk = reader(trades), reader(ticks)
    refresh_incremental(store, [0], rt, [0], rk, stamps=False)
    refresh_incremental(store, [0, 1], rt, [0, 1], rk, stamps=False)
    refresh_incremental(store, [0, 1, 2], rt, [0, 1, 2], rk, stamps=False)
    refresh_incremental(store, [0, 1, 2], rt, [0, 1, 2], rk, stamps=False)  # no change
    want = {"desk_pnl": t.desk_pnl, "risk_exposure_by_sector": t.sector_exposure,
            "positions": t.positions, "hourly_trade_volume": t.hourly,
            "latest_market_prices": t.latest, "mark_to_market_pnl": t.mtm,
            "trade_anomalies": t.anomalies}
    from marketpulse.operators import gold
    want["counterparty_exposure"] = gold.counterparty_exposure(t.enriched)
    for name, df in want.items():
        got = read_anomalies(store) if name == "trade_anomalies" else store.read(name)
        assert got.columns == df.columns, name
        assert _rows(got) == _rows(df), name


def test_anomaly_refresh_touches_only_the_tickers_that_traded(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    store = TableStore(spark, f"{tmp_dir}/tables")
    all_trades = TableStore(spark, f"{tmp_dir}/silver")
    all_trades.write("trades", t.enriched)
    trades, ticks = all_trades.read("trades"), t.ticks
    one = trades.first().ticker
    late = (trades.ticker == one) & (F.pmod(F.xxhash64("trade_id"), F.lit(2)) == 1)
    parts = {0: trades.filter(~late), 1: trades.filter(late)}
    for ids in ([0], [0, 1]):
        refresh_incremental(store, ids, lambda new: parts[new[-1]], [0], lambda new: ticks, stamps=False)
    assert _rows(read_anomalies(store)) == _rows(t.anomalies)
    flags = live_anomalies(store)
    newest = [p for p in flags.paths().values() if "__version=1/" in p]
    assert len(newest) == 1 and len(flags.paths()) > 20     # one bucket of many was rewritten
    log = BatchLog(store, "_anomaly_rows")
    bucket = newest[0].rsplit("=", 1)[1]
    touched = log.read(1).filter(F.col("__bucket").isin([int(bucket)]))
    files = {r[0] for r in touched.select("_metadata.file_path").distinct().collect()}
    assert {f.rsplit("/", 2)[1] for f in files} == {f"__bucket={bucket}"}
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "PartitionFilters: [(__bucket" in plan
    # A refresh that takes the last flag of a bucket away leaves none behind.
    calm = trades.filter(trades.ticker == one).withColumn("risk_limit_usd", F.lit(None).cast("decimal(15,2)"))
    other = TableStore(spark, f"{tmp_dir}/other")
    copies = lambda tag, n, q: (calm.limit(1).crossJoin(spark.range(n)).withColumns({
        "trade_id": F.concat(F.lit(tag), "id"), "quantity": F.lit(q), "price": F.lit(10.0)}).drop("id"))
    waves = {0: copies("S-", 30, 100).unionByName(copies("B-", 1, 100_000)), 1: copies("C-", 200, 100_000)}
    seen = []
    for ids in ([0], [0, 1]):
        refresh_incremental(other, ids, lambda new: waves[new[-1]], [], lambda new: ticks, stamps=False)
        seen.append([r.trade_id for r in read_anomalies(other).collect()])
    assert seen == [["B-0"], []]


def test_pairs_are_only_added(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    store = TableStore(spark, f"{tmp_dir}/tables")
    trades = spark.createDataFrame(t.enriched.limit(200).collect(), t.enriched.schema)
    for ids in ([0], [0, 1]):
        refresh_incremental(store, ids, lambda new: trades, [], lambda new: None, stamps=False)
    log = BatchLog(store, "_pairs_desk_pnl_unique_tickers")
    assert log.read(0).count() > 0 and spark.read.parquet(log.folders(1)[1]).count() == 0
