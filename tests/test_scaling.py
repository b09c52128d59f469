"""What a query moves or holds at once, on rows of the test's own."""

import os
import time

from pyspark.sql import functions as F

from marketpulse.functions.timefmt import with_event_time
from marketpulse.operators import gold, silver
from marketpulse.operators.aggregates import COUNTERPARTY_EXPOSURE, POSITIONS
from marketpulse.operators.quality import Rule
from marketpulse.operators.silver import enrich_trades
from marketpulse.plans import incremental, queries, stream_checks
from marketpulse.plans.incremental import TRADE_INPUT, live_anomalies, read_anomalies
from marketpulse.plans.stream_checks import WAVES, _by_wave
from marketpulse.plans.tables import BUCKET, BucketedVersions
from marketpulse.schemas import ANOMALY_COLUMNS
from marketpulse.session import Steps, shuffles_dropped
from marketpulse.sources import files
from marketpulse.sources.files import read_trades, trades_stream, write_json_lines
from marketpulse.streaming import pipelines
from marketpulse.streaming.sinks import commit_folder, committed_batch_dirs, read_batch_dirs

from helpers import TRADE_COLS, dims, tick, ticks_df, trade, trades_df


def test_landing_files_are_compressed(spark, tmp_dir):
    rows = trades_df(spark, [trade("T-1"), trade(None, ticker=None), trade("T-2", ts="no time")])
    write_json_lines(rows, f"{tmp_dir}/landing")
    names = [n for n in os.listdir(f"{tmp_dir}/landing") if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    back = read_trades(spark, f"{tmp_dir}/landing", lineage=False).select(*TRADE_COLS)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_a_rebuild_has_tasks_by_the_rows_of_its_log(spark, monkeypatch, tmp_dir):
    spark.range(1000).select(F.when(F.col("id") > 9, F.col("id") % 200).alias("k"), "id").write.parquet(f"{tmp_dir}/log")
    log = spark.read.parquet(f"{tmp_dir}/log")
    monkeypatch.setattr(pipelines, "CHANGES_PER_TASK", 20)
    dealt = pipelines._dealt(log, ["k"])
    assert dealt.rdd.getNumPartitions() == 50
    assert dealt.exceptAll(log).count() == 0 and dealt.count() == 1000
    assert pipelines._dealt(log.limit(0), ["k"]).count() == 0


def test_traders_are_looked_up_last_and_columns_keep_their_order(spark):
    out = enrich_trades(with_event_time(trades_df(spark, [trade("T-1"), trade("T-2", trader_id=None)])), *dims(spark))
    joins = [x for x in out._jdf.queryExecution().analyzed().toString().split("\n") if "Join LeftOuter" in x]
    assert len(joins) == 3
    order = [out._jdf.queryExecution().analyzed().toString().rindex(f"coalesce({c}#") for c in ("trader_id", "counterparty_id", "ticker")]
    assert order == sorted(order)   # the outermost join is printed first
    assert out.columns[len(TRADE_COLS) + 1:len(TRADE_COLS) + 11] == [
        "company_name", "sector", "trader_name", "desk_full_name", "risk_limit_usd", "location",
        "counterparty_name", "risk_rating", "counterparty_type", "cp_country"]
    got = {r.trade_id: (r.trader_name, r.counterparty_name) for r in out.collect()}
    assert got == {"T-1": ("Ann", "Cit"), "T-2": (None, "Cit")}


def test_each_row_has_one_wave(spark):
    rows = spark.createDataFrame([(f"T-{i}" if i else None,) for i in range(100)], "trade_id string")
    waves = [r.wave for r in _by_wave(rows).collect()]
    assert len(waves) == 100 and set(waves) == set(range(WAVES))


def test_a_folder_is_committed_by_a_move(spark, tmp_dir):
    rows = spark.range(10).withColumn("batch_id", (F.col("id") % 2).cast("int"))
    rows.write.partitionBy("batch_id").parquet(f"{tmp_dir}/stored")
    assert commit_folder(spark, f"{tmp_dir}/stored/batch_id=1", f"{tmp_dir}/sink/batch_id=1")
    assert not commit_folder(spark, f"{tmp_dir}/stored/batch_id=1", f"{tmp_dir}/sink/batch_id=1")
    assert len(committed_batch_dirs(spark, f"{tmp_dir}/sink")) == 1
    assert sorted(r.id for r in read_batch_dirs(spark, f"{tmp_dir}/sink").collect()) == [1, 3, 5, 7, 9]


def test_the_cards_put_their_trades_together_once(spark, tmp_dir):
    t = queries.Tables(spark, tmp_dir)
    t.raw_trades = trades_df(spark, [trade("T-1"), trade("T-2", side="SELL", price=12.0), trade("T-3", price=-1.0)])
    t.raw_ticks = ticks_df(spark, [tick("M-1")])
    t.instruments, t.traders, t.counterparties = dims(spark)
    stored = []
    t.kept = lambda df, keep=t.kept: stored.append(df.columns) or keep(df)
    out = queries._cards(t)
    assert stored[0] == queries.FOLDED
    assert "order_type" not in out._jdf.queryExecution().optimizedPlan().toString()   # a raw column only
    row = out.first()
    assert (row.total_trades, row.total_volume_usd, row.net_pnl_usd) == (2, 2200.0, 200.0)


def _exchanges(df, by=""):
    return df._jdf.queryExecution().executedPlan().toString().count(f"Exchange hashpartitioning({by}")


def test_copies_of_a_trade_are_looked_for_where_they_lie(spark):
    rows = [trade(f"T-{o}-{n}", price=float(10 + c)) for o in range(5) for n in range(2) for c in (1, 0, 0)]
    raw = trades_df(spark, [*rows, trade(None), trade(None, price=3.0)]).withColumn(
        "_order", F.split("trade_id", "-")[1].cast("bigint"))
    dealt = raw.repartition(4, "_order")
    got = silver.clean_trades(dealt)
    assert _exchanges(got) == 1 and _exchanges(got, "trade_id") == 0   # the deal of the test itself
    assert "_order" not in got.columns
    want = silver.clean_trades(raw.drop("_order"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    assert [r.price for r in got.collect()] == [10.0] * 10
    kept = silver.clean_trades(dealt, [Rule("valid_price", "price > 0", "drop")])   # rows without an id still fold into one
    assert sorted(repr(r.trade_id) for r in kept.collect()) == sorted(["None", *(repr(f"T-{o}-{n}") for o in range(5) for n in range(2))])


def test_a_fold_is_one_grouping(spark):
    new = enrich_trades(with_event_time(trades_df(spark, [
        trade("T-1"), trade("T-2", side="SELL"), trade("T-3", ticker="BBB", counterparty_id=None, price=float("nan"))])), *dims(spark))
    for spec in (POSITIONS, COUNTERPARTY_EXPOSURE):
        counts = [spec.pairs(new, v).filter("__value IS NOT NULL").distinct()
                  .select(*spec.keys, F.lit(1).cast("bigint").alias(n)) for n, v in spec.distinct.items()]
        stored = [spark.createDataFrame(c.collect(), c.schema) for c in counts]
        first = spec.merge(None, spec.rows(new), stored)
        assert sorted(map(repr, spec.finish(first).collect())) == sorted(map(repr, spec.batch(new).collect()))
        old = spark.createDataFrame(first.collect(), first.schema)
        rows = spec.rows(new)
        again = spec.merge(old, spark.createDataFrame(rows.collect(), rows.schema), stored[:0])
        assert _exchanges(again) == 1
        trades = {tuple(r[k] for k in spec.keys): r["__n"] for r in first.collect()}
        assert {tuple(r[k] for k in spec.keys): r["__n"] for r in again.collect()} == {k: 2 * n for k, n in trades.items()}


def test_stored_waves_hold_what_the_tables_read(spark):
    t = queries.Tables(spark, "")
    new = enrich_trades(with_event_time(trades_df(spark, [trade(f"T-{i}", price=10.0 + i) for i in range(9)])), *dims(spark))
    ticks = silver.enrich_ticks(ticks_df(spark, [tick("M-1"), tick("M-2", ticker="BBB")]))
    store = stream_checks.incremental_tables(t.spark, new, ticks)
    assert sorted(store.read("silver_trades").columns) == sorted([*TRADE_INPUT, "wave"])
    assert sorted(map(repr, store.read("positions").collect())) == sorted(map(repr, POSITIONS.batch(new).collect()))


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return set(x for x in blocks.mkString(",").split(",") if x.startswith("shuffle_"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting, None), _shuffle_files(spark)
    rows = lambda: spark.range(1000).repartition(4, (F.col("id") % 50).alias("k"))
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            rows().write.parquet(f"{tmp_dir}/a")
        again = rows()
        again.write.parquet(f"{tmp_dir}/b")   # the inner block has not ended the outer one
        again.write.parquet(f"{tmp_dir}/c")
    assert spark.conf.get(setting, None) == was
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert [spark.read.parquet(f"{tmp_dir}/{x}").count() for x in "abc"] == [1000] * 3


def test_lookups_in_steps_hold_one_step(spark):
    trades = with_event_time(trades_df(spark, [trade("T-1"), trade("T-2", trader_id=None), trade(None, ticker="ZZZ", counterparty_id=None)]))
    want = enrich_trades(trades, *dims(spark))
    held = []

    def watched(steps):
        return lambda df: (steps(df), held.append(os.listdir(steps.root)))[0]
    steps = Steps(spark)
    got = enrich_trades(trades, *dims(spark), keep=watched(steps))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    few = Steps(spark, TRADE_INPUT)
    got = enrich_trades(trades, *dims(spark), keep=watched(few)).select(*TRADE_INPUT)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*TRADE_INPUT).collect()))
    assert held == [["1"], ["2"], ["3"]] * 2
    steps.drop()
    assert not os.path.exists(steps.root)


def test_a_backlog_is_taken_in_several_micro_batches(spark, monkeypatch, tmp_dir):
    for n in range(3):
        rows = trades_df(spark, [trade(f"T-{n}"), trade(f"T-{n}"), trade("T-0", price=5.0)])
        write_json_lines(rows.coalesce(1), f"{tmp_dir}/landing", mode="append")
    monkeypatch.setattr(files, "MAX_BYTES_PER_TRIGGER", 1)
    q = pipelines.start_trades(trades_stream(spark, f"{tmp_dir}/landing"), f"{tmp_dir}/sink", f"{tmp_dir}/ck",
                               lambda: dims(spark), processed_at=False)
    q.awaitTermination()
    assert q.exception() is None and len(committed_batch_dirs(spark, f"{tmp_dir}/sink")) == 3
    assert sorted(r.trade_id for r in read_batch_dirs(spark, f"{tmp_dir}/sink").collect()) == ["T-0", "T-1", "T-2"]


def test_buckets_are_flagged_in_parts(spark, monkeypatch):
    rows = [trade(f"T-{i}", ticker=f"TK{i % 7}" if i % 9 else None, price=10.0 + i % 5, quantity=1 + 500 * (i % 13 == 0)) for i in range(60)]
    new = enrich_trades(with_event_time(trades_df(spark, rows)), *dims(spark))
    parts = []
    real = BucketedVersions.write_parts
    monkeypatch.setattr(BucketedVersions, "write_parts", lambda self, dfs, v: real(self, (parts.append(v) or df for df in dfs), v))
    monkeypatch.setattr(incremental, "FLAGGED_AT_ONCE", 10)
    store = stream_checks.incremental_tables(spark, new, silver.enrich_ticks(ticks_df(spark, [tick("M-1")])))
    assert parts.count(2) == 6 and parts.count(1) > 1
    want = gold.trade_anomalies(new)
    assert want.count() > 0
    assert sorted(map(repr, read_anomalies(store).select(*ANOMALY_COLUMNS).collect())) == sorted(map(repr, want.collect()))
    # a refresh's replaced versions are gone, and nothing half written is left
    assert [len(store.versions(n)) for n in ("positions", "_partial_positions", "mark_to_market_pnl")] == [1] * 3
    assert not [n for n in os.listdir(live_anomalies(store).root) if n.startswith("_open")]


def test_a_version_in_parts_is_seen_when_all_are_there(spark, tmp_dir):
    table = BucketedVersions(spark, f"{tmp_dir}/t", 4)
    part = lambda b, x: spark.createDataFrame([(b, x)], f"{BUCKET} int, x string")
    table.write_parts([part(0, "a"), part(1, "b")], 0)

    def broken():
        yield part(0, "c")
        raise ValueError("crash")
    try:
        table.write_parts(broken(), 1)
    except ValueError:
        pass
    assert sorted(r.x for r in table.read().collect()) == ["a", "b"]
    table.write_parts([part(1, "d")], 1)   # what the crash left is not part of it
    assert sorted(r.x for r in table.read().collect()) == ["a", "d"]
    table.write_parts([part(1, "e")], 1)
    assert sorted(r.x for r in table.read().collect()) == ["a", "e"]


def test_copies_are_ranked_where_they_lie_before_landing(spark, monkeypatch):
    monkeypatch.setattr(stream_checks, "_stored_dims", lambda *_: lambda: dims(spark))
    rows = [trade(f"T-{o}-{n}", price=float(10 + c)) for o in range(3) for n in range(2) for c in (2, 0, 1)]
    raw = trades_df(spark, [*rows, trade(None), trade(None, price=3.0)]).withColumn(
        "_order", F.split("trade_id", "-")[1].cast("bigint")).withColumn("_arrival", F.col("price"))
    ranked = []
    real = stream_checks._parts
    monkeypatch.setattr(stream_checks, "_parts", lambda df, c, path: ranked.append(df) or real(df, c, path))
    got = stream_checks.stream_enriched_trades(spark, "", queries.TRADE_OUT, raw.repartition(4, "_order"))
    assert _exchanges(ranked[0]) == 1 and _exchanges(ranked[0], "trade_id") == 0   # the deal of the test itself
    want = silver.enriched_trades(raw, *dims(spark)).select(*queries.TRADE_OUT)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert [r.price for r in got.collect()] == [10.0] * 6
