"""Stream = batch checks over the driver tables.

Rows derived from the driver tables are landed as files in a fresh folder
under the cluster's checkpoint folder, the streaming pipeline runs over them
with ``availableNow`` (twice, with a restart between two waves of files), and
the sink is read back. The result must equal the batch query's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import gold
from ..operators.silver import ARRIVAL, TOGETHER, enrich_trades
from ..schemas import REFERENCE_CSV, TICK_RAW, TRADE_RAW
from ..session import drop_folder, scratch_path, shuffles_dropped
from ..sources import driver_tables as dt
from ..sources.files import bronze_stream, ticks_stream, trades_stream, write_json_lines
from ..sources.changelog import change_log_stream
from ..sources.reference import read_reference_csv
from ..streaming.pipelines import start_scd2, start_ticks, start_trades
from ..streaming.live import LivePaths, dq_report
from ..streaming.sinks import append_file_sink, commit_folder, read_batch_dirs
from .pipeline import driver_inputs, load_dims, refresh_reference
from .tables import TableStore

TRADE_RAW_COLS = [f.name for f in TRADE_RAW.fields]
TICK_RAW_COLS = [f.name for f in TICK_RAW.fields]


def _base(spark: SparkSession, what: str) -> str:
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex[:12]}")


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _stored_dims(spark: SparkSession, sf_dir: str, base: str):
    """A loader of the reference tables as stored rows, as the deployed streams read them: a micro-batch then
    plans its lookups from their true size, which it cannot know of a join it would repeat each time."""
    store = TableStore(spark, f"{base}/reference")
    for name, make in (("instruments", dt.instruments), ("traders", dt.traders), ("counterparties", dt.counterparties)):
        store.write(name, make(spark, sf_dir))
    return lambda: tuple(store.read(name) for name in ("instruments", "traders", "counterparties"))


def stream_enriched_trades(spark: SparkSession, sf_dir: str, trade_out: list[str], raw: DataFrame) -> DataFrame:
    """Landing files → bronze → silver, as deployed. Every raw copy is landed once, in arrival order: wave n
    holds the n-th copy of each trade. Both streams are restarted between waves, and the dedup state must let
    exactly the first copies through (later ones have other payloads), so the sink equals the batch table."""
    base = _base(spark, "stream-trades")
    landing, bronze, sink, ck = (f"{base}/{d}" for d in ("landing", "bronze", "sink", "checkpoint"))
    rest = [c for c in raw.columns if c not in ("trade_id", ARRIVAL, TOGETHER)]
    # Copies are ranked where they lie; rows without an id, which the rules drop, per order then.
    together = [TOGETHER] if TOGETHER in raw.columns else []
    arrival = Window.partitionBy(*together, "trade_id").orderBy(*[F.col(c).asc_nulls_first() for c in [ARRIVAL, *rest]])
    copies = raw.withColumn("copy", F.least(F.row_number().over(arrival), F.lit(2))).select(*TRADE_RAW_COLS, "copy")
    with shuffles_dropped(spark):
        dims = _stored_dims(spark, sf_dir, base)
        parts = _parts(copies, "copy", f"{base}/ranked")
        for n in (1, 2):
            write_json_lines(parts(n), landing, mode="append")
            drop_folder(spark, f"{base}/ranked/copy={n}")
            _run(append_file_sink(trades_stream(spark, landing), bronze, f"{ck}/bronze"))
            _run(start_trades(bronze_stream(spark, bronze, TRADE_RAW), sink, f"{ck}/silver", dims, processed_at=False))
    return read_batch_dirs(spark, sink).select(*trade_out)


def _parts(rows: DataFrame, number: str, path: str) -> Callable[[int], DataFrame]:
    """Rows put together once and stored by the column ``number``; a reader of one part."""
    rows.write.option("compression", "zstd").partitionBy(number).parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema)
    return lambda n: stored.parquet(path).filter(F.col(number) == n).drop(number)


def live_dq_report(spark: SparkSession, sf_dir: str, deduped: DataFrame) -> DataFrame:
    """Kept rule counts of several runs, one of them replayed: the last commit of the first run is taken back, as a
    crash before it would leave it, so the second run repeats that micro-batch before its own."""
    paths = LivePaths(_base(spark, "live-rules"))
    landing = {k: f"{paths.root}/landing/{k}" for k in ("trades", "ticks")}
    trades, ticks = deduped.select(*TRADE_RAW_COLS), dt.raw_ticks(spark, sf_dir).select(*TICK_RAW_COLS)
    half = lambda c: F.pmod(F.xxhash64(c), F.lit(2)).cast("int")
    with shuffles_dropped(spark):
        dims = _stored_dims(spark, sf_dir, paths.root)
        parts = _parts(trades.withColumn("half", half("trade_id")), "half", f"{paths.root}/halves")
        for n in range(2):
            write_json_lines(parts(n), landing["trades"], mode="append")
            drop_folder(spark, f"{paths.root}/halves/half={n}")
            write_json_lines(ticks.filter(half("tick_id") == n), landing["ticks"], mode="append")
            _run(start_trades(trades_stream(spark, landing["trades"]), paths.sink("enriched_trades"), paths.checkpoint("trades"),
                              dims, processed_at=False, rule_counts=paths.rules("enriched_trades")))
            _run(start_ticks(ticks_stream(spark, landing["ticks"]), paths.sink("enriched_market_data"), paths.checkpoint("ticks"),
                             per_batch=True, rule_counts=paths.rules("enriched_market_data")))
            if n == 0:
                for kind in ("trades", "ticks"):
                    _take_back_commit(spark, paths.checkpoint(kind))
    return dq_report(spark, paths)


def _take_back_commit(spark: SparkSession, checkpoint: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(st.getPath().getName()) for st in fs.listStatus(path) if st.getPath().getName().isdigit())
    for name in (str(last), f".{last}.crc"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}")
        if fs.exists(p):
            fs.delete(p, False)


def enriched_by_history(spark: SparkSession, sf_dir: str, clean: DataFrame) -> DataFrame:
    """Trades looked up in histories with several versions a key: each trader and counterparty had another name
    and place before. Lookups must read the stored open versions only."""
    store = TableStore(spark, _base(spark, "history") + "/tables")
    inputs = driver_inputs(spark, sf_dir)

    def versions(now: DataFrame, *renamed: str) -> DataFrame:
        old = now.withColumns({c: F.concat(F.lit("former "), c) for c in renamed})
        before = [old.withColumn("updated_at", F.col("updated_at") - F.make_dt_interval(days=F.lit(d))) for d in (400, 30)]
        return now.unionByName(before[0].withColumn(renamed[0], F.lit("first"))).unionByName(before[1])
    refresh_reference(store, inputs.instruments, versions(inputs.trader_changes, "trader_name", "desk_full_name"),
                      versions(inputs.counterparty_changes, "counterparty_name", "country"))
    return enrich_trades(clean, *load_dims(store))


def stream_market_data(spark: SparkSession, sf_dir: str, tick_out: list[str]) -> DataFrame:
    """Ticks go through the text time format (millisecond precision)."""
    base = _base(spark, "stream-ticks")
    landing, sink, ck = f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"
    write_json_lines(dt.raw_ticks(spark, sf_dir).select(*TICK_RAW_COLS), landing)
    _run(start_ticks(ticks_stream(spark, landing), sink, ck))
    return spark.read.parquet(sink).select(*tick_out)


def stream_scd2_history(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """Two waves of the change log; the second carries older sequence values
    for keys already seen (late changes), which must split open versions.
    ``buckets``: the key-bucketed layout (only touched buckets rewritten)."""
    base = _base(spark, "stream-scd2")
    log_in, log, ck = f"{base}/changes", f"{base}/log", f"{base}/checkpoint"
    store = TableStore(spark, f"{base}/tables")
    changes = dt.customer_priority_changes(spark, sf_dir)
    urgent = changes.priority.isin("1-URGENT", "2-HIGH")
    changes.filter(urgent).write.mode("overwrite").parquet(log_in)
    kw = dict(tie_break=["priority"], track=["priority"], buckets=buckets)
    stream = lambda: change_log_stream(spark, log_in, changes.schema)
    _run(start_scd2(stream(), log, store, "history", ["customer_id"], "updated_at", ck, **kw))
    changes.filter(~urgent).write.mode("append").parquet(log_in)
    _run(start_scd2(stream(), log, store, "history", ["customer_id"], "updated_at", ck, **kw))
    if buckets:
        from .tables import BucketedVersions
        return BucketedVersions(spark, store.table_dir("history"), buckets).read()
    return store.read("history")


# Arrival waves for the incremental check: a row's id decides, so every row,
# also one without an event time or an id, is in one wave.
WAVES = 3


def _by_wave(df: DataFrame) -> DataFrame:
    key = "trade_id" if "trade_id" in df.columns else "tick_id"
    return df.withColumn("wave", F.pmod(F.xxhash64(key), F.lit(WAVES)).cast("int"))


def _nothing() -> None:
    pass


def incremental_tables(spark: SparkSession, enriched: DataFrame, ticks: DataFrame,
                       stored: Callable[[], None] = _nothing) -> TableStore:
    """Fold the waves into the incremental aggregates one refresh at a time. ``stored()`` is called when silver is
    stored. Versions that a refresh has replaced are deleted, as in the live pipeline; here none is being read."""
    from .incremental import LATEST_WITH_ID, TRADE_INPUT, live_anomalies, refresh_incremental
    store = TableStore(spark, _base(spark, "incremental") + "/tables")
    # silver is stored before the aggregates read it, as in the live pipeline, one folder a wave: each table
    # reads the waves it has not folded yet and no others; columns that no table reads are not moved and not stored
    by_wave = {"silver_trades": _by_wave(enriched.select(*TRADE_INPUT)), "silver_ticks": _by_wave(ticks.select(*LATEST_WITH_ID))}

    def reader(df):
        return lambda ids: df.filter(F.col("wave").isin(ids)).drop("wave")
    with shuffles_dropped(spark):
        enriched, ticks = [spark.read.schema(df.schema).parquet(store.write(name, df, ["wave"])) for name, df in by_wave.items()]
        stored()
        for n in range(1, WAVES + 1):
            ids = list(range(n))
            refresh_incremental(store, ids, reader(enriched), ids, reader(ticks), stamps=False)
            for name in store.tables():
                store.vacuum(name, 1)
            live_anomalies(store).vacuum()
    return store


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def stream_dedup_within(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Bounded dedup over two waves: every trade id once, first copies with old
    and future event times included, copies of the second wave dropped."""
    from ..operators.dedup import dedup_stream
    from ..functions.timefmt import with_event_time
    from ..streaming.sinks import batch_dir_writer, trigger_args
    base = _base(spark, "stream-within")
    landing, sink, ck = f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"
    late = F.pmod(F.xxhash64("trade_id"), F.lit(2)) == 1
    with shuffles_dropped(spark):
        for wave in (raw.filter(~late), raw):
            write_json_lines(wave.select(*TRADE_RAW_COLS), landing, mode="append")
            flow = dedup_stream(with_event_time(trades_stream(spark, landing)), ["trade_id"], within="7 days")
            _run(flow.writeStream.foreachBatch(batch_dir_writer(sink)).option("checkpointLocation", ck)
                 .trigger(**trigger_args()).start())
    return read_batch_dirs(spark, sink).groupBy("trade_id").agg(F.count(F.lit(1)).alias("copies"))


def live_tables(spark: SparkSession, enriched: DataFrame, ticks: DataFrame,
                written: Callable[[], None] = _nothing) -> TableStore:
    """The deployed refresh over committed micro-batches: both kinds, then only
    ticks, then only trades, each run compacted before the next. ``written()`` is called when silver is written."""
    from ..streaming.live import LivePaths, compact_silver, refresh_gold
    paths = LivePaths(_base(spark, "live"))
    store = TableStore(spark, f"{paths.root}/stored")
    # Every row is written once, in the folder of its micro-batch; a run commits the folders that are its own.
    late = lambda c, n: F.when(F.pmod(F.xxhash64(c), F.lit(2)) == 1, n).otherwise(0)
    with shuffles_dropped(spark):
        stored = {"enriched_trades": store.write("trades", enriched.withColumn("batch_id", late("trade_id", 2)), ["batch_id"]),
                  "enriched_market_data": store.write("ticks", ticks.withColumn("batch_id", late("tick_id", 1)), ["batch_id"])}
        written()
        runs = {"enriched_trades": (enriched, (0, 2)), "enriched_market_data": (ticks, (0, 1))}
        for n in range(3):
            for kind, path in stored.items():
                df, own = runs[kind]
                folder = f"{paths.sink(kind)}/batch_id={n}"
                if not commit_folder(spark, f"{path}/batch_id={n}", folder) and n in own:
                    spark.createDataFrame([], df.schema).write.parquet(folder)   # a micro-batch without rows
            refresh_gold(spark, paths)
            compact_silver(spark, paths)
        out = TableStore(spark, paths.tables)
        table = out.read("mark_to_market_pnl").drop("calculated_at")
        out.write("mark_to_market_pnl", table)
    return out


def csv_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: instruments written as seed CSV files and read back typed, and the empty fields that must read as NULL."""
    base = _base(spark, "seed")
    kinds = {"instruments": dt.instruments, "traders": dt.traders, "counterparties": dt.counterparties}
    read = {}
    for kind, make in kinds.items():
        make(spark, sf_dir).select(*REFERENCE_CSV[kind].fieldNames()).write.option("header", True).csv(f"{base}/{kind}")
        read[kind] = read_reference_csv(spark, f"{base}/{kind}", kind)
    key = {"instruments": "ticker", "traders": "trader_id", "counterparties": "counterparty_id"}
    name = {"instruments": "company_name", "traders": "trader_name", "counterparties": "counterparty_name"}
    amount = {"instruments": F.col("base_price"), "traders": F.col("risk_limit_usd"), "counterparties": F.lit(None)}
    missing = {"instruments": F.lit(0), "traders": F.col("manager").isNull().cast("int"),
               "counterparties": F.col("lei_code").isNull().cast("int") + F.col("city").isNull().cast("int")}
    return _union([df.select(F.lit(k).alias("kind"), F.col(key[k]).alias("id"), F.col(name[k]).alias("name"),
                             amount[k].cast("double").alias("amount"), missing[k].cast("bigint").alias("empty_fields"),
                             F.col("_ingested_at").isNotNull().alias("stamped")) for k, df in read.items()])


def lineage_columns(spark: SparkSession, sf_dir: str, enriched: DataFrame, stored: Callable[[], None] = _nothing) -> DataFrame:
    """SRC-7 and PRJ-17: (table_name, rows, with_file, stamped): how many rows name a landing file, and how many
    carry a stamp from the time of this run. Tables without a file column count none. ``stored()`` is called when
    the enriched trades are stored."""
    base = _base(spark, "lineage")
    store = TableStore(spark, f"{base}/tables")
    start = datetime.now(UTC).replace(tzinfo=None) - timedelta(seconds=1)
    with shuffles_dropped(spark):
        store.write("enriched_trades", enriched.withColumn("processed_at", F.current_timestamp()))
        stored()
        trades = store.read("enriched_trades")
        store.write("desk_pnl", gold.desk_pnl(trades, calculated_at=True))
        store.write("trade_anomalies", gold.trade_anomalies(trades, detected_at=True))
        for kind, raw, cols, stream in (("raw_trades", dt.raw_trades, TRADE_RAW_COLS, trades_stream),
                                        ("raw_market_data", dt.raw_ticks, TICK_RAW_COLS, ticks_stream)):
            write_json_lines(raw(spark, sf_dir).select(*cols), f"{base}/landing/{kind}")
            _run(append_file_sink(stream(spark, f"{base}/landing/{kind}"), f"{base}/{kind}", f"{base}/checkpoint/{kind}"))
    end = datetime.now(UTC).replace(tzinfo=None) + timedelta(seconds=1)
    tables = [(k, spark.read.parquet(f"{base}/{k}"), "_ingested_at") for k in ("raw_trades", "raw_market_data")]
    tables += [(k, store.read(k), c) for k, c in (("enriched_trades", "processed_at"), ("desk_pnl", "calculated_at"),
                                                  ("trade_anomalies", "detected_at"))]

    def counted(name: str, df: DataFrame, stamp: str) -> DataFrame:
        inside = F.col(stamp).cast("timestamp_ntz").between(F.lit(start), F.lit(end))
        landed = F.col("_source_file").contains(f"/landing/{name}/") if "_source_file" in df.columns else F.lit(False)
        return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(landed).alias("with_file"), F.count_if(inside).alias("stamped")
                      ).select(F.lit(name).alias("table_name"), "rows", "with_file", "stamped")
    return _union([counted(*t) for t in tables])
