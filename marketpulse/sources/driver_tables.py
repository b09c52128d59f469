"""Views that turn the benchmark star schema into trades, ticks and reference data.

Each raw trade is one lineitem row (with its order, part and supplier); each
tick is one event. A fixed set of key residues injects the five kinds of bad
record the trade feed is known to carry (about 5 %), so the quality rules are
exercised; no row is removed by the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import format_event_time
from ..plans.joins import lookup_join

# Key residues that mark injected bad records.
NEGATIVE_PRICE_MOD = 89
ZERO_QTY_MOD = 83
QTY_SPIKE_MOD = 61
NULL_TICKER_MOD = 97
MISSING_TRADER_MOD = 79
FUTURE_TIME_MOD = 73
FUTURE_TIME = "2030-12-31 23:59:59"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _region_of_nation(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return lookup_join(nation, region, "n_regionkey", "r_regionkey")


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("PT-"), F.col("p_partkey")).alias("ticker"),
        F.col("p_name").alias("company_name"),
        F.col("p_type").alias("sector"),
        F.when(F.col("p_size") > 40, "ETF").otherwise("EQUITY").alias("asset_class"),
        F.lit("USD").alias("currency"),
        F.col("p_brand").alias("exchange"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("base_price"))


def traders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    s = lookup_join(s, _region_of_nation(spark, sf_dir), "s_nationkey", "n_nationkey")
    return s.select(
        F.concat(F.lit("TR-"), F.col("s_suppkey")).alias("trader_id"),
        F.col("s_name").alias("trader_name"),
        F.col("r_name").alias("desk"),
        F.concat(F.col("r_name"), F.lit(" desk")).alias("desk_full_name"),
        (F.col("s_acctbal") * 500).cast("decimal(15,2)").alias("risk_limit_usd"),
        F.lit(None).cast("string").alias("manager"),
        F.col("n_name").alias("location"))


def counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = lookup_join(c, nation, "c_nationkey", "n_nationkey")
    return c.select(
        F.concat(F.lit("CP-"), F.col("c_custkey")).alias("counterparty_id"),
        F.col("c_name").alias("counterparty_name"),
        F.lit(None).cast("string").alias("lei_code"),
        F.when(F.col("c_acctbal") < 0, "HIGH").when(F.col("c_acctbal") < 5000, "MEDIUM")
         .otherwise("LOW").alias("risk_rating"),
        F.col("c_mktsegment").alias("counterparty_type"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("city"))


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade rows (TRADE_RAW columns + ``_arrival`` for the dedup order + ``_order``, by which rows lie together)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    t = lookup_join(li, part, "l_partkey", "p_partkey")
    # One table after the other: Spark knows a scanned table's size, but takes a joined one for their product.
    t = lookup_join(t, supp, "l_suppkey", "s_suppkey")
    t = lookup_join(t, nation, "s_nationkey", "n_nationkey")
    t = lookup_join(t, region, "n_regionkey", "r_regionkey")
    # Orders last: the lines of an order, and so all copies of a trade, are then in one task.
    t = lookup_join(t, orders, "l_orderkey", "o_orderkey")

    k = F.col("l_orderkey")
    hit = lambda m: (k % m) == 0
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    price = (F.floor(cents * (1950 + k % 101) / 2000).cast("double") / 100)
    qty = F.col("l_quantity").cast("int")
    shifted = F.col("l_shipdate") + F.make_dt_interval(hours=(k % 24).cast("int"))
    event_time = F.when(hit(FUTURE_TIME_MOD), F.lit(FUTURE_TIME).cast("timestamp_ntz")).otherwise(shifted)
    missing_trader = hit(MISSING_TRADER_MOD)
    return t.select(
        F.concat(F.lit("T-"), k, F.lit("-"), F.col("l_linenumber")).alias("trade_id"),
        F.when(~hit(NULL_TICKER_MOD), F.concat(F.lit("PT-"), F.col("l_partkey"))).alias("ticker"),
        F.when(F.col("l_linestatus") == "F", "BUY").otherwise("SELL").alias("side"),
        F.when(hit(ZERO_QTY_MOD), F.lit(0)).when(hit(QTY_SPIKE_MOD), qty * 100)
         .otherwise(qty).alias("quantity"),
        F.when(hit(NEGATIVE_PRICE_MOD), -price).otherwise(price).alias("price"),
        F.col("o_orderpriority").alias("order_type"),
        F.when(~missing_trader, F.concat(F.lit("TR-"), F.col("l_suppkey"))).alias("trader_id"),
        F.when(~missing_trader, F.col("r_name")).alias("desk"),
        F.concat(F.lit("CP-"), F.col("o_custkey")).alias("counterparty_id"),
        F.col("n_name").alias("exchange"),
        F.lit("USD").alias("currency"),
        F.when(F.col("p_size") > 40, "ETF").otherwise("EQUITY").alias("asset_class"),
        format_event_time(event_time).alias("timestamp"),
        F.when(hit(NEGATIVE_PRICE_MOD), "negative_price").when(hit(ZERO_QTY_MOD), "zero_qty")
         .when(hit(NULL_TICKER_MOD), "null_ticker").when(missing_trader, "missing_trader")
         .when(hit(FUTURE_TIME_MOD), "future_timestamp").alias("_dq_flag"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey").alias("_arrival"),
        k.alias("_order"))


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tick rows with ``event_time`` already typed (the event clock has
    microseconds, finer than the text format)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    i = F.col("event_id")
    c = F.round(F.col("value") * 100).cast("bigint")
    bid = (c - 1 - i % 5).cast("double") / 100
    ask = (c + 1 + i % 7).cast("double") / 100
    return e.select(
        F.concat(F.lit("MK-"), i).alias("tick_id"),
        F.concat(F.lit("PT-"), F.col("user_id")).alias("ticker"),
        bid.alias("bid"), ask.alias("ask"),
        F.col("value").alias("last_price"),
        ((2 + i % 5 + i % 7).cast("double") / 100).alias("spread"),
        (i % 1000).cast("int").alias("tick_volume"),
        i.alias("cumulative_volume"),
        F.greatest(ask, F.col("value")).alias("high_52w"),
        F.least(bid, F.col("value")).alias("low_52w"),
        F.col("event_type").alias("exchange"),
        F.lit("EQUITY").alias("asset_class"),
        format_event_time("ts").alias("timestamp"),
        F.col("ts").alias("event_time"))


def customer_priority_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only change log: each order re-states its customer's priority."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderpriority").alias("priority"),
                    F.col("o_orderdate").alias("updated_at"))
