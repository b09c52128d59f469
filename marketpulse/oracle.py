"""Independent SQL (DuckDB dialect) for every checked query.

Written from the table definitions, not generated from the Spark plans.
Money follows the same rules as ``functions.money``: whole-cent amounts are
summed as decimals; a mean is ``double(sum) / count``; doubles are rounded
through ``DECIMAL(38,10)``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- inputs
RAW_TRADES = """
raw_trades AS (
  SELECT
    'T-' || l.l_orderkey || '-' || l.l_linenumber AS trade_id,
    CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE 'PT-' || l.l_partkey END AS ticker,
    CASE WHEN l.l_linestatus = 'F' THEN 'BUY' ELSE 'SELL' END AS side,
    CASE WHEN l.l_orderkey % 83 = 0 THEN 0
         WHEN l.l_orderkey % 61 = 0 THEN CAST(l.l_quantity AS INTEGER) * 100
         ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
    (CASE WHEN l.l_orderkey % 89 = 0 THEN -1 ELSE 1 END)
      * (CAST(FLOOR(CAST(ROUND(p.p_retailprice * 100) AS BIGINT) * (1950 + l.l_orderkey % 101) / 2000) AS DOUBLE) / 100)
      AS price,
    o.o_orderpriority AS order_type,
    CASE WHEN l.l_orderkey % 79 = 0 THEN NULL ELSE 'TR-' || l.l_suppkey END AS trader_id,
    CASE WHEN l.l_orderkey % 79 = 0 THEN NULL ELSE r.r_name END AS desk,
    'CP-' || o.o_custkey AS counterparty_id,
    sn.n_name AS exchange,
    'USD' AS currency,
    CASE WHEN p.p_size > 40 THEN 'ETF' ELSE 'EQUITY' END AS asset_class,
    CASE WHEN l.l_orderkey % 73 = 0 THEN TIMESTAMP '2030-12-31 23:59:59'
         ELSE l.l_shipdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER)) END AS event_time,
    CASE WHEN l.l_orderkey % 89 = 0 THEN 'negative_price' WHEN l.l_orderkey % 83 = 0 THEN 'zero_qty'
         WHEN l.l_orderkey % 97 = 0 THEN 'null_ticker' WHEN l.l_orderkey % 79 = 0 THEN 'missing_trader'
         WHEN l.l_orderkey % 73 = 0 THEN 'future_timestamp' END AS _dq_flag,
    l.l_shipdate AS a_shipdate, l.l_partkey AS a_partkey, l.l_suppkey AS a_suppkey
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  LEFT JOIN region r ON sn.n_regionkey = r.r_regionkey
)"""

DEDUP = """
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY trade_id ORDER BY a_shipdate, a_partkey, a_suppkey) AS rn
    FROM raw_trades) WHERE rn = 1
)"""

CLEAN = """
clean AS (
  SELECT * FROM dedup
  WHERE trade_id IS NOT NULL AND ticker IS NOT NULL
    AND COALESCE(price > 0, FALSE) AND COALESCE(quantity > 0, FALSE)
)"""

DIMS = """
instruments AS (
  SELECT 'PT-' || p_partkey AS ticker, p_name AS company_name, p_type AS sector FROM part
),
traders AS (
  SELECT 'TR-' || s.s_suppkey AS trader_id, s.s_name AS trader_name, r.r_name || ' desk' AS desk_full_name,
         CAST(s.s_acctbal * 500 AS DECIMAL(15,2)) AS risk_limit_usd, n.n_name AS location
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
counterparties AS (
  SELECT 'CP-' || c.c_custkey AS counterparty_id, c.c_name AS counterparty_name,
         CASE WHEN c.c_acctbal < 0 THEN 'HIGH' WHEN c.c_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_rating,
         c.c_mktsegment AS counterparty_type, n.n_name AS cp_country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

ENRICHED = """
enriched AS (
  SELECT t.trade_id, t.ticker, t.side, t.quantity, t.price, t.order_type, t.trader_id, t.desk,
         t.counterparty_id, t.exchange, t.currency, t.asset_class,
         strftime(t.event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp",
         t._dq_flag,
         t.event_time, i.company_name, i.sector, tr.trader_name, tr.desk_full_name, tr.risk_limit_usd,
         tr.location, cp.counterparty_name, cp.risk_rating, cp.counterparty_type, cp.cp_country,
         CAST(ROUND(CAST(t.price AS DECIMAL(20,6)) * CAST(t.quantity AS DECIMAL(18,0)), 2) AS DOUBLE) AS notional_usd,
         CAST(t.event_time AS DATE) AS trade_date,
         CAST(hour(t.event_time) AS INTEGER) AS trade_hour
  FROM clean t
  LEFT JOIN instruments i ON t.ticker = i.ticker
  LEFT JOIN traders tr ON t.trader_id = tr.trader_id
  LEFT JOIN counterparties cp ON t.counterparty_id = cp.counterparty_id
)"""

TICKS = """
raw_ticks AS (
  SELECT 'MK-' || event_id AS tick_id, 'PT-' || user_id AS ticker,
         CAST(CAST(ROUND(value * 100) AS BIGINT) - 1 - event_id % 5 AS DOUBLE) / 100 AS bid,
         CAST(CAST(ROUND(value * 100) AS BIGINT) + 1 + event_id % 7 AS DOUBLE) / 100 AS ask,
         value AS last_price,
         CAST(2 + event_id % 5 + event_id % 7 AS DOUBLE) / 100 AS spread,
         CAST(event_id % 1000 AS INTEGER) AS tick_volume,
         event_id AS cumulative_volume,
         greatest(CAST(CAST(ROUND(value * 100) AS BIGINT) + 1 + event_id % 7 AS DOUBLE) / 100, value) AS high_52w,
         least(CAST(CAST(ROUND(value * 100) AS BIGINT) - 1 - event_id % 5 AS DOUBLE) / 100, value) AS low_52w,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp",
         event_type AS exchange, 'EQUITY' AS asset_class,
         ts AS event_time
  FROM events
),
derived_ticks AS (
  SELECT *,
    CAST(ROUND((CAST(bid AS DECIMAL(20,6)) + CAST(ask AS DECIMAL(20,6))) * 0.5, 2) AS DOUBLE) AS mid_price,
    CAST(ROUND(TRY_CAST(CASE WHEN (bid + ask) / 2 = 0 THEN NULL ELSE spread / ((bid + ask) / 2) * 10000 END
                        AS DECIMAL(38,10)), 2) AS DOUBLE) AS spread_bps
  FROM raw_ticks
),
ticks AS (
  SELECT * FROM derived_ticks
  WHERE tick_id IS NOT NULL AND ticker IS NOT NULL AND COALESCE(bid > 0, FALSE) AND COALESCE(ask > 0, FALSE)
)"""

LATEST = """
latest AS (
  SELECT ticker, bid, ask, last_price, mid_price, spread, spread_bps, tick_volume, cumulative_volume, event_time
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY event_time DESC NULLS LAST, tick_id DESC) AS rn
        FROM ticks) WHERE rn = 1
)"""

POSITIONS = """
positions AS (
  SELECT ticker, desk, sector, asset_class,
    CAST(SUM(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS BIGINT) AS net_quantity,
    CAST(SUM(CAST(CASE WHEN side = 'BUY' THEN notional_usd ELSE -notional_usd END AS DECIMAL(18,2))) AS DOUBLE) AS net_notional_usd,
    CAST(SUM(CAST(abs(notional_usd) AS DECIMAL(18,2))) AS DOUBLE) AS gross_notional_usd,
    COUNT(trade_id) AS trade_count,
    CAST(SUM(CAST(price AS DECIMAL(20,6))) AS DOUBLE) / COUNT(price) AS avg_price,
    MAX(event_time) AS last_trade_time,
    CASE WHEN SUM(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) > 0 THEN 'LONG'
         WHEN SUM(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) < 0 THEN 'SHORT'
         ELSE 'FLAT' END AS position_side
  FROM enriched GROUP BY ticker, desk, sector, asset_class
)"""

STATS = """
stats AS (
  SELECT ticker,
    CAST(SUM(quantity) AS DOUBLE) / COUNT(quantity) AS avg_qty,
    CASE WHEN COUNT(quantity) > 1 THEN sqrt(
      CAST(CAST(COUNT(quantity) AS DECIMAL(38,0)) * SUM(CAST(quantity AS DECIMAL(38,0)) * CAST(quantity AS DECIMAL(38,0)))
           - CAST(SUM(quantity) AS DECIMAL(38,0)) * CAST(SUM(quantity) AS DECIMAL(38,0)) AS DOUBLE)
      / CAST(COUNT(quantity) * (COUNT(quantity) - 1) AS DOUBLE)) END AS stddev_qty,
    CAST(SUM(CAST(price AS DECIMAL(20,6))) AS DOUBLE) / COUNT(price) AS avg_price
  FROM enriched GROUP BY ticker
)"""

FLAGGED = """
flagged AS (
  SELECT e.*, s.avg_qty, s.stddev_qty, s.avg_price,
    e.quantity > s.avg_qty + 3 * COALESCE(s.stddev_qty, 0.0) AS is_qty_anomaly,
    CAST(ROUND(TRY_CAST(CASE WHEN s.avg_price <> 0 THEN abs(e.price - s.avg_price) / s.avg_price * 100 END
                        AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_deviation_pct,
    e.notional_usd > e.risk_limit_usd AS is_risk_breach
  FROM enriched e LEFT JOIN stats s ON e.ticker = s.ticker
),
anomalies AS (
  SELECT trade_id, ticker, company_name, side, quantity, price, notional_usd, trader_id, trader_name,
         desk, desk_full_name, sector, counterparty_id, counterparty_name, risk_rating, cp_country,
         is_qty_anomaly, price_deviation_pct > 2.0 AS is_price_anomaly, is_risk_breach,
         price_deviation_pct, avg_qty, avg_price, risk_limit_usd, event_time, trade_date
  FROM flagged
  WHERE (is_qty_anomaly OR price_deviation_pct > 2.0 OR is_risk_breach) = TRUE
)"""

DESK_PNL = """
desk_pnl AS (
  SELECT desk, desk_full_name,
    CAST(SUM(CAST(CASE WHEN side = 'SELL' THEN notional_usd ELSE -notional_usd END AS DECIMAL(18,2))) AS DOUBLE) AS net_pnl_usd,
    CAST(SUM(CAST(abs(notional_usd) AS DECIMAL(18,2))) AS DOUBLE) AS gross_volume_usd,
    COUNT(trade_id) AS trade_count,
    COUNT(DISTINCT ticker) AS unique_tickers,
    COUNT(DISTINCT trader_id) AS active_traders,
    CAST(SUM(CAST(notional_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(notional_usd) AS avg_trade_size_usd,
    MAX(event_time) AS last_trade_time,
    CAST(SUM(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS buy_count,
    CAST(SUM(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END) AS BIGINT) AS sell_count,
    CAST(ROUND(TRY_CAST(SUM(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END)
        / greatest(SUM(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END), 1) AS DECIMAL(38,10)), 2) AS DOUBLE) AS buy_sell_ratio
  FROM enriched GROUP BY desk, desk_full_name
)"""

SECTOR = """
sector_x AS (
  SELECT sector, asset_class,
    SUM(CAST(CASE WHEN side = 'BUY' THEN notional_usd ELSE 0 END AS DECIMAL(18,2))) AS l,
    SUM(CAST(CASE WHEN side = 'SELL' THEN notional_usd ELSE 0 END AS DECIMAL(18,2))) AS s,
    COUNT(trade_id) AS trade_count, COUNT(DISTINCT ticker) AS unique_tickers, COUNT(DISTINCT desk) AS active_desks
  FROM enriched GROUP BY sector, asset_class
),
sector_exposure AS (
  SELECT sector, asset_class, CAST(l AS DOUBLE) AS long_notional_usd, CAST(s AS DOUBLE) AS short_notional_usd,
    trade_count, unique_tickers, active_desks,
    CAST(l - s AS DOUBLE) AS net_exposure_usd, CAST(l + s AS DOUBLE) AS gross_exposure_usd,
    CAST(ROUND(TRY_CAST(CASE WHEN s > 0 THEN CAST(l AS DOUBLE) / CAST(s AS DOUBLE) END AS DECIMAL(38,10)), 4) AS DOUBLE)
      AS long_short_ratio
  FROM sector_x
)"""

COUNTERPARTY = """
cp_x AS (
  SELECT counterparty_id, counterparty_name, risk_rating, counterparty_type, cp_country,
    SUM(CAST(CASE WHEN side = 'BUY' THEN notional_usd ELSE 0 END AS DECIMAL(18,2))) AS l,
    SUM(CAST(CASE WHEN side = 'SELL' THEN notional_usd ELSE 0 END AS DECIMAL(18,2))) AS s,
    COUNT(trade_id) AS trade_count, COUNT(DISTINCT ticker) AS unique_tickers, COUNT(DISTINCT desk) AS active_desks,
    CAST(SUM(CAST(notional_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(notional_usd) AS avg_trade_size_usd,
    MAX(event_time) AS last_trade_time
  FROM enriched GROUP BY counterparty_id, counterparty_name, risk_rating, counterparty_type, cp_country
),
cp_exposure AS (
  SELECT counterparty_id, counterparty_name, risk_rating, counterparty_type, cp_country,
    CAST(l AS DOUBLE) AS long_notional_usd, CAST(s AS DOUBLE) AS short_notional_usd,
    trade_count, unique_tickers, active_desks, avg_trade_size_usd, last_trade_time,
    CAST(l - s AS DOUBLE) AS net_exposure_usd, CAST(l + s AS DOUBLE) AS gross_exposure_usd
  FROM cp_x
)"""

HOURLY = """
hourly AS (
  SELECT date_trunc('hour', event_time) AS trade_hour, desk, sector,
    COUNT(trade_id) AS trade_count,
    CAST(SUM(CAST(notional_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_notional_usd,
    CAST(SUM(CAST(price AS DECIMAL(20,6))) AS DOUBLE) / COUNT(price) AS avg_price,
    CAST(SUM(quantity) AS BIGINT) AS total_quantity
  FROM enriched GROUP BY 1, 2, 3
)"""

MTM = """
mtm_x AS (
  SELECT p.*, lp.last_price, lp.bid, lp.ask, lp.mid_price, lp.spread_bps, lp.event_time AS price_as_of,
    ROUND(CAST(p.net_quantity AS DECIMAL(38,0)) * CAST(lp.last_price AS DECIMAL(38,6)), 2) AS mv
  FROM positions p LEFT JOIN latest lp ON p.ticker = lp.ticker
),
mtm AS (
  SELECT ticker, desk, sector, asset_class, position_side, net_quantity, avg_price, last_price, mid_price,
    bid, ask, spread_bps, net_notional_usd,
    CAST(mv AS DOUBLE) AS market_value_usd,
    CAST(ROUND(mv - CAST(net_notional_usd AS DECIMAL(38,2)), 2) AS DOUBLE) AS unrealized_pnl_usd,
    CAST(ROUND(TRY_CAST(CASE WHEN abs(net_notional_usd) > 0
         THEN CAST(ROUND(mv - CAST(net_notional_usd AS DECIMAL(38,2)), 2) AS DOUBLE) / abs(net_notional_usd) * 100
         ELSE 0.0 END AS DECIMAL(38,10)), 2) AS DOUBLE) AS pnl_pct,
    gross_notional_usd, trade_count, last_trade_time, price_as_of
  FROM mtm_x
)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


TRADE_CHAIN = (RAW_TRADES, DEDUP, CLEAN, DIMS, ENRICHED)

SCD2_BASE = """
ch AS (
  SELECT o_custkey AS customer_id, o_orderdate AS updated_at, max(o_orderpriority) AS priority
  FROM orders GROUP BY o_custkey, o_orderdate
)"""

SCD2_TRACKED = SCD2_BASE + """,
ch_prev AS (
  SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY updated_at) AS prev_priority,
         ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at) AS rn
  FROM ch
),
kept AS (SELECT * FROM ch_prev WHERE rn = 1 OR prev_priority IS DISTINCT FROM priority),
hist AS (
  SELECT customer_id, priority, updated_at AS __START_AT,
         lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS __END_AT
  FROM kept
)"""

_T = TRADE_CHAIN
_TICK = (TICKS,)

ORACLE: dict[str, str] = {
    "source_counts": """
SELECT 'region' AS table_name, count(*) AS row_count FROM region
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'embeddings', count(*) FROM embeddings
UNION ALL SELECT 'pages', count(*) FROM pages
UNION ALL SELECT 'benchmark', count(*) FROM benchmark
UNION ALL SELECT 'labels', count(*) FROM labels
UNION ALL SELECT 'conversations', count(*) FROM conversations""",
    "parse_event_time": with_ctes(RAW_TRADES, DEDUP, select="""
SELECT trade_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp", event_time,
       CAST(event_time AS DATE) AS trade_date, CAST(hour(event_time) AS INTEGER) AS trade_hour
FROM dedup"""),
    "dedup_trades": with_ctes(RAW_TRADES, DEDUP, select="""
SELECT trade_id, ticker, side, quantity, price, order_type, trader_id, desk, counterparty_id, exchange, currency,
       asset_class, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp", _dq_flag, event_time FROM dedup"""),
    "dq_drop_trades": with_ctes(RAW_TRADES, DEDUP, CLEAN, select="""
SELECT trade_id, ticker, side, quantity, price, order_type, trader_id, desk, counterparty_id, exchange, currency,
       asset_class, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp", _dq_flag, event_time FROM clean"""),
    "dq_drop_ticks": with_ctes(*_TICK, select="""
SELECT tick_id, ticker, bid, ask, last_price, spread, tick_volume, cumulative_volume, high_52w, low_52w, exchange,
       asset_class, "timestamp", event_time, mid_price, spread_bps FROM ticks"""),
    "dq_warn_trades": with_ctes(RAW_TRADES, DEDUP, select="""
SELECT 'enriched_trades' AS dataset, r.rule, r.failed_records FROM (
  SELECT
    CAST(SUM(CASE WHEN COALESCE(side IN ('BUY', 'SELL'), FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS valid_side,
    CAST(SUM(CASE WHEN trader_id IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS valid_trader,
    CAST(SUM(CASE WHEN counterparty_id IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS valid_counterparty,
    CAST(SUM(CASE WHEN COALESCE(event_time IS NOT NULL AND event_time < TIMESTAMP '2028-01-01', FALSE)
             THEN 0 ELSE 1 END) AS BIGINT) AS valid_timestamp
  FROM dedup) UNPIVOT (failed_records FOR rule IN (valid_side, valid_trader, valid_counterparty, valid_timestamp)) r"""),
    "dq_warn_ticks": with_ctes(*_TICK, select="""
SELECT 'enriched_market_data' AS dataset, 'bid_less_than_ask' AS rule,
       CAST(SUM(CASE WHEN COALESCE(bid <= ask, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed_records
FROM derived_ticks"""),
    "dq_report": with_ctes(RAW_TRADES, DEDUP, *_TICK, select="""
SELECT dataset, rule, action, CAST(n - failed AS BIGINT) AS passed_records, CAST(failed AS BIGINT) AS failed_records FROM (
  SELECT 'enriched_trades' AS dataset, u.rule, u.action, CAST(SUM(CASE WHEN u.ok THEN 0 ELSE 1 END) AS BIGINT) AS failed,
         (SELECT count(*) FROM dedup) AS n
  FROM dedup, LATERAL (VALUES
    ('valid_trade_id', 'drop', trade_id IS NOT NULL),
    ('valid_ticker', 'drop', ticker IS NOT NULL),
    ('valid_price', 'drop', COALESCE(price > 0, FALSE)),
    ('valid_quantity', 'drop', COALESCE(quantity > 0, FALSE)),
    ('valid_side', 'warn', COALESCE(side IN ('BUY', 'SELL'), FALSE)),
    ('valid_trader', 'warn', trader_id IS NOT NULL),
    ('valid_counterparty', 'warn', counterparty_id IS NOT NULL),
    ('valid_timestamp', 'warn', COALESCE(event_time IS NOT NULL AND event_time < TIMESTAMP '2028-01-01', FALSE))
  ) u(rule, action, ok) GROUP BY u.rule, u.action
  UNION ALL
  SELECT 'enriched_market_data', u.rule, u.action, CAST(SUM(CASE WHEN u.ok THEN 0 ELSE 1 END) AS BIGINT),
         (SELECT count(*) FROM derived_ticks)
  FROM derived_ticks, LATERAL (VALUES
    ('valid_tick_id', 'drop', tick_id IS NOT NULL),
    ('valid_md_ticker', 'drop', ticker IS NOT NULL),
    ('valid_bid', 'drop', COALESCE(bid > 0, FALSE)),
    ('valid_ask', 'drop', COALESCE(ask > 0, FALSE)),
    ('bid_less_than_ask', 'warn', COALESCE(bid <= ask, FALSE))
  ) u(rule, action, ok) GROUP BY u.rule, u.action) y"""),
    "enriched_trades": with_ctes(*_T, select="SELECT * FROM enriched"),
    "enriched_market_data": with_ctes(*_TICK, select="""
SELECT tick_id, ticker, bid, ask, last_price, spread, tick_volume, cumulative_volume, high_52w, low_52w, exchange,
       asset_class, "timestamp", event_time, mid_price, spread_bps FROM ticks"""),
    "latest_market_prices": with_ctes(*_TICK, LATEST, select="SELECT * FROM latest"),
    "positions": with_ctes(*_T, POSITIONS, select="SELECT * FROM positions"),
    "desk_pnl": with_ctes(*_T, DESK_PNL, select="SELECT * FROM desk_pnl"),
    "risk_exposure_by_sector": with_ctes(*_T, SECTOR, select="SELECT * FROM sector_exposure"),
    "counterparty_exposure": with_ctes(*_T, COUNTERPARTY, select="SELECT * FROM cp_exposure"),
    "ticker_stats": with_ctes(*_T, STATS, select="SELECT ticker, avg_qty, stddev_qty, avg_price FROM stats"),
    "anomaly_quantity": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT trade_id, ticker, quantity, avg_qty FROM anomalies WHERE is_qty_anomaly"""),
    "anomaly_price": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT trade_id, ticker, price, avg_price, price_deviation_pct FROM anomalies WHERE is_price_anomaly"""),
    "anomaly_risk_limit": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT trade_id, trader_id, notional_usd, risk_limit_usd FROM anomalies WHERE is_risk_breach"""),
    "trade_anomalies": with_ctes(*_T, STATS, FLAGGED, select="SELECT * FROM anomalies"),
    "hourly_trade_volume": with_ctes(*_T, HOURLY, select="SELECT * FROM hourly"),
    "mark_to_market_pnl": with_ctes(*_T, POSITIONS, *_TICK, LATEST, MTM, select="SELECT * FROM mtm"),
    "scd2_history": with_ctes(SCD2_BASE, select="""
SELECT customer_id, priority, updated_at AS __START_AT,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS __END_AT
FROM ch"""),
    "scd2_history_tracked": with_ctes(SCD2_TRACKED, select="SELECT * FROM hist"),
    "scd2_current": with_ctes(SCD2_TRACKED, select="SELECT * FROM hist WHERE __END_AT IS NULL"),
    "stream_enriched_trades": with_ctes(*_T, select="SELECT * FROM enriched"),
    "enriched_trades_scd2": with_ctes(*_T, select="SELECT * FROM enriched"),
    "stream_market_data": with_ctes(TICKS.replace("ts AS event_time",
                                                  "CAST(strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS TIMESTAMP) AS event_time"),
                                    select="""
SELECT tick_id, ticker, bid, ask, last_price, spread, tick_volume, cumulative_volume, high_52w, low_52w, exchange,
       asset_class, "timestamp", event_time, mid_price, spread_bps FROM ticks"""),
    "stream_scd2_history": with_ctes(SCD2_TRACKED, select="SELECT * FROM hist"),
    "stream_scd2_history_bucketed": with_ctes(SCD2_TRACKED, select="SELECT * FROM hist"),
    "incremental_desk_pnl": with_ctes(*_T, DESK_PNL, select="SELECT * FROM desk_pnl"),
    "incremental_mark_to_market_pnl": with_ctes(*_T, POSITIONS, *_TICK, LATEST, MTM, select="SELECT * FROM mtm"),
    "incremental_trade_anomalies": with_ctes(*_T, STATS, FLAGGED, select="SELECT * FROM anomalies"),
    "live_mark_to_market_pnl": with_ctes(*_T, POSITIONS, *_TICK, LATEST, MTM, select="SELECT * FROM mtm"),
    "stream_dedup_within": with_ctes(RAW_TRADES, select="""
SELECT trade_id, count(DISTINCT trade_id) AS copies FROM raw_trades GROUP BY trade_id"""),
    "dash_cards": with_ctes(*_T, DESK_PNL, POSITIONS, *_TICK, LATEST, MTM, select="""
SELECT (SELECT CAST(SUM(trade_count) AS BIGINT) FROM desk_pnl) AS total_trades,
       (SELECT CAST(SUM(CAST(gross_volume_usd AS DECIMAL(38,2))) AS DOUBLE) FROM desk_pnl) AS total_volume_usd,
       (SELECT CAST(SUM(CAST(net_pnl_usd AS DECIMAL(38,2))) AS DOUBLE) FROM desk_pnl) AS net_pnl_usd,
       (SELECT CAST(SUM(CAST(unrealized_pnl_usd AS DECIMAL(38,2))) AS DOUBLE) FROM mtm) AS unrealized_pnl_usd"""),
    "dash_pnl_by_desk": with_ctes(*_T, DESK_PNL, select="""
SELECT desk, CAST(SUM(CAST(net_pnl_usd AS DECIMAL(38,2))) AS DOUBLE) AS net_pnl_usd,
       CAST(SUM(trade_count) AS BIGINT) AS trade_count FROM desk_pnl GROUP BY desk"""),
    "dash_volume_by_sector": with_ctes(*_T, SECTOR, select="""
SELECT sector, CAST(SUM(CAST(gross_exposure_usd AS DECIMAL(38,2))) AS DOUBLE) AS gross_volume_usd,
       CAST(SUM(trade_count) AS BIGINT) AS trade_count FROM sector_exposure GROUP BY sector"""),
    "dash_volume_over_time": with_ctes(*_T, HOURLY, select="""
SELECT trade_hour, CAST(SUM(trade_count) AS BIGINT) AS trade_count,
       CAST(SUM(CAST(total_notional_usd AS DECIMAL(38,2))) AS DOUBLE) AS total_notional_usd,
       CAST(SUM(total_quantity) AS BIGINT) AS total_quantity FROM hourly GROUP BY trade_hour"""),
    "dash_anomaly_counts": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT count(*) AS anomaly_count, CAST(count_if(is_qty_anomaly) AS BIGINT) AS qty_anomalies,
       CAST(count_if(is_price_anomaly) AS BIGINT) AS price_anomalies,
       CAST(count_if(is_risk_breach) AS BIGINT) AS risk_breaches
FROM anomalies"""),
    "dash_exposure": with_ctes(*_T, SECTOR, select="""
SELECT sector, CAST(l - s AS DOUBLE) AS net_exposure_usd, CAST(l AS DOUBLE) AS long_notional_usd,
       CAST(s AS DOUBLE) AS short_notional_usd,
       CAST(ROUND(TRY_CAST(CASE WHEN s > 0 THEN CAST(l AS DOUBLE) / CAST(s AS DOUBLE) END AS DECIMAL(38,10)), 4) AS DOUBLE)
         AS long_short_ratio
FROM (SELECT sector, SUM(CAST(long_notional_usd AS DECIMAL(38,2))) AS l,
             SUM(CAST(short_notional_usd AS DECIMAL(38,2))) AS s FROM sector_exposure GROUP BY sector)"""),
    "dash_anomaly_detail": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT trade_id, ticker, desk, trader_name, quantity, price, notional_usd, is_qty_anomaly, is_price_anomaly,
       is_risk_breach, price_deviation_pct, event_time FROM anomalies"""),
    "dash_risk_breaches": with_ctes(*_T, STATS, FLAGGED, select="""
SELECT trade_id, trader_id, trader_name, desk, notional_usd, risk_limit_usd,
       notional_usd - CAST(risk_limit_usd AS DOUBLE) AS excess_usd, event_time
FROM anomalies WHERE is_risk_breach"""),
    "dash_unrealized": with_ctes(*_T, POSITIONS, *_TICK, LATEST, MTM, select="""
SELECT 'desk' AS dimension, desk AS name, CAST(SUM(CAST(unrealized_pnl_usd AS DECIMAL(38,2))) AS DOUBLE) AS unrealized_pnl_usd
FROM mtm GROUP BY desk
UNION ALL
SELECT 'sector', sector, CAST(SUM(CAST(unrealized_pnl_usd AS DECIMAL(38,2))) AS DOUBLE) FROM mtm GROUP BY sector"""),
    "dash_positions": with_ctes(*_T, POSITIONS, *_TICK, LATEST, MTM, select="""
SELECT ticker, desk, sector, position_side, net_quantity, avg_price, last_price,
       CAST(ROUND(TRY_CAST(CASE WHEN avg_price <> 0 THEN (last_price - avg_price) / avg_price * 100 END
                           AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_change_pct,
       market_value_usd, unrealized_pnl_usd, pnl_pct FROM mtm"""),
}

ORACLE["live_dq_report"] = ORACLE["dq_report"]
ORACLE["csv_reference"] = with_ctes(DIMS, select="""
SELECT 'instruments' AS kind, 'PT-' || p_partkey AS id, p_name AS name, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       CAST(0 AS BIGINT) AS empty_fields, TRUE AS stamped FROM part
UNION ALL SELECT 'traders', trader_id, trader_name, CAST(risk_limit_usd AS DOUBLE), 1, TRUE FROM traders
UNION ALL SELECT 'counterparties', counterparty_id, counterparty_name, NULL, 2, TRUE FROM counterparties""")
ORACLE["lineage_columns"] = with_ctes(*_T, *_TICK, STATS, FLAGGED, DESK_PNL, select="""
SELECT 'raw_trades' AS table_name, count(*) AS rows, count(*) AS with_file, count(*) AS stamped FROM raw_trades
UNION ALL SELECT 'raw_market_data', count(*), count(*), count(*) FROM raw_ticks
UNION ALL SELECT 'enriched_trades', count(*), 0, count(*) FROM enriched
UNION ALL SELECT 'desk_pnl', count(*), 0, count(*) FROM desk_pnl
UNION ALL SELECT 'trade_anomalies', count(*), 0, count(*) FROM anomalies""")
