"""The driver contract on the smallest driver tables, checked against DuckDB."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_compare import compare, duck

FAST = ["source_counts", "enriched_trades", "dq_report", "positions", "desk_pnl",
        "risk_exposure_by_sector", "counterparty_exposure", "trade_anomalies",
        "hourly_trade_volume", "mark_to_market_pnl", "latest_market_prices",
        "scd2_history_tracked", "dash_cards", "dash_unrealized"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "net_pnl_usd" in df.columns


def test_every_query_has_an_oracle():
    own = set(entry_mod.queries()) - set(entry_mod.TEXT_QUERIES)
    assert own == set(entry_mod.oracle_sql()) - set(entry_mod.TEXT_ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name])
    assert r["names_match"] and not r["type_issues"], r
    assert r["spark_rows"] == r["oracle_rows"] and r["hash_match"], r


def test_refresh_all_matches_queries(spark, tmp_dir):
    from marketpulse.plans.pipeline import driver_inputs, refresh_all
    from marketpulse.plans.tables import TableStore
    st = TableStore(spark, f"{tmp_dir}/tables")
    refresh_all(st, driver_inputs(spark, SF_SMALL), stamps=False)
    want = entry_mod.queries()["desk_pnl"](spark, SF_SMALL)
    got = st.read("desk_pnl").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert st.read("mark_to_market_pnl").count() == entry_mod.queries()["mark_to_market_pnl"](
        spark, SF_SMALL).count()


@pytest.mark.parametrize("name", ["enriched_trades", "trade_anomalies", "mark_to_market_pnl"])
def test_shuffle_join_path_matches_oracle(spark, con, name):
    """The at-scale plan: no dimension is broadcast (every lookup is a shuffle
    join with NULL-key salting); results must not change."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry_mod.queries()[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        r = compare(spark, con, SF_SMALL, name, lambda s, d: df, entry_mod.oracle_sql()[name])
        assert r["spark_rows"] == r["oracle_rows"] and r["hash_match"], r
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
