import datetime as dt
from decimal import Decimal

import pytest

from marketpulse.plans.joins import lookup_join
from marketpulse.schemas import TRADE_RAW
from marketpulse.sources.counts import table_counts
from marketpulse.sources.files import read_trades
from marketpulse.sources.reference import (historical_as_raw, jdbc_options,
                                           read_reference_csv, with_backfill)


def _pairs(df):
    return sorted(((r.k, r.name) for r in df.collect()), key=str)


def test_lookup_join_paths_agree(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "dk string, name string")
    small = lookup_join(fact, dim, "k", "dk")
    shuffled = lookup_join(fact, dim.hint("merge"), "k", "dk")
    assert _pairs(small) == _pairs(shuffled) == sorted(
        [("a", "A"), ("b", "B"), (None, None), ("z", None), (None, None)], key=str)
    assert "dk" not in small.columns and not [c for c in shuffled.columns if c.startswith("__")]


def test_json_permissive_lines(spark, tmp_dir):
    p = f"{tmp_dir}/t.json"
    with open(p, "w") as f:
        f.write('{"trade_id": "T-1", "ticker": "A", "quantity": 5, "price": 1.5}\n')
        f.write('{this is not json\n')
        f.write('{"trade_id": "T-3", "quantity": "lots", "price": 2.0}\n')
    rows = {r.trade_id: r for r in read_trades(spark, p).collect()}
    assert rows["T-1"].quantity == 5 and rows["T-3"].quantity is None
    assert rows[None].price is None                     # the malformed line
    assert "_source_file" in read_trades(spark, p).columns


def test_reference_csv_empty_is_null(spark, tmp_dir):
    p = f"{tmp_dir}/traders.csv"
    with open(p, "w") as f:
        f.write("trader_id,trader_name,desk,desk_full_name,risk_limit_usd,manager,location\n")
        f.write("TR-1,Ann,EQ,Equities Trading,5000000,Sam,New York\n")
        f.write("TR-2,Sam,EQ,Equities Trading,10000000,,New York\n")
    rows = {r.trader_id: r for r in read_reference_csv(spark, p, "traders").collect()}
    assert rows["TR-2"].manager is None and rows["TR-1"].risk_limit_usd == Decimal("5000000.00")


def test_jdbc_options():
    o = jdbc_options("jdbc:x", "source.t", partition_column="trade_date", lower_bound="2024-01-01",
                     upper_bound="2024-12-31", num_partitions=16, user="u")
    assert o["numPartitions"] == "16" and o["partitionColumn"] == "trade_date" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_backfill_union(spark):
    hist = spark.createDataFrame(
        [("T-9", "A", "BUY", 3, Decimal("12.50"), "SETTLED", dt.datetime(2024, 1, 2, 3, 4, 5))],
        "trade_id string, ticker string, side string, quantity int, price decimal(12,2), "
        "trade_status string, timestamp timestamp_ntz")
    raw = spark.createDataFrame([], TRADE_RAW)
    out = with_backfill(raw, hist).collect()
    assert out[0].price == 12.5 and out[0].timestamp == "2024-01-02T03:04:05.000Z"
    assert historical_as_raw(hist).schema == TRADE_RAW


def test_table_counts(spark):
    out = table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted((r.table_name, r.row_count) for r in out.collect()) == [("a", 3), ("b", 0)]


def test_lookup_join_shuffle_path_numeric_and_multi_key(spark):
    fact = spark.createDataFrame([(1, 10, "a"), (None, 10, "b"), (2, None, "c"), (2, 20, "d")],
                                 "k1 bigint, k2 int, tag string")
    dim = spark.createDataFrame([(1, 10, "X"), (2, 20, "Y"), (0, 0, "Z")], "d1 bigint, d2 int, name string")
    got = lookup_join(fact, dim, ["k1", "k2"], ["d1", "d2"])
    assert sorted((r.tag, r.name) for r in got.collect()) == [("a", "X"), ("b", None), ("c", None), ("d", "Y")]
    assert got.columns == ["k1", "k2", "tag", "name"]


def test_scale_conf():
    from marketpulse.session import scale_conf
    big = scale_conf(100 * 2 ** 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 * 2 ** 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_command_line_reads_a_database_and_sizes_the_session(monkeypatch):
    import marketpulse.__main__ as cli
    seen = {}
    monkeypatch.setattr(cli, "get_session", lambda master, extra=None: seen.setdefault("conf", extra))
    monkeypatch.setattr(cli, "read_reference_jdbc", lambda spark, url, table, **o: seen.setdefault("reads", []).append((url, table, o)))
    monkeypatch.setattr(cli, "load_reference", lambda spark, paths, ref: None)
    monkeypatch.setattr(cli, "run_pipeline", lambda *args, **kw: None)
    cli.main(["--root", "o", "--trades", "t", "--ticks", "k", "--reference-jdbc", "jdbc:x", "--jdbc-option", "user=u",
              "--input-bytes", str(100 * 2 ** 40), "--cores", "8000"])
    assert seen["conf"]["spark.sql.shuffle.partitions"] == "409600"
    assert seen["reads"] == [("jdbc:x", f"source.{k}", {"user": "u"}) for k in ("instruments", "traders", "counterparties")]
