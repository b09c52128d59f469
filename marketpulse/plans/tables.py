"""SNK-2, SNK-3: recomputed tables as versioned Parquet directories.

A refresh writes ``<root>/<table>/v=<n>/`` next to the previous versions and
never over a path being read. The Parquet committer writes ``_SUCCESS`` last,
so the live version is simply the highest one carrying it: a crash in the
middle of a write leaves an incomplete directory that readers ignore.
Files are listed through the Hadoop FileSystem, so the same code runs on a
shared cluster store.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableInfo:
    layer: str
    comment: str


# Table names and their layers.
_LAYERS = {
    "raw_trades": "bronze",
    "raw_market_data": "bronze",
    "raw_instruments": "bronze",
    "raw_traders": "bronze",
    "raw_counterparties": "bronze",
    "scd2_traders": "silver",
    "scd2_counterparties": "silver",
    "enriched_trades": "silver",
    "enriched_market_data": "silver",
    "latest_market_prices": "silver",
    "positions": "silver",
    "desk_pnl": "gold",
    "risk_exposure_by_sector": "gold",
    "counterparty_exposure": "gold",
    "trade_anomalies": "gold",
    "hourly_trade_volume": "gold",
    "mark_to_market_pnl": "gold",
}

_COMMENTS = {
    "raw_trades": "Every trade line as it landed, with its file and load time",
    "raw_market_data": "Every tick line as it landed, with its file and load time",
    "raw_instruments": "The latest load of tradable instruments",
    "raw_traders": "All loads of trader rows, one after the other",
    "raw_counterparties": "All loads of counterparty rows, one after the other",
    "scd2_traders": "Versions of each trader with their validity",
    "scd2_counterparties": "Versions of each counterparty with their validity",
    "enriched_trades": "One row per accepted trade id, joined with what was current when it was processed",
    "enriched_market_data": "Accepted ticks with mid price and spread in basis points",
    "latest_market_prices": "The newest accepted tick of each ticker",
    "positions": "Signed quantity and notional by ticker, desk, sector and asset class",
    "desk_pnl": "Sales minus purchases and activity figures by desk",
    "risk_exposure_by_sector": "Long, short, net and gross notional by sector and asset class",
    "counterparty_exposure": "Long, short, net and gross notional by counterparty",
    "trade_anomalies": "Trades out of line with their ticker's quantity or price, or over the trader's limit",
    "hourly_trade_volume": "Trades, notional and mean price by hour, desk and sector",
    "mark_to_market_pnl": "Positions valued at the latest price",
}

REGISTRY: dict[str, TableInfo] = {n: TableInfo(layer, _COMMENTS[n]) for n, layer in _LAYERS.items()}


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    def table_dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def committed(self, root: str, prefix: str) -> list[int]:
        """The numbers n of the folders ``<root>/<prefix><n>`` whose write has committed, ascending."""
        fs, p = self._fs(root), self._Path(root)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        numbers = [n[len(prefix):] for n in names if n.startswith(prefix)]
        return sorted(int(n) for n in numbers if n.isdigit() and fs.exists(self._Path(f"{root}/{prefix}{n}/_SUCCESS")))

    def versions(self, name: str) -> list[int]:
        """Committed versions, ascending."""
        return self.committed(self.table_dir(name), "v=")

    def current_path(self, name: str) -> str | None:
        vs = self.versions(name)
        return f"{self.table_dir(name)}/v={vs[-1]}" if vs else None

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        d = self.table_dir(name)
        fs = self._fs(d)
        taken = [0]
        if fs.exists(self._Path(d)):
            for st in fs.listStatus(self._Path(d)):
                n = st.getPath().getName()
                if n.startswith("v=") and n[2:].isdigit():
                    taken.append(int(n[2:]))
        path = f"{d}/v={max(taken) + 1}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def read(self, name: str) -> DataFrame:
        p = self.current_path(name)
        if p is None:
            raise FileNotFoundError(f"table {name} has no committed version under {self.root}")
        return self.spark.read.parquet(p)

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def tables(self) -> list[str]:
        p = self._Path(self.root)
        fs = self._fs(self.root)
        return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()) if fs.exists(p) else []

    def vacuum(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` committed versions."""
        vs = self.versions(name)
        for v in vs[:-keep] if keep else vs:
            p = self._Path(f"{self.table_dir(name)}/v={v}")
            self._fs(str(p)).delete(p, True)


def publish(spark: SparkSession, store: TableStore, names: list[str] | None = None) -> list[str]:
    """SNK-3: expose the live version of each table in the session catalog as
    ``<layer>.<name>`` (schemas bronze / silver / gold), with its comment and
    a ``quality`` table property. A table that is already there is moved to the
    newest committed version by one catalog change, so readers always find it."""
    done = []
    for name in names or list(REGISTRY):
        info, path = REGISTRY[name], store.current_path(name)
        if path is None:
            continue
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {info.layer}")
        full = f"{info.layer}.{name}"
        same = spark.catalog.tableExists(full) and spark.table(full).schema == spark.read.parquet(path).schema
        if same:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
            spark.catalog.refreshTable(full)
        else:   # new, or its columns changed
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}' "
                      f"COMMENT '{_quoted(info.comment)}' TBLPROPERTIES ('quality' = '{info.layer}')")
        done.append(full)
    return done


def _quoted(text: str) -> str:
    return text.replace("'", "\\'")


def publish_folders(spark: SparkSession, folders: dict[str, list[str]], hide: str | None = None) -> list[str]:
    """SNK-3 for stream tables: a view over the committed folders of each table, without
    rows whose column ``hide`` is true. Replacing a view is one catalog change."""
    done = []
    for name, paths in folders.items():
        if not paths:
            continue
        info = REGISTRY[name]
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {info.layer}")
        columns = [c for c in spark.read.parquet(paths[0]).columns if c not in ("batch_id", hide)]
        picked = ", ".join(f"`{c}`" for c in columns)
        only = f" WHERE NOT `{hide}`" if hide else ""
        body = " UNION ALL ".join(f"SELECT {picked} FROM parquet.`{p}`{only}" for p in paths)
        if spark.catalog.tableExists(f"{info.layer}.{name}") and spark.catalog.getTable(f"{info.layer}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {info.layer}.{name}")   # a full refresh stored it as a table
        spark.sql(f"CREATE OR REPLACE VIEW {info.layer}.{name} COMMENT '{_quoted(info.comment)}' "
                  f"TBLPROPERTIES ('quality' = '{info.layer}') AS {body}")
        done.append(f"{info.layer}.{name}")
    return done


BUCKET = "__bucket"
VERSION = "__version"


class BucketedVersions:
    """A table split into key-hash buckets, each bucket versioned on its own.

    A write of version ``n`` holds only the buckets it changes
    (``<root>/__version=<n>/__bucket=<b>/``); the live table is, per bucket, the
    newest committed version. Reading "as of before n" ignores version ``n``
    and later, so a replayed write of ``n`` sees exactly what the first
    attempt saw."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def bucket_of(self, keys: list[str]):
        from pyspark.sql import functions as F
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.buckets)).cast("int")

    def _fs(self):
        return self._Path(self.root).getFileSystem(self._conf)

    def paths(self, before: int | None = None, buckets: list[int] | None = None) -> dict[int, str]:
        """bucket → folder of its newest committed version (older than ``before``)."""
        fs = self._fs()
        root = self._Path(self.root)
        if not fs.exists(root):
            return {}
        versions = []
        for st in fs.listStatus(root):
            n = st.getPath().getName()
            if n.startswith(VERSION + "=") and n.split("=", 1)[1].isdigit() and \
                    fs.exists(self._Path(f"{self.root}/{n}/_SUCCESS")):
                v = int(n.split("=", 1)[1])
                if before is None or v < before:
                    versions.append(v)
        want = set(buckets) if buckets is not None else None
        out: dict[int, str] = {}
        for v in sorted(versions, reverse=True):
            for st in fs.listStatus(self._Path(f"{self.root}/{VERSION}={v}")):
                n = st.getPath().getName()
                if n.startswith(f"{BUCKET}="):
                    b = int(n.split("=", 1)[1])
                    if b not in out and (want is None or b in want):
                        out[b] = f"{self.root}/{VERSION}={v}/{n}"
        return out

    def read(self, before: int | None = None, buckets: list[int] | None = None,
             schema=None) -> DataFrame | None:
        ps = self.paths(before, buckets)
        if not ps:
            return None
        r = self.spark.read.option("basePath", self.root)
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(*ps.values()).drop(BUCKET, VERSION)   # one scan over the live buckets

    def write(self, df: DataFrame, version: int) -> None:
        """``df`` carries the bucket column; only its buckets are replaced."""
        df.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{VERSION}={version}")

    def write_parts(self, parts: Iterable[DataFrame], version: int) -> None:
        """``write`` of frames with different buckets one after the other: readers see the version when all are there."""
        open_, done = f"{self.root}/_open={version}", f"{self.root}/{VERSION}={version}"
        fs = self._fs()
        fs.delete(self._Path(open_), True)   # what a crash has left
        for df in parts:
            df.write.mode("append").partitionBy(BUCKET).parquet(open_)
        fs.delete(self._Path(done), True)
        if not fs.rename(self._Path(open_), self._Path(done)):
            raise OSError(f"could not move {open_} to {done}")

    def vacuum(self, before: int | None = None) -> list[int]:
        """Delete versions that no bucket reads any more (all their buckets
        rewritten later); ``before`` keeps newer versions for in-flight readers."""
        live = {int(p.split(f"{VERSION}=", 1)[1].split("/", 1)[0]) for p in self.paths().values()}
        fs = self._fs()
        root = self._Path(self.root)
        gone = []
        if not fs.exists(root):
            return gone
        for st in fs.listStatus(root):
            n = st.getPath().getName()
            if n.startswith(VERSION + "=") and n.split("=", 1)[1].isdigit():
                v = int(n.split("=", 1)[1])
                if v not in live and (before is None or v < before):
                    fs.delete(st.getPath(), True)
                    gone.append(v)
        return sorted(gone)
