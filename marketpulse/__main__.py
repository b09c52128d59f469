"""Command line: run the pipeline over landing folders.

python -m marketpulse --root OUT --trades DIR --ticks DIR --reference DIR [--mode continuous]

``--reference`` holds instruments.csv, traders.csv and counterparties.csv
(typed CSV with a header); ``--reference-jdbc`` reads the tables of the same names
from a database instead. ``--input-bytes`` and ``--cores`` size shuffles and scans.
"""

from __future__ import annotations

import argparse

from .session import get_session, scale_conf
from .sources.reference import read_reference_csv, read_reference_jdbc
from .streaming.live import LivePaths, Reference, load_reference, run_pipeline


def reference_table(spark, a, kind: str):
    if a.reference:
        return read_reference_csv(spark, f"{a.reference}/{kind}.csv", kind)
    options = dict(o.split("=", 1) for o in a.jdbc_option)
    return read_reference_jdbc(spark, a.reference_jdbc, f"{a.jdbc_schema}.{kind}", **options)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="marketpulse")
    ap.add_argument("--root", required=True, help="output folder (tables, logs, checkpoints)")
    ap.add_argument("--trades", required=True, help="landing folder of trade JSON-lines files")
    ap.add_argument("--ticks", required=True, help="landing folder of tick JSON-lines files")
    ref = ap.add_mutually_exclusive_group(required=True)
    ref.add_argument("--reference", help="folder with the reference CSV files")
    ref.add_argument("--reference-jdbc", help="JDBC address of the database with the reference tables")
    ap.add_argument("--jdbc-schema", default="source")
    ap.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE",
                    help="a Spark JDBC option such as driver, user or password (repeatable)")
    ap.add_argument("--input-bytes", type=int, default=None, help="bytes one refresh reads, to size partitions")
    ap.add_argument("--cores", type=int, default=None, help="executor cores, with --input-bytes")
    ap.add_argument("--mode", choices=["triggered", "continuous"], default="triggered")
    ap.add_argument("--refresh-seconds", type=float, default=60.0)
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    ap.add_argument("--dedup-within", default=None,
                    help="bound the trade dedup state, e.g. '7 days' (default: exact, unbounded)")
    ap.add_argument("--full-refresh", action="store_true",
                    help="recompute gold from all silver rows instead of folding in new batches")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    sizes = scale_conf(a.input_bytes, a.cores or 8) if a.input_bytes else None
    spark = get_session(a.master, extra=sizes)
    paths = LivePaths(a.root)

    def reload() -> Reference:
        return Reference(*(reference_table(spark, a, k) for k in ("instruments", "traders", "counterparties")))
    load_reference(spark, paths, reload())
    run_pipeline(spark, paths, a.trades, a.ticks, mode=a.mode, refresh_seconds=a.refresh_seconds,
                 max_files_per_trigger=a.max_files_per_trigger, dedup_within=a.dedup_within,
                 incremental=not a.full_refresh, reload=reload)


if __name__ == "__main__":
    main()
