"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. UTC matters: the event-time pattern carries a
# quoted 'Z' literal, so text is read in the session time zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The trade dedup keeps one state entry per trade id for the life of the
    # stream: RocksDB holds it off-heap and checkpoints only changed keys.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "marketpulse",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: pin runtime settings.
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


_CKPT_LOCK = threading.Lock()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``. Where it is unset, a local master gets
    a fresh scratch folder; on a cluster that folder would be another one on
    each machine, so the setting is asked for instead.
    """
    with _CKPT_LOCK:
        d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if d:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(d)
            return d
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[(\*|\d+)(,\s*\d+)?\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        d = tempfile.mkdtemp(prefix="marketpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
        return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    return os.path.join(checkpoint_dir(spark), name)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROP_LOCK = threading.Lock()
_dropping: dict[int, list] = {}   # session -> [how many blocks are open, the setting before the first]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes and streams started inside leave no shuffle files behind: each goes when its action ends. Otherwise
    all of a job's shuffles stay on disk until the driver happens to collect its garbage. A frame to be used later
    is made outside: if its own action had dropped its files, a second one would run its stages again."""
    key = id(spark)
    with _DROP_LOCK:
        held = _dropping.setdefault(key, [0, spark.conf.get(_DROP_SHUFFLES, None)])
        held[0] += 1
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _DROP_LOCK:
            held[0] -= 1
            if not held[0]:
                del _dropping[key]
                if held[1] is None:
                    spark.conf.unset(_DROP_SHUFFLES)
                else:
                    spark.conf.set(_DROP_SHUFFLES, held[1])


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Steps:
    """Rows stored between the steps of a long plan, each step's in place of the one before: a step's shuffles
    and the rows it reads are gone before the next begins, so the disk holds one step at a time."""

    def __init__(self, spark: SparkSession, columns: list[str] | None = None):
        self.spark, self.columns = spark, columns
        self.root, self.done = scratch_path(spark, f"steps-{uuid.uuid4().hex}"), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.columns is not None:   # others are not read by what follows
            df = df.select(*[c for c in df.columns if c in self.columns])
        path = f"{self.root}/{self.done + 1}"
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        drop_folder(self.spark, f"{self.root}/{self.done}")
        self.done += 1
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """The last step's rows have been written elsewhere."""
        drop_folder(self.spark, self.root)


# Target bytes per task for scans and shuffles on a cluster.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes`` on
    ``total_cores`` executor cores.

    AQE starts from enough shuffle partitions for ~256 MB each (at least two
    waves of tasks) and coalesces small ones at run time; scans split files
    at the same size. At 100 TB this gives ~400k initial shuffle partitions,
    so no task holds more than a few hundred MB before spilling."""
    parts = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }
