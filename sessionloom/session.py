"""Spark session settings the library relies on, and its shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def require_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: instants and wall-clock values then share one calendar."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Settings under which a run plans its joins. A hash join takes the place of a sort-merge join
#: where AQE has measured that every partition of the hashed side is small; a larger one is sorted, and can spill.
#: A join keeps both sides as ``skew.Deal`` has dealt them out, though it has more keys than those.
#: Staged and target tables are written as Zstandard: hexadecimal ids take half the bytes.
RUN_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


#: While a table is staged, Python is given batches of so many rows and about so many bytes at most, and Parquet is
#: read in batches of so many rows: with whole texts in them, batches of the usual 10,000 and 4,096 rows take a task
#: tens of megabytes, outside the heap on both sides and in arrays that a heap of regions grows for.
PUT_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "256k",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}

_held: dict[str, list] = {}
_holding = threading.Lock()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Change session settings for a while; afterwards the caller's are back.

    Several threads may hold settings of one session at a time: the first remembers the
    caller's values and the last one restores them.
    """
    names = {k: f"{spark._jsparkSession.sessionUUID()}/{k}" for k in values}
    with _holding:
        for k, v in values.items():
            held = _held.setdefault(names[k], [0, spark.conf.get(k, None)])
            held[0] += 1
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _holding:
            for k in values:
                held = _held[names[k]]
                held[0] -= 1
                if not held[0]:
                    del _held[names[k]]
                    spark.conf.unset(k) if held[1] is None else spark.conf.set(k, held[1])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder;
    a cluster has to name a folder that every executor can reach.
    """
    root, local = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master.startswith("local")
    if root and (local or not root.startswith("file:")):
        return root.rstrip("/")
    if local:
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="sessionloom-")


class Staging:
    """Intermediate tables of one run, written as Parquet below the shared folder.

    A staged table cuts lineage and survives lost executors. Read back, it prunes
    columns, pushes filters down and has a known size, so that the planner's own
    broadcast decisions rest on real bytes. What is not released before is released when the
    process ends with its session alive: a lazy result may read staged tables until then.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/sessionloom/{label}-{uuid.uuid4().hex}"
        _unreleased[self.path] = self

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        schema = df.schema
        with settings(self.spark, PUT_SETTINGS):
            df.write.mode("overwrite").parquet(self.folder(name))
        return self.spark.read.schema(schema).parquet(self.folder(name))

    def release(self) -> None:
        """Delete this run's staged tables."""
        _unreleased.pop(self.path, None)
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


_unreleased: dict[str, Staging] = {}


@atexit.register
def _release_all() -> None:
    for stage in list(_unreleased.values()):
        if stage.spark.sparkContext._jsc is None:  # the session has ended
            return
        try:
            stage.release()
        except Exception:  # the process ends all the same
            return
