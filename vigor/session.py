"""Spark session builder and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that every job relies on: ANSI semantics (bad casts and 1/0 raise,
# so the library uses try_* explicitly), AQE with partition coalescing and
# skew-join splitting, UTC so that timestamp -> date casts are stable.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Spark's switch for deleting the shuffle files of a query when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vigor", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    tests use ``local[*]`` and 8 shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only invent one in local mode (tests), never on a
    cluster, where a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
    path = tempfile.mkdtemp(prefix="vigor-ckpt-", dir=os.environ.get("VIGOR_LOCAL_TMP", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files when they end.

    Otherwise the files stay until the driver's garbage collector drops the plan, so that a run of several
    stages holds the shuffles of all of them at once.  A frame that is run again shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def save(df: DataFrame, path: str, mode: str = "error", partition_by: list[str] | None = None, **options: str) -> None:
    """Write ``df`` to a folder of parquet files (zstd); its shuffle files go when it is written."""
    w = df.write.mode(mode).options(**{"compression": "zstd", **options})
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)
