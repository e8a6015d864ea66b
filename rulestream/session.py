"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the benchmark.  On a cluster the session comes
from the platform, and only settings that are still unset are filled in.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on.  Session time zone UTC makes every
# epoch-ms <-> text conversion match the ISO-8601 'Z' format of the alerts.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rulestream", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used by the library)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.driver.memory", os.environ.get("RULESTREAM_DRIVER_MEM", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to shared storage and we only read it.
    Only when it is unset (local tests) do we create a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = tempfile.mkdtemp(prefix="rulestream-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
