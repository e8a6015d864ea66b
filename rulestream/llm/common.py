"""Small helpers shared by the operators: table access, checkpoints, internal column names, Arrow batches."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it lies at the driver's path; on a cluster ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([x for x in (root, env.get("PYTHONPATH", "")) if x])
    return spark


def checkpoint_ready(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only where it is unset (tests) a temporary folder takes its place."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="llm-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut its lineage."""
    checkpoint_ready(df.sparkSession)
    return df.checkpoint(eager=True)


def crc32_mod(col: Column, n: int) -> Column:
    """crc32 of the value's text, modulo ``n``; null ids count as remainder -1 (in no fold)."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % n, F.lit(-1))


def slices(n: int, sizes: np.ndarray, budget: int):
    """Ranges of consecutive rows whose sizes sum to at most ``budget`` (one row at least)."""
    start, total = 0, 0
    for i in range(n):
        if i > start and total + sizes[i] > budget:
            yield start, i
            start, total = i, 0
        total += int(sizes[i])
    if start < n:
        yield start, n


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64, count=col.offset + len(col) + 1)[col.offset:]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Full-avalanche mixing of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def batches(it, names, types, make):
    """Run ``make(batch) -> list of columns`` on every Arrow batch and yield record batches."""
    schema = pa.schema(list(zip(names, types)))
    for batch in it:
        if batch.num_rows:
            cols = make(batch)
            yield pa.record_batch([pa.array(c, type=t) if not isinstance(c, pa.Array) else c for c, t in zip(cols, types)], schema=schema)
