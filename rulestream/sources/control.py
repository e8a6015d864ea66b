"""Control source (S2): JSON control messages -> control frame.

Columns: seq (arrival order), timestamp, type, rule_id, rule_version,
schema_version, content.  Numbers arrive as text or numbers (lenient
coercion); a message that is not a JSON object, or whose type is not one of
the three control types, cannot be decoded and is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rulestream.session import ensure_checkpoint_dir
from rulestream.schemas import CONTROL_JSON, CONTROL_TYPES


def parse_control(df: DataFrame, value_col: str = "value", seq_col: str | None = None) -> DataFrame:
    """Without ``seq_col`` a batch is numbered in reading order; a stream keeps
    its ``src`` (place in the source), and ``number_batch`` numbers each
    micro-batch by it."""
    # exploded, or the filter below would go before this step with its own copies of all that makes and reads a message
    c = F.explode_outer(F.array(F.from_json(F.col(value_col), CONTROL_JSON)))
    out = df.select(c.alias("c"), *([F.col(seq_col).cast("bigint").alias("seq")] if seq_col else []),
                    *(["src"] if df.isStreaming and not seq_col else []))
    if not seq_col:
        out = out.withColumnRenamed("src", "seq") if df.isStreaming else out.withColumn("seq", F.monotonically_increasing_id())
    out = out.where(F.col("c.type").isin(*CONTROL_TYPES))
    return out.select(
        "seq", F.col("c.timestamp").alias("timestamp"), F.col("c.type").alias("type"),
        F.col("c.ruleId").alias("rule_id"),
        F.coalesce(F.col("c.ruleVersion").try_cast("int"), F.lit(0)).alias("rule_version"),
        F.coalesce(F.col("c.controlSchemaVersion").try_cast("int"), F.lit(0)).alias("schema_version"),
        F.col("c.content").alias("content"))


BATCH_BITS = 32


def number_batch(batch: DataFrame, batch_id: int) -> DataFrame:
    """A micro-batch of parsed messages with ``seq`` = batch_id * 2^32, + 1, ... in arrival order.

    Order: place in the source (file time and name, or partition and offset),
    then the line within the file.  Messages are range-partitioned by it;
    each partition's first number is the count of the messages before it, so
    no task holds more than its partition.
    """
    ensure_checkpoint_dir(batch.sparkSession)
    lines = batch.withColumn("_line", F.monotonically_increasing_id()).orderBy("seq", "_line")
    lines = lines.drop("seq", "_line").withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright("_at", 33)
    sizes = lines.groupBy(part.alias("_p")).agg(F.count("*").alias("n")).withColumn(
        "_before", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = F.lit(batch_id << BATCH_BITS).cast("bigint") + F.col("_before")
    number = first + F.col("_at").bitwiseAND((1 << 33) - 1)
    numbered = lines.withColumn("_p", part).join(sizes.select("_p", "_before"), "_p")  # one row per partition
    return numbered.select(number.alias("seq"), *[c for c in batch.columns if c != "seq"])


def control_from_messages(spark: SparkSession, messages: list[str]) -> DataFrame:
    """Control messages (JSON text) in arrival order, e.g. from a log file."""
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "seq bigint, value string")
    return parse_control(df, seq_col="seq")


def read_control_stream(spark: SparkSession, path: str, fmt: str = "text", options: dict | None = None):
    """S2 as a stream (text files; 'kafka' when its connector is present)."""
    reader = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        src = F.struct(F.col("partition").cast("bigint").alias("a"), F.lit("").alias("b"), F.col("offset").alias("c"))
    else:
        src = F.struct(F.unix_micros("_metadata.file_modification_time").alias("a"), F.col("_metadata.file_path").alias("b"),
                       F.col("_metadata.file_block_start").alias("c"))
    return parse_control(raw.select(F.col("value").cast("string").alias("value"), src.alias("src")))
