"""The streaming job (S6): options, control stream and event stream wiring.

    control stream --foreachBatch--> numbered messages of the batch
                     + rules active before it -> fold
                       -> acks, rules active after it, closed history, rule snapshot
    event stream   --> match against the current snapshot (re-read every
                       micro-batch) -> blocks -> alerts sink

A control batch reads its own messages and the rules active after the batch
before it; the log is never read again.  Everything a batch writes (its
messages, acks, active rules, history) goes to folders named by its id and
replaces what is there, so a replayed batch, after a restart or a lost
executor, has no effect twice.  Folders of active rules older than the
previous batch's are dropped.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.operators.control import ACTIVE, active_at, fold_messages, rules_from_history
from rulestream.operators.match import MAX_BROADCAST_BLOCKS
from rulestream.sources.control import number_batch, read_control_stream
from rulestream.sources.events import read_event_stream
from rulestream.sources.sinks import stream_json, write_batch_acks
from rulestream.streaming.pipeline import snapshot_rule_side, stream_alerts, write_rule_snapshot
from rulestream.operators.alerts import alerts_to_json


@dataclass
class JobOptions:
    """Job parameters (names follow the topics of a message-bus deployment)."""
    source_format: str = "text"            # 'kafka' when the connector is available
    source_options: dict = field(default_factory=dict)
    input_path: str = "input-stream"        # input topic / folder
    control_path: str = "control-stream"
    output_path: str = "output-stream"
    control_output_path: str = "control-output-stream"
    state_dir: str = "rulestream-state"     # shared storage: control log, snapshots, checkpoints
    watermark_delay: str = "10 seconds"
    alert_source: str | None = None
    broadcast_rules: bool = True            # False: rule sets of any size, joined by a shuffle


KEEP_STATES = 2


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the complete ``batch_id=`` folders of ``path``."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    done = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("batch_id=")]
    hp = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(x.getName().split("=")[1]) for x in done if fs.exists(hp(x, "_SUCCESS")))


def _control_batch(spark: SparkSession, opts: JobOptions):
    snap_dir = os.path.join(opts.state_dir, "snapshots")
    os.makedirs(snap_dir, exist_ok=True)
    folder = lambda what, n: f"{opts.state_dir}/{what}/batch_id={n}"

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = [n for n in _batches(spark, f"{opts.state_dir}/active-rules") if n < batch_id]
        active = spark.read.schema(ACTIVE).parquet(folder("active-rules", before[-1])) if before else None
        number_batch(batch, batch_id).write.mode("overwrite").parquet(folder("control-log", batch_id))
        messages = spark.read.schema(batch.withColumn("seq", F.lit(0).cast("bigint")).schema).parquet(folder("control-log", batch_id))
        acks, hist = fold_messages(messages, active)
        write_batch_acks(acks, opts.control_output_path, batch_id)
        hist.where(F.col("valid_to_seq").isNotNull()).write.mode("overwrite").parquet(folder("rule-history", batch_id))
        now = active_at(hist)
        write_rule_snapshot(rules_from_history(now), snap_dir, MAX_BROADCAST_BLOCKS if opts.broadcast_rules else None)
        now.select(*[c.split()[0] for c in ACTIVE.split(", ")]).write.mode("overwrite").parquet(folder("active-rules", batch_id))
        for n in before[:-KEEP_STATES + 1]:
            fs, p = _file_system(spark, folder("active-rules", n))
            fs.delete(p, True)
    return handle


def start(spark: SparkSession, opts: JobOptions):
    """Start the control query and the alert query; returns both handles."""
    ck = os.path.join(opts.state_dir, "checkpoints")
    control = read_control_stream(spark, opts.control_path, opts.source_format, opts.source_options)
    control_q = (control.writeStream.foreachBatch(_control_batch(spark, opts))
                 .option("checkpointLocation", os.path.join(ck, "control")).start())
    events = read_event_stream(spark, opts.input_path, opts.source_format, opts.source_options)
    snap_dir = os.path.join(opts.state_dir, "snapshots")
    side = snapshot_rule_side(spark, snap_dir)
    alerts = stream_alerts(events, rule_side=side, delay=opts.watermark_delay, broadcast_rules=opts.broadcast_rules)
    values = alerts_to_json(alerts) if opts.alert_source is None else alerts_to_json(alerts, opts.alert_source)
    alert_q = stream_json(values, opts.output_path, os.path.join(ck, "alerts"))
    return control_q, alert_q
