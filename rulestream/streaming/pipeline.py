"""Structured Streaming pipeline: event stream -> alerts (and control -> acks).

    events (file / kafka stream) -> parse -> watermark (10 s)
      -> match: compiled rule set, or an equi-join with a guard index re-read every
         micro-batch from a snapshot (rules change without a restart)
      -> SINGLE_EVENT: stateless projection
      -> windowed blocks: transformWithState(BlockStateProcessor), event time
      -> simple rules: alerts; complex rules: transformWithState(RuleWindowProcessor)

Dynamic rules: ``write_rule_snapshot`` writes an immutable snapshot of the
rules' guard index and then swaps a pointer file; ``snapshot_rule_side`` is a
one-partition ``mapInPandas`` source that Spark re-executes for every
micro-batch, so the next batch joins against the new rules.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.operators import blocks as B
from rulestream.operators.alerts import simple_alerts
from rulestream.operators.guards import guard_index
from rulestream.operators.match import (MAX_BROADCAST_BLOCKS, MAX_INLINE_BLOCKS, match_compiled, match_dynamic,
                                        match_indexed, match_streamed)
from rulestream.operators.rules import rule_blocks
from rulestream.schemas import WATERMARK_DELAY
from rulestream.streaming.processors import (ALERT_OUT_SCHEMA, BLOCK_OUT_SCHEMA, BlockStateProcessor,
                                             RuleWindowProcessor)

KEY = ["customer", "rule_id", "group_by", "block_index"]
WINDOWED = ["THRESHOLD", "UNIQUE_THRESHOLD", "SIMPLE_ANOMALY", "DROP_TO_ZERO"]

# flat, string-only snapshot form of the rule blocks (pandas-friendly)
_SNAP_SCHEMA = ("gk string, gv string, rule_id string, rule_version int, base_severity int, group_by_field string, "
                "rule_window_size bigint, rule_window_slide bigint, n_blocks int, rule_type string, "
                "block_index int, block_type string, cond_json string, window_size bigint, "
                "window_slide bigint, agg_json string, threshold int, unique_field string, anomaly_threshold int, "
                "program string")


def with_event_time(events: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event-time column + bounded out-of-orderness watermark."""
    return events.withColumn("event_ts", F.timestamp_millis("event_ms")).withWatermark("event_ts", delay)


def stream_block_results(matched: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Matched stream (with ``event_ts`` watermark) -> block-result stream.

    ``types`` are the block types of a fixed rule set: the stateful branch
    (a shuffle and a state-store commit per micro-batch) is planned only
    when windowed blocks exist.  With rules as data (``None``) both are.
    """
    if "program" not in matched.columns:
        matched = matched.withColumn("program", F.lit(None).cast("string"))
    single = B.single_event(matched).withColumn("emit_ts", F.timestamp_millis("emit_ms"))
    if types is not None and not any(t in WINDOWED for t in types):
        return single
    windowed = (matched.where(F.col("block_type").isin(*WINDOWED))
                .groupBy(*KEY)
                .transformWithState(BlockStateProcessor(), BLOCK_OUT_SCHEMA, "Append", "EventTime",
                                    eventTimeColumnName="emit_ts"))
    if types is not None and "SINGLE_EVENT" not in types:
        return windowed
    return single.unionByName(windowed)


def stream_alerts(events: DataFrame, rule_set=None, rule_side: DataFrame | None = None,
                  programs: dict | None = None, delay: str = WATERMARK_DELAY, broadcast_rules: bool = True) -> DataFrame:
    """Event stream -> alert stream (rows of ``operators.alerts``).

    Give either ``rule_set`` (a ``plans.batch.RuleSet``: compiled matching)
    or ``rule_side`` (e.g. ``snapshot_rule_side``: rules as data, re-read
    every micro-batch).  A snapshot's rows carry their rule's condition
    program through matching and state, so multi-block rules may be added or
    replaced while the query runs.  ``programs`` = {(rule_id, version): program}
    serves fixed rule sets.  ``broadcast_rules=False`` shuffles a rule side
    too large to broadcast.
    """
    ev = with_event_time(events, delay)
    if rule_set is not None and rule_set.blocks is None:
        # too many rules to compile: joined, and their programs ride on the matches
        matched = match_dynamic(ev, rule_set.index)
        rule_set, types = None, rule_set.facts["types"]
    elif rule_set is not None:
        types = rule_set.facts["types"]
        if len(rule_set.blocks) > MAX_INLINE_BLOCKS:
            # stream-static broadcast join with the guard index; the
            # watermark node sits below it, so every event advances time
            matched = match_indexed(ev, rule_set.frame, rule_set.blocks)
        else:
            matched = match_compiled(ev, rule_set.blocks)
        if programs is None:
            programs = {(r["rule_id"], r["rule_version"]): r["rule_program"]
                        for r in rule_set.frame.select("rule_id", "rule_version", "rule_program").collect()
                        if r["rule_program"] is not None}
    else:
        matched, types = match_streamed(ev, rule_side, broadcast_rules), None
    blocks = stream_block_results(matched, types)
    alerts = simple_alerts(blocks)
    if programs or rule_set is None:
        complex_alerts = (blocks.where(F.col("rule_type") == "COMPLEX")
                          .groupBy("customer", "rule_id", "group_by")
                          .transformWithState(RuleWindowProcessor(dict(programs or {})), ALERT_OUT_SCHEMA,
                                              "Append", "EventTime"))
        alerts = alerts.unionByName(complex_alerts)
    return alerts


# ---------------------------------------------------------------------------
# dynamic rule side
# ---------------------------------------------------------------------------

def write_rule_snapshot(rules: DataFrame, snapshot_dir: str, limit: int | None = MAX_BROADCAST_BLOCKS) -> str:
    """Write an immutable snapshot of the rules' guard index, then swap the pointer.

    ``snapshot_dir`` must be storage every executor can read (the shared
    folder of the deployment); the pointer swap is an atomic rename.  More
    than ``limit`` rows, the most that the alert query may broadcast, are not
    published; a query with ``broadcast_rules=False`` takes any number
    (``limit=None``).
    """
    name = f"snap-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(snapshot_dir, name)
    index = guard_index(rule_blocks(rules, program=True)).select(
        "gk", "gv", "rule_id", "rule_version", "base_severity", "group_by_field", "rule_window_size", "rule_window_slide",
        "n_blocks", "rule_type", "block_index", "block_type", F.to_json("cond").alias("cond_json"),
        "window_size", "window_slide", F.to_json("agg_fields").alias("agg_json"), "threshold",
        "unique_field", "anomaly_threshold", "program")
    index.write.mode("errorifexists").parquet(path)
    n = rules.sparkSession.read.parquet(path).count()
    if limit is not None and n > limit:
        raise ValueError(f"the rule snapshot has {n} rows, over {limit}: start the job with broadcast_rules=False")
    tmp = os.path.join(snapshot_dir, f".CURRENT.{uuid.uuid4().hex}")
    with open(tmp, "w") as f:
        f.write(name)
    os.replace(tmp, os.path.join(snapshot_dir, "CURRENT"))
    return path


def snapshot_rule_side(spark: SparkSession, snapshot_dir: str) -> DataFrame:
    """The guard index of the current snapshot, re-read at every micro-batch.

    Exactly one partition (``range(0, 1, 1, 1)``): two partitions would load
    the snapshot twice and double every match.
    """
    def load(batches):
        import pyarrow.parquet as pq
        for _ in batches:
            pointer = os.path.join(snapshot_dir, "CURRENT")
            if not os.path.exists(pointer):
                continue
            with open(pointer) as f:
                name = f.read().strip()
            for part in pq.ParquetDataset(os.path.join(snapshot_dir, name)).fragments:
                yield part.to_table().to_pandas()

    raw = spark.range(0, 1, 1, 1).mapInPandas(load, _SNAP_SCHEMA)
    from rulestream.schemas import COND_PROGRAM
    return raw.select("*", F.from_json("cond_json", COND_PROGRAM).alias("cond"),
                      F.from_json("agg_json", "array<string>").alias("agg_fields")).drop("cond_json", "agg_json")


def rule_programs(rules: DataFrame) -> dict:
    """{(rule_id, version): rule-condition program} of a (small) rules frame."""
    return {(r["rule_id"], r["rule_version"]): r["rule_program"]
            for r in rules.select("rule_id", "rule_version", "rule_program").collect()
            if r["rule_program"] is not None}
