"""What the engine sets aside, as rows instead of log lines.

Alerts never depend on these frames: the operators skip a record they cannot
use, and the functions here say which and why, from the same expressions.

    place       'event' | 'control' | 'match'
    seq         arrival order of the record
    rule_id, rule_version, block_index   of the block, for 'match'
    reason      what was wrong
    record      the text as it came

All are narrow projections of their input (no shuffle, no collect), so they
can be written beside the main output in one pass of a micro-batch.  NULL
records are rejected with a reason; an empty frame gives no rows; repeated
records give a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.functions.conditions import compile_condition
from rulestream.operators.match import event_takes_part
from rulestream.schemas import CONTROL_JSON, CONTROL_TYPES
from rulestream.sources.events import event_time_ms

REJECT_COLUMNS = ["place", "seq", "rule_id", "rule_version", "block_index", "reason", "record"]


def _rows(df: DataFrame, place: str, seq: str, reason: Column, record: Column) -> DataFrame:
    none = lambda t: F.lit(None).cast(t)
    return df.select(F.lit(place).alias("place"), F.col(seq).cast("bigint").alias("seq"), none("string").alias("rule_id"),
                     none("int").alias("rule_version"), none("int").alias("block_index"), reason.alias("reason"),
                     record.cast("string").alias("record")).where(F.col("reason").isNotNull())


def event_rejects(df: DataFrame, content_col: str = "content", seq_col: str = "seq", on_bad_ts: str = "now") -> DataFrame:
    """The records that ``parse_events`` drops (times count only where bad ones are dropped)."""
    fields = F.from_json(F.col(content_col), "map<string,string>")
    reason = F.when(F.col(content_col).isNull(), "no text").when(fields.isNull(), "not a JSON object")
    if on_bad_ts == "drop":
        reason = reason.when(event_time_ms(fields, "drop").isNull(), "no usable @timestamp")
    return _rows(df, "event", seq_col, reason, F.col(content_col))


def control_rejects(df: DataFrame, value_col: str = "value", seq_col: str = "seq") -> DataFrame:
    """The messages that ``parse_control`` drops; those it keeps are answered, errors included, by an ack."""
    c, is_object = F.from_json(F.col(value_col), CONTROL_JSON), F.from_json(F.col(value_col), "map<string,string>").isNotNull()
    reason = (F.when(F.col(value_col).isNull(), "no text").when(~is_object, "not a JSON object").when(c["type"].isNull(), "no control type")
              .when(~c["type"].isin(*CONTROL_TYPES), F.concat(F.lit("there is no control type "), c["type"])))
    return _rows(df, "control", seq_col, reason, F.col(value_col))


def match_rejects(events: DataFrame, blocks: list[dict]) -> DataFrame:
    """(event, block) pairs whose condition could not be evaluated: the block skips the event, others go on.

    ``blocks``: a collected rule set (``RuleSet.blocks``).  One pass over the
    events; only the pairs in error become rows.
    """
    field = lambda k: F.col("fields")[F.lit(k)]
    entries = []
    for b in blocks:
        failed = event_takes_part(b) & compile_condition(b["cond"] or [], field, errors=True).isNull()
        entries.append(F.when(failed, F.struct(F.lit(b["rule_id"]).cast("string").alias("rule_id"), F.lit(b["rule_version"]).cast("int").alias("rule_version"),
                                               F.lit(b["block_index"]).cast("int").alias("block_index"))))
    if not entries:
        return _rows(events, "match", "arrival_seq", F.lit(None).cast("string"), F.col("content"))
    pairs = events.select("arrival_seq", "content", F.explode(F.array_compact(F.array(*entries))).alias("b"))
    return pairs.select(F.lit("match").alias("place"), F.col("arrival_seq").alias("seq"), "b.rule_id", "b.rule_version", "b.block_index",
                        F.lit("the condition cannot be evaluated").alias("reason"), F.col("content").alias("record"))
