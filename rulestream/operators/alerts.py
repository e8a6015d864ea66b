"""Alert formation (O1-O5) and alert JSON (S3).

Alert rows:
    customer, rule_id, rule_version, base_severity, group_by, match_ms,
    window_start_ms, window_end_ms, seen ARRAY<INT>,
    outputs MAP<STRING, STRUCT<match_ms, match_message, matching_events>>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.functions.windows import ms_to_text
from rulestream.schemas import OUTPUT_TIME_FORMAT

ALERT_COLUMNS = ["customer", "rule_id", "rule_version", "base_severity", "group_by", "match_ms",
                 "window_start_ms", "window_end_ms", "seen", "outputs"]

# Value of the alert 'source' field; consumers that expect another name set it.
DEFAULT_SOURCE = "rulestream"


def simple_alerts(blocks: DataFrame) -> DataFrame:
    """Each block result of a single-block rule is an alert."""
    s = blocks.where(F.col("rule_type") == "SIMPLE")
    out = F.struct("match_ms", "match_message", F.coalesce(
        "matching_events", F.array().cast("array<struct<key:string,sample:string,count:bigint>>")
    ).alias("matching_events"))
    return s.select(
        "customer", "rule_id", "rule_version", "base_severity", "group_by", "match_ms",
        "window_start_ms", "window_end_ms", F.array("block_index").alias("seen"),
        F.create_map(F.col("block_index").cast("string"), out).alias("outputs"))


def _json_text(text):
    """A string as a JSON string: an array of it without its brackets (those in the text are within its quotes)."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


def _open(obj):
    """A JSON object of texts and numbers without its closing brace."""
    return F.rtrim(obj, F.lit("}"))


def _member(name: str, text):
    """``,"name":"text"``, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f',"{name}":'), _json_text(text)), F.lit(""))


def _block_outputs_json(outputs):
    """The map of block outputs as one JSON object."""
    def event(e):
        sample = F.coalesce(F.when(F.try_parse_json(e["sample"]).isNotNull(), e["sample"]).otherwise(_json_text(e["sample"])), F.lit("null"))
        key = F.coalesce(F.concat(F.lit('"key":'), _json_text(e["key"]), F.lit(",")), F.lit(""))
        return F.concat(F.lit("{"), key, F.lit('"sampleEventContent":'), sample, F.lit(',"count":'),
                        e["count"].cast("int").cast("string"), F.lit("}"))

    def entry(o):
        v = o["value"]
        events = F.array_join(F.transform(v["matching_events"], event), ",")
        return F.concat(_json_text(o["key"]), F.lit(':{"matchTime":'), _json_text(ms_to_text(v["match_ms"])),
                        _member("matchMessage", v["match_message"]), F.lit(',"matchingEvents":['), events, F.lit("]}"))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(outputs), entry), ","), F.lit("}"))


def alerts_to_json(alerts: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Alert rows -> one JSON text per alert (column ``value``).

    Sample events are spliced in as they are stored, so their numbers and key
    order survive; a sample that is not strict JSON is emitted as a string.
    the group-by value becomes an extra top-level field when it splits into
    exactly two parts on '=' (trailing empty parts dropped, as Java's split).
    """
    now = F.date_format(F.current_timestamp(), OUTPUT_TIME_FORMAT)
    body = F.concat(
        _open(F.to_json(F.struct(
            now.alias("@timestamp"), ms_to_text(F.col("match_ms")).alias("matchTime"),
            F.lit(source).alias("source"), F.col("rule_id").alias("matchedRuleId"),
            F.col("rule_version").alias("matchedRuleVersion"), F.col("customer"),
            F.col("base_severity").alias("baseSeverity")))),
        F.lit(',"blockOutput":'), _block_outputs_json(F.col("outputs")),
        _member("groupBy", F.col("group_by")))
    parts = F.split(F.regexp_replace(F.coalesce("group_by", F.lit("")), "=+$", ""), "=", -1)
    ok = (F.coalesce(F.col("group_by"), F.lit("")) != "") & (F.size(parts) == 2)
    # every part is written once: an expression over the whole text would write it again
    extra = F.when(ok, F.concat(F.lit(","), F.expr("substring(__x, 2)"))).otherwise(F.lit("}"))
    return (alerts.withColumn("__x", F.when(ok, F.to_json(F.create_map(parts[0], parts[1]))))
            .select(F.concat(body, extra).alias("value")))


def flat_alerts(alerts: DataFrame) -> DataFrame:
    """Comparable flat form: one row per alert, JSON-free."""
    return alerts.select("rule_id", "customer", "group_by", "rule_version", "base_severity",
                         "match_ms", "window_start_ms", "window_end_ms",
                         F.array_join(F.col("seen").cast("array<string>"), ",").alias("blocks"))
