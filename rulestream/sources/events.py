"""Event sources (S1, S5, S7) and event parsing.

The canonical event frame has the columns

    content STRING            raw JSON text of the event (kept for samples)
    fields  MAP<STRING,STRING> top-level keys -> text of the value
    event_ms BIGINT           event time, epoch ms
    customer STRING           value of the 'customer' field ('' if missing)
    arrival_seq BIGINT        arrival order (ties on event time)

Everything is a Spark expression: one ``from_json`` per event, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.schemas import CUSTOMER_FIELD, TIMESTAMP_FIELD

EVENT_COLUMNS = ["content", "fields", "event_ms", "customer", "arrival_seq"]

# ISO-8601 instant with a 'Z' designator (what Instant.parse accepts).
_ISO_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?Z$"


def field(fields: Column, name) -> Column:
    """Text of a top-level field, '' when missing."""
    key = F.lit(name) if isinstance(name, str) else name
    return F.coalesce(fields[key], F.lit(""))


def event_time_ms(fields: Column, on_bad_ts: str = "now") -> Column:
    """P3: '@timestamp' (ISO instant) -> epoch ms; unparsable -> processing time
    (reference behaviour) or NULL when ``on_bad_ts='drop'``."""
    raw = fields[F.lit(TIMESTAMP_FIELD)]
    ok = raw.rlike(_ISO_INSTANT)
    ts = F.when(ok, F.try_to_timestamp(raw))
    ms = F.unix_millis(ts)
    if on_bad_ts == "drop":
        return ms
    return F.coalesce(ms, F.unix_millis(F.current_timestamp()))


def parse_events(df: DataFrame, content_col: str = "content", seq_col: str | None = None,
                 on_bad_ts: str = "now") -> DataFrame:
    """JSON text -> canonical event frame.  Bad JSON (or a JSON array)
    gives a NULL map and the event is dropped, as the reference logs and
    skips it."""
    fields = F.from_json(F.col(content_col), "map<string,string>")
    out = df.select(F.col(content_col).cast("string").alias("content"), fields.alias("fields"),
                    *( [F.col(seq_col).cast("bigint").alias("arrival_seq")] if seq_col else []))
    out = out.where(F.col("fields").isNotNull())
    if not seq_col:
        # batch: position in the input; stream: a content hash breaks ties
        # between equal event times deterministically (ids are not allowed)
        seq = F.xxhash64("content") if df.isStreaming else F.monotonically_increasing_id()
        out = out.withColumn("arrival_seq", seq)
    out = out.withColumn("event_ms", event_time_ms(F.col("fields"), on_bad_ts))
    if on_bad_ts == "drop":
        out = out.where(F.col("event_ms").isNotNull())
    return out.select("content", "fields", "event_ms",
                      field(F.col("fields"), CUSTOMER_FIELD).alias("customer"), "arrival_seq")


def table_events(events: DataFrame) -> DataFrame:
    """The driver's ``events`` table as an event source.

    customer = user_id % 5, and the fields user, type, value, k (props.k),
    plus event_id.  Arrival order is (event time, event_id).  The JSON text is
    a projection of the row, so Catalyst computes it only for rows that
    survive the match filter.
    """
    ts = F.col("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    customer = F.pmod(F.col("user_id"), F.lit(5)).cast("string")
    user = F.col("user_id").cast("string")
    k = F.get_json_object(F.col("props"), "$.k")
    value = F.col("value").cast("string")
    fields = F.create_map(
        F.lit(TIMESTAMP_FIELD), iso, F.lit(CUSTOMER_FIELD), customer,
        F.lit("event_id"), F.col("event_id").cast("string"), F.lit("user"), user,
        F.lit("type"), F.col("event_type"), F.lit("value"), value, F.lit("k"), k)
    content = F.to_json(F.struct(iso.alias(TIMESTAMP_FIELD), customer.alias(CUSTOMER_FIELD),
                                 F.col("event_id"), user.alias("user"), F.col("event_type").alias("type"),
                                 F.col("value"), k.cast("bigint").alias("k")))
    return events.select(
        content.alias("content"), fields.alias("fields"),
        F.floor(F.unix_micros(ts) / F.lit(1000)).cast("bigint").alias("event_ms"),
        customer.alias("customer"), F.col("event_id").cast("bigint").alias("arrival_seq"))


def read_events_table(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    return table_events(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def alerts_as_events(alert_json: DataFrame, col: str = "value") -> DataFrame:
    """Serialised alerts are valid events (feedback loops)."""
    return parse_events(alert_json, content_col=col)


def read_event_stream(spark: SparkSession, path: str, fmt: str = "text",
                      options: dict | None = None, value_col: str = "value") -> DataFrame:
    """A streaming event source.  ``fmt`` is any streaming format whose
    rows carry the JSON text in ``value_col`` ('text' files; 'kafka' when its
    connector is on the classpath, with value cast to string)."""
    reader = spark.readStream.format(fmt)
    for k2, v in (options or {}).items():
        reader = reader.option(k2, v)
    raw = reader.load(path) if path else reader.load()
    raw = raw.select(F.col(value_col).cast("string").alias("value"))
    return parse_events(raw, content_col="value")
