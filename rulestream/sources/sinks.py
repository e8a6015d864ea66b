"""Sinks (S3, S4): alerts and acknowledgements as JSON text.

``value`` holds one JSON document per row, the shape a message bus expects.
The format is a parameter: files (json/text/parquet) here; 'kafka' works the
same way when its connector is on the classpath (``topic`` option).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rulestream.operators.alerts import alerts_to_json
from rulestream.operators.control import acks_to_json


def write_json_batch(values: DataFrame, path: str, fmt: str = "text", mode: str = "append",
                     options: dict | None = None) -> None:
    w = values.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path) if path else w.save()


def write_alerts(alerts: DataFrame, path: str, fmt: str = "text", source: str | None = None, **kw) -> None:
    """S3 (batch): alert rows -> JSON documents."""
    js = alerts_to_json(alerts) if source is None else alerts_to_json(alerts, source)
    write_json_batch(js, path, fmt, **kw)


def write_acks(acks: DataFrame, path: str, fmt: str = "text", **kw) -> None:
    """S4 (batch): acknowledgement rows -> JSON documents."""
    write_json_batch(acks_to_json(acks), path, fmt, **kw)


def write_batch_acks(acks: DataFrame, path: str, batch_id: int, fmt: str = "text") -> None:
    """S4 (stream): the acks of a micro-batch in the batch's own folder, so that a replayed batch writes them once."""
    write_json_batch(acks_to_json(acks), f"{path}/batch_id={batch_id}", fmt, mode="overwrite")


def stream_json(values: DataFrame, path: str | None, checkpoint: str, fmt: str = "text",
                options: dict | None = None, trigger: dict | None = None):
    """Start a streaming JSON sink (exactly-once for file sinks via the checkpoint)."""
    w = values.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if path:
        w = w.option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
