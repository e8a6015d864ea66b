"""Event builders shared by the engine tests."""
import datetime as dt
import json

from rulestream.sources.events import parse_events

START_MS = 1550754000000  # 2019-02-21T13:00:00.000Z


def iso(ms: int) -> str:
    d = dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)
    return d.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


def make_events(spark, specs, customer="CustomerOne"):
    """specs: list of (t_seconds, {field: value}) in arrival order."""
    rows = []
    for i, (t, f) in enumerate(specs):
        d = {"@timestamp": iso(START_MS + int(t * 1000))}
        if customer is not None and "customer" not in f:
            d["customer"] = customer
        d.update(f)
        rows.append((i, json.dumps(d)))
    df = spark.createDataFrame(rows, "seq bigint, content string")
    return parse_events(df, seq_col="seq", on_bad_ts="drop")
