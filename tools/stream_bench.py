"""Streaming throughput: the events table as a JSON file stream through the alert query.

usage: python tools/stream_bench.py SF_DIR SCRATCH_DIR [rule_set ...]

The events table is written once as JSON text files (ordered by event time,
ten files) under SCRATCH_DIR; each rule set of the catalogue then runs as a
Structured Streaming query (one file per micro-batch, availableNow trigger,
noop sink) and the wall time gives events per second.  Prints one JSON line.
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rulestream.plans import catalog  # noqa: E402
from rulestream.session import local_session  # noqa: E402
from rulestream.sources.events import read_event_stream, read_events_table  # noqa: E402
from rulestream.streaming.pipeline import stream_alerts  # noqa: E402


def main():
    sf, scratch = sys.argv[1], sys.argv[2]
    names = sys.argv[3:] or ["single_event", "single_event_100", "threshold"]
    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false"})
    src = os.path.join(scratch, "events_json")
    ev = read_events_table(spark, sf)
    n = ev.count()
    ev.select("content", "event_ms").repartitionByRange(10, "event_ms").sortWithinPartitions("event_ms") \
        .select("content").write.mode("overwrite").text(src)
    out = {}
    for name in names:
        rs = catalog.rule_set(spark, name)
        stream = read_event_stream(spark, src, options={"maxFilesPerTrigger": "1"})
        q = (stream_alerts(stream, rule_set=rs).writeStream.format("noop").outputMode("append")
             .option("checkpointLocation", os.path.join(scratch, f"ck_{name}")).trigger(availableNow=True))
        t0 = time.perf_counter()
        h = q.start()
        h.awaitTermination()
        el = time.perf_counter() - t0
        out[name] = {"sec": round(el, 2), "events_per_sec": round(n / el)}
    print(json.dumps({"metric": "stream_events_per_sec", "events": n, "sf": sf, "rule_sets": out}))
    spark.stop()


if __name__ == "__main__":
    main()
