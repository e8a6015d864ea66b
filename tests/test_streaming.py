"""Structured Streaming path: file stream -> transformWithState -> memory sink."""

import json
import os
import tempfile
import time

from helpers import START_MS, iso

from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import RuleSet
from rulestream.plans.catalog import all_blocks, block, eq, rule, seq_cond
from rulestream.sources.events import read_event_stream
from rulestream.streaming.pipeline import (rule_programs, snapshot_rule_side, stream_alerts,
                                           write_rule_snapshot)


def _lines(specs, customer="CustomerOne"):
    out = []
    for t, f in specs:
        d = {"@timestamp": iso(START_MS + int(t * 1000)), "customer": customer}
        d.update(f)
        out.append(json.dumps(d))
    return out


def run_stream(spark, batches, **kw):
    d = tempfile.mkdtemp(prefix="rs-stream-", dir="/tmp")
    src, ck = os.path.join(d, "in"), os.path.join(d, "ck")
    os.makedirs(src)
    for i, lines in enumerate(batches):
        with open(os.path.join(src, f"{i:04d}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        t = time.time() - 100 + i
        os.utime(os.path.join(src, f"{i:04d}.json"), (t, t))
    events = read_event_stream(spark, src, options={"maxFilesPerTrigger": "1"})
    name = "alerts_" + os.path.basename(d).replace("-", "_")
    q = (stream_alerts(events, **kw).writeStream.format("memory").queryName(name)
         .outputMode("append").option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.sql(f"select * from {name}").collect()


SENTINEL = [_lines([(100000, {"type": "sentinel"})])]


def test_stream_threshold_initial_and_final(spark):
    r = rule([block("THRESHOLD", eq("destinationIp", "12.23.45.67"), 2, 1, ["hostname"], THRESHOLD=2)],
             group_by="hostname")
    rs = RuleSet(rules_from_json(spark, [("t", 1, r)]))
    ev = _lines([(0, {"destinationIp": "12.23.45.67", "hostname": "host_1"}),
                 (1, {"destinationIp": "12.23.45.67", "hostname": "host_1"})])
    out = run_stream(spark, [ev] + SENTINEL, rule_set=rs)
    assert len(out) == 2
    assert all(a["match_ms"] == START_MS + 1000 for a in out)


def test_stream_anomaly_and_drop(spark):
    specs = [(t, {"type": "web_server", "hostname": "h1"}) for t in range(0, 540, 60) for _ in range(10)]
    specs += [(540, {"type": "web_server", "hostname": "h1"})] * 100
    anomaly = rule([block("SIMPLE_ANOMALY", eq("type", "web_server"), 60, 0, SIMPLE_ANOMALY_THRESHOLD=10)],
                   group_by="hostname")
    drop = rule([block("DROP_TO_ZERO", eq("type", "web_server"), 60, 0)], group_by="hostname")
    rs = RuleSet(rules_from_json(spark, [("a", 1, anomaly), ("d", 1, drop)]))
    out = run_stream(spark, [_lines(specs)] + SENTINEL, rule_set=rs)
    by_rule = {}
    for a in out:
        by_rule.setdefault(a["rule_id"], []).append(a)
    assert len(by_rule["a"]) == 1
    assert "100 matching events" in by_rule["a"][0]["outputs"]["0"]["match_message"]
    assert len(by_rule["d"]) == 1 and by_rule["d"][0]["match_ms"] == START_MS + 660_000


def test_stream_complex_rule(spark):
    r = rule([block("SINGLE_EVENT", eq("check", n)) for n in ("one", "two", "three")], group_by="type",
             size=10, slide=2, condition=all_blocks(0, 1, 2), severity=27)
    rs = RuleSet(rules_from_json(spark, [("c", 1, r)]))
    ev = _lines([(0, {"type": "t", "check": "two"}), (1, {"type": "t", "check": "one"}),
                 (2, {"type": "t", "check": "two"}), (9, {"type": "t", "check": "three"})])
    out = run_stream(spark, [ev] + SENTINEL, rule_set=rs)
    assert len(out) == 1 and out[0]["base_severity"] == 27


def test_stream_dynamic_rule_snapshot(spark):
    d = tempfile.mkdtemp(prefix="rs-snap-", dir="/tmp")
    rules = rules_from_json(spark, [("s", 1, rule([block("SINGLE_EVENT", eq("type", "error"))]))])
    write_rule_snapshot(rules, d)
    ev = _lines([(0, {"type": "error"}), (1, {"type": "ok"}), (2, {"type": "error"})])
    out = run_stream(spark, [ev], rule_side=snapshot_rule_side(spark, d), programs=rule_programs(rules))
    assert len(out) == 2


def test_stream_multi_block_rule_added_and_resized_while_running(spark):
    """A multi-block rule that is added after the start alerts without a restart; its second version, with
    another window size, keeps its windows apart from the first's."""
    d = tempfile.mkdtemp(prefix="rs-late-", dir="/tmp")
    src, snap = os.path.join(d, "in"), os.path.join(d, "snap")
    os.makedirs(src), os.makedirs(snap)

    def put(n, specs):
        with open(os.path.join(src, f"{n}.json"), "w") as f:
            f.write("\n".join(_lines(specs)) + "\n")

    def ordered(version, size):
        r = rule([block("SINGLE_EVENT", eq("check", "a")), block("SINGLE_EVENT", eq("check", "b"))],
                 size=size, slide=size, condition=seq_cond((0, False), (1, False)))
        return rules_from_json(spark, [("late", version, r)])

    events = read_event_stream(spark, src)
    put(0, [(0, {"check": "a"}), (1, {"check": "b"})])
    q = (stream_alerts(events, rule_side=snapshot_rule_side(spark, snap)).writeStream.format("memory")
         .queryName("late_alerts").outputMode("append").option("checkpointLocation", os.path.join(d, "ck")).start())
    try:
        q.processAllAvailable()
        write_rule_snapshot(ordered(1, 10), snap)
        put(1, [(2, {"check": "a"}), (3, {"check": "b"})])
        q.processAllAvailable()
        write_rule_snapshot(ordered(2, 20), snap)
        put(2, [(4, {"check": "b"}), (5, {"check": "a"})])
        q.processAllAvailable()
        put(3, [(100000, {"check": "-"})])
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.sql("select rule_version, window_end_ms - window_start_ms as size from late_alerts").collect()
    assert [tuple(r) for r in out] == [(1, 10000)]
