"""Streaming job: control stream -> acks + snapshot; event stream -> alert JSON."""

import glob
import json
import os
import tempfile

from helpers import START_MS, iso

from rulestream.plans.catalog import block, eq, rule
from rulestream.streaming.job import JobOptions, start


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _read_json_lines(path):
    out = []
    for fn in sorted(set(glob.glob(os.path.join(path, "**", "part-*"), recursive=True))):
        with open(fn) as f:
            out += [json.loads(x) for x in f if x.strip()]
    return out


def test_job_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="rs-job-", dir="/tmp")
    opts = JobOptions(input_path=f"{d}/in", control_path=f"{d}/ctl", output_path=f"{d}/out",
                      control_output_path=f"{d}/acks", state_dir=f"{d}/state")
    r = rule([block("SINGLE_EVENT", eq("type", "error"))])
    _write(opts.control_path, "0.json", [json.dumps({
        "timestamp": iso(START_MS), "type": "ADD_RULE", "ruleId": "r1", "ruleVersion": 1,
        "controlSchemaVersion": 1, "content": r})])
    os.makedirs(opts.input_path, exist_ok=True)
    control_q, alert_q = start(spark, opts)
    try:
        control_q.processAllAvailable()
        _write(opts.input_path, "0.json", [json.dumps({"@timestamp": iso(START_MS + i * 1000), "customer": "c",
                                                       "type": t}) for i, t in enumerate(["error", "ok", "error"])])
        alert_q.processAllAvailable()
    finally:
        control_q.stop()
        alert_q.stop()
    acks = _read_json_lines(opts.control_output_path)
    assert [a["status"] for a in acks] == ["RULE_ACTIVE"]
    alerts = _read_json_lines(opts.output_path)
    assert len(alerts) == 2 and {a["matchedRuleId"] for a in alerts} == {"r1"}


def test_control_batches_carry_state_and_may_be_replayed(spark, tmp_path):
    from rulestream.operators.control import fold_control
    from rulestream.sources.control import control_from_messages
    from rulestream.streaming.job import _batches, _control_batch

    def msg(kind, rid=None, ver=None, field="x"):
        content = rule([block("SINGLE_EVENT", eq("type", field))]) if kind == "ADD_RULE" else None
        return json.dumps({"timestamp": iso(START_MS), "type": kind, "ruleId": rid, "ruleVersion": ver, "controlSchemaVersion": 1, "content": content})

    batches = [[msg("ADD_RULE", "a", 1), msg("ADD_RULE", "b", 2), msg("QUERY_STATUS")],
               [msg("REMOVE_RULE", "a", 1), msg("ADD_RULE", "b", 1), msg("ADD_RULE", "c", 0), msg("ADD_RULE", "b", 3, "y"), msg("QUERY_STATUS")],
               [msg("REMOVE_RULE", "b", 2), msg("ADD_RULE", "a", 1), msg("QUERY_STATUS")]]
    opts = JobOptions(control_output_path=f"{tmp_path}/acks", state_dir=f"{tmp_path}/state")
    handle = _control_batch(spark, opts)
    for n in (0, 1, 1, 2, 2):  # batches 1 and 2 are replayed
        handle(control_from_messages(spark, batches[n]), n)
    got = [{k: a.get(k) for k in ("action", "status", "ruleId", "ruleVersion", "content")} for a in _read_json_lines(opts.control_output_path)]
    whole, hist = fold_control(control_from_messages(spark, [m for b in batches for m in b]))
    want = [{k: r[k] for k in ("action", "status", "ruleId", "ruleVersion", "content")} for r in whole.collect()]
    order = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(got, key=order) == sorted(want, key=order) and len(got) == 11
    status = [json.loads(a["content"]) for a in got if a["status"] == "STATUS_UPDATE"]
    stored = json.loads([r for s in status for r in s if r["ruleId"] == "b" and r["ruleVersion"] == 3][0]["content"])
    assert stored["id"] == "b" and stored["version"] == 3 and stored["blocks"][0]["condition"]["value"] == "y"
    assert _batches(spark, f"{opts.state_dir}/active-rules") == [1, 2]
    active = spark.read.parquet(f"{opts.state_dir}/active-rules/batch_id=2")
    assert sorted((r["rule_id"], r["rule_version"]) for r in active.collect()) == [("a", 1), ("b", 3)]
    closed = spark.read.parquet(f"{opts.state_dir}/rule-history")
    assert closed.count() == hist.where("valid_to_seq is not null").count() == 2


def test_messages_are_numbered_in_arrival_order(spark):
    from pyspark.sql import functions as F

    from rulestream.sources.control import number_batch
    batch = spark.range(5000, numPartitions=7).select((5000 - F.col("id")).alias("seq"), F.col("id").cast("string").alias("content"))
    got = number_batch(batch, 3).collect()
    assert sorted(r["seq"] for r in got) == [(3 << 32) + i for i in range(5000)]
    assert all(int(r["content"]) == 4999 - (r["seq"] - (3 << 32)) for r in got)
