"""Window assignment (W1-W3), alert JSON (O3-O5), alert feedback."""

import json

from helpers import START_MS, make_events
from pyspark.sql import functions as F

from rulestream.functions.windows import pane_ms, sliding_starts, tumbling_start
from rulestream.operators.alerts import alerts_to_json
from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import run_rules
from rulestream.plans.catalog import block, eq, rule
from rulestream.sources.events import alerts_as_events


def starts(spark, ms, size, slide):
    return spark.range(1).select(sliding_starts(F.lit(ms).cast("bigint"), F.lit(size).cast("bigint"),
                                                F.lit(slide).cast("bigint")).alias("s")).first()["s"]


def test_sliding_windows(spark):
    assert sorted(starts(spark, 5000, 10000, 2000)) == [-4000, -2000, 0, 2000, 4000]
    assert starts(spark, 0, 10000, 2000) == [0, -2000, -4000, -6000, -8000]   # E12: five windows
    assert starts(spark, 2500, 1000, 2000) == [2000]                           # slide > size
    assert starts(spark, 1500, 1000, 2000) == []                               # ... leaves gaps
    assert starts(spark, 500, 1000, 2000) == [0]
    assert sorted(starts(spark, 5000, 5000, 3000)) == [3000]                   # slide does not divide size


def test_tumbling_and_panes(spark):
    r = spark.range(1).select(tumbling_start(F.lit(125).cast("bigint"), F.lit(60).cast("bigint")).alias("t"),
                              pane_ms(F.lit(6000).cast("bigint"), F.lit(2000).cast("bigint")).alias("p1"),
                              pane_ms(F.lit(5000).cast("bigint"), F.lit(3000).cast("bigint")).alias("p2")).first()
    assert (r["t"], r["p1"], r["p2"]) == (120, 2000, 1000)


def test_alert_json_and_feedback(spark):
    ev = make_events(spark, [(0, {"destinationIp": "12.23.45.67", "hostname": "host_1", "v": 1.5}),
                             (1, {"destinationIp": "12.23.45.67", "hostname": "host_1", "v": 2})])
    r = rule([block("THRESHOLD", eq("destinationIp", "12.23.45.67"), 2, 1, ["hostname"], THRESHOLD=2)],
             group_by="hostname")
    alerts = run_rules(ev, rules_from_json(spark, [("r1", 3, r)]))
    js = alerts_to_json(alerts)
    docs = [json.loads(x["value"]) for x in js.collect()]
    assert len(docs) == 2
    d = docs[0]
    assert d["matchTime"] == "2019-02-21T13:00:01.000Z"
    assert d["matchedRuleId"] == "r1" and d["matchedRuleVersion"] == 3
    assert d["hostname"] == "host_1"                         # O5 dynamic group-by field
    assert d["groupBy"] == "hostname=host_1"
    sample = d["blockOutput"]["0"]["matchingEvents"][0]["sampleEventContent"]
    assert isinstance(sample, dict) and sample["hostname"] == "host_1"   # O4 sample as object
    back = alerts_as_events(js)
    assert back.where(F.col("fields")["source"] == "rulestream").count() == 2
    assert back.first()["customer"] == "CustomerOne"


def test_group_by_with_equals_sign_skips_field(spark):
    ev = make_events(spark, [(0, {"k": "a=b", "x": "1"})])
    r = rule([block("THRESHOLD", eq("x", "1"), 2, 2, ["x"], THRESHOLD=1)], group_by="k")
    docs = [json.loads(x["value"]) for x in alerts_to_json(run_rules(ev, rules_from_json(spark, [("r", 1, r)])))
            .collect()]
    assert docs and all("k" not in d for d in docs)          # Q14: 'k=a=b' does not split in two


def test_sliding_starts_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for _ in range(400):
        size = rnd.choice([1, 2, 3, 5, 7, 10, 60]) * 1000
        slide = rnd.choice([1, 2, 3, 4, 7, 10, 90]) * 1000
        rows.append((rnd.randrange(0, 10 ** 7), size, slide))
    df = spark.createDataFrame(rows, "ms bigint, size bigint, slide bigint")
    got = {(r["ms"], r["size"], r["slide"]): sorted(r["s"]) for r in df.select(
        "ms", "size", "slide", sliding_starts(F.col("ms"), F.col("size"), F.col("slide")).alias("s")).collect()}
    for ms, size, slide in rows:
        want = sorted(s for s in range(ms - ms % slide - 70 * slide, ms + 1, slide) if ms - size < s <= ms)
        assert got[(ms, size, slide)] == want, (ms, size, slide)
