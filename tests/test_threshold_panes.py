"""THRESHOLD first-N selection: per-pane pre-limit equals direct explosion."""

import datetime as dt
import random

from helpers import make_events

from pyspark.sql import functions as F

from rulestream.operators import blocks as B
from rulestream.operators.match import match_compiled
from rulestream.operators.rules import rules_from_json
from rulestream.plans import catalog
from rulestream.plans.batch import RuleSet, run_blocks
from rulestream.plans.catalog import block, eq, rule


def test_pane_heads_equal_direct_explosion(spark):
    rnd = random.Random(5)
    rules = [
        ("a", 1, rule([block("THRESHOLD", eq("t", "x"), 10, 3, ["u"], THRESHOLD=3)], group_by="h")),
        ("b", 1, rule([block("THRESHOLD", eq("t", "x"), 12, 4, ["u"], THRESHOLD=5)], group_by="h")),
        ("c", 1, rule([block("THRESHOLD", eq("t", "x"), 3, 6, ["u"], THRESHOLD=2)], group_by="h")),
    ]
    specs = [(rnd.randrange(0, 100), {"t": "x", "h": rnd.choice(["h1", "h2"]), "u": str(rnd.randrange(4))})
             for _ in range(300)]
    m = match_compiled(make_events(spark, specs), RuleSet(rules_from_json(spark, rules)).blocks)

    def rows(max_fan):
        out = B.threshold(m, 5, max_fan)
        return sorted(tuple(r) for r in out.select(
            "rule_id", "group_by", "phase", "window_start_ms", "match_ms", "event_count",
            F.to_json("matching_events").alias("s")).collect())

    direct, panes = rows(1), rows(None)
    assert direct == panes
    assert len({r[2] for r in direct}) == 2 and len(direct) > 50


def _random_events(spark, n=160):
    rnd = random.Random(21)
    specs = [(rnd.choice([0, 0.5, 3]) + i // 3, {"type": "e", "h": rnd.choice("ab"), "u": rnd.choice(["", "x", "y", "z", "w"]), "g": rnd.choice("pq")})
             for i in range(n)]
    return make_events(spark, specs)


def _blocks_of(ev, rules):
    cols = ["rule_id", "customer", "group_by", "phase", "window_start_ms", "match_ms", "event_count", "match_message"]
    rows = run_blocks(ev, rules).select(*cols, "matching_events").collect()
    return sorted((tuple(r)[:-1] + (tuple((m["key"], m["sample"], m["count"]) for m in r["matching_events"]),) for r in rows), key=str)


def test_threshold_by_counts_equals_first_n(spark, monkeypatch):
    ev = _random_events(spark)
    rules = RuleSet(rules_from_json(spark, [
        ("t", 1, rule([block("THRESHOLD", eq("type", "e"), 12, 4, ["h"], THRESHOLD=7)], group_by="g")),
        ("s", 1, rule([block("THRESHOLD", eq("type", "e"), 10, 4, ["u"], THRESHOLD=2)], group_by="g"))]))
    want = _blocks_of(ev, rules)
    monkeypatch.setattr(B, "HEAD_LIMIT", 3)
    monkeypatch.setattr(B, "BUCKETS", 3)
    assert _blocks_of(ev, rules) == want and len({w[0] for w in want}) == 2


def test_unique_threshold_panes_equal_full_windows(spark):
    """Against windows read event by event: ties in time, empty values, panes cut by gcd."""
    ev = _random_events(spark)
    n, size, slide = 3, 10, 4
    rules = RuleSet(rules_from_json(spark, [("u", 1, rule([block("UNIQUE_THRESHOLD", eq("type", "e"), size, slide, ["h"],
                                                                  THRESHOLD=n, UNIQUE_FIELD="u")], group_by="g"))]))
    rows = sorted((r["event_ms"], r["arrival_seq"], r["fields"]) for r in ev.collect())
    want = set()
    for g in "pq":
        mine = [(ms, f) for ms, _, f in rows if f["g"] == g and f["u"]]
        first = (mine[0][0] - size * 1000) // (slide * 1000) * slide * 1000
        for ws in range(first, mine[-1][0] + 1, slide * 1000):
            inside = [(ms, f) for ms, f in mine if ws <= ms < ws + size * 1000]
            seen = []
            for at, (_, f) in enumerate(inside):
                seen += [f["u"]] if f["u"] not in seen else []
                if len(seen) == n:
                    want |= {("initial", f"g={g}", ws, inside[at][0], at + 1), ("final", f"g={g}", ws, inside[-1][0], len(inside))}
                    break
    got = {(r[3], r[2], r[4], r[5], r[6]) for r in _blocks_of(ev, rules)}
    assert got == want and len(want) > 10


def _alert_samples(spark, path):
    """The query over 200 events of 3 users (one null) in 4 days, with ties in time; the events as tuples."""
    rnd = random.Random(8)
    t0 = dt.datetime(2024, 1, 3)
    rows = [(i, t0 + dt.timedelta(hours=rnd.randrange(96)), rnd.choice([None, 1, 2, 2]), rnd.choice(["error", "view", 'a"]}']), i / 4, f'{{"k": {i % 10}}}') for i in range(200)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    return catalog.q_alert_samples(spark, str(path)), rows


def test_alert_samples_equal_windows_read_event_by_event(spark, tmp_path):
    found, rows = _alert_samples(spark, tmp_path)
    day, want = dt.timedelta(days=1), []
    starts = [dt.datetime(2024, 1, 2) + i * day / 2 for i in range(12)]
    for user in (1, 2):
        for ws in starts:
            inside = sorted((r for r in rows if r[2] == user and ws <= r[1] < ws + day), key=lambda r: (r[1], r[0]))
            for firing in (inside[:3], inside) if len(inside) >= 3 else ():
                for t in {r[3] for r in firing}:
                    mine = [r for r in firing if r[3] == t]
                    want.append((f"user={user}", str(user), firing[-1][1].strftime("%Y-%m-%dT%H:%M:%S.000Z"),
                                 f"Threshold exceeded. {len(firing)} events were observed in the last 0 minutes.", f"type={t}", mine[0][0], mine[0][4], len(mine)))
    got = found.select("group_by", "user_field", "match_time", "match_message", "agg_key", "sample_event_id", "sample_value", "n").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 50


def test_alert_json_is_written_and_read_once_and_firings_are_not_joined(spark, tmp_path):
    plan = _alert_samples(spark, tmp_path)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("parseJson(") == 1
    assert "Join" not in plan and "InMemoryRelation" not in plan
