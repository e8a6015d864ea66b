"""End-to-end rule runs on the reference's integration scenarios."""

from helpers import START_MS, make_events

from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import run_rules
from rulestream.plans.catalog import (all_blocks, all_of, any_blocks, any_of, block, cmp, composite_rule, eq,
                                      regex, rule, seq_cond)


def alerts(spark, events, rule_json, rule_id="rule1", mode="auto"):
    rules = rules_from_json(spark, [(rule_id, 1, rule_json)])
    return run_rules(events, rules, mode=mode).collect()


def outputs(a):
    return {k: v for k, v in a["outputs"].items()}


THR = dict(btype="THRESHOLD", size=2, slide=1)


def threshold_rule(n=2, size=2, slide=1, agg=("hostname",), group="hostname"):
    return rule([block("THRESHOLD", eq("destinationIp", "12.23.45.67"), size, slide, list(agg), THRESHOLD=n)],
                group_by=group)


def test_e1_threshold_two_alerts(spark):
    ev = make_events(spark, [(0, {"destinationIp": "12.23.45.67", "hostname": "host_1"}),
                             (1, {"destinationIp": "12.23.45.67", "hostname": "host_1"})])
    out = alerts(spark, ev, threshold_rule())
    assert len(out) == 2
    for a in out:
        assert a["match_ms"] == START_MS + 1000
        assert a["group_by"] == "hostname=host_1"


def test_e2_initial_then_final_counts(spark):
    specs = [(0, {"destinationIp": "12.23.45.67", "hostname": "host_1"})] * 5 + \
            [(1, {"destinationIp": "12.23.45.67", "hostname": "host_1"})]
    out = alerts(spark, make_events(spark, specs), threshold_rule(size=2, slide=2))
    msgs = sorted(outputs(a)["0"]["match_message"] for a in out)
    assert len(out) == 2
    assert msgs == ["Threshold exceeded. 2 events were observed in the last 0 minutes.",
                    "Threshold exceeded. 6 events were observed in the last 0 minutes."]


def test_e3_aggregation_by_user(spark):
    d = {"destinationIp": "12.23.45.67", "hostname": "host_1"}
    specs = [(0, {**d, "user": "1"})] * 3 + [(0, {**d, "user": "2"}), (1, {**d, "user": "2"})]
    out = alerts(spark, make_events(spark, specs), threshold_rule(n=5, agg=("user",)))
    assert len(out) == 2
    s = sorted(out, key=lambda a: a["match_ms"])[0]
    evs = {e["key"]: e["count"] for e in outputs(s)["0"]["matching_events"]}
    assert evs == {"user=1": 3, "user=2": 2}


def test_e4_missing_group_or_other_customer(spark):
    ev = make_events(spark, [(0, {"destinationIp": "12.23.45.67"}), (1, {"destinationIp": "12.23.45.67"})])
    assert alerts(spark, ev, threshold_rule()) == []
    ev = make_events(spark, [(0, {"destinationIp": "12.23.45.67", "hostname": "h", "customer": "One"}),
                             (1, {"destinationIp": "12.23.45.67", "hostname": "h", "customer": "Two"})])
    assert alerts(spark, ev, threshold_rule()) == []


def unique_rule(company, size, slide, group):
    return rule([block("UNIQUE_THRESHOLD", eq("company", company), size, slide, ["username"],
                       THRESHOLD=3, UNIQUE_FIELD="username")], group_by=group)


def test_e5_unique_threshold(spark):
    specs = [(t, {"company": "1", "hostname": "host", "username": f"user_{t}"}) for t in (0, 1, 2)]
    specs += [(t, {"company": "2", "hostname": f"otherhost_{t - 2}", "username": "user_x"}) for t in (3, 4, 5)]
    specs += [(t, {"company": "2", "hostname": "company_2", "username": f"user_{t + 1}"}) for t in (3, 4, 5)]
    out = alerts(spark, make_events(spark, specs), unique_rule("2", 3, 1, "hostname"))
    assert len(out) == 2
    assert all(a["group_by"] == "hostname=company_2" for a in out)


def test_e6_missing_unique_field_not_counted(spark):
    specs = [(0, {"company": "1"}), (1, {"company": "1", "username": "user_0"}),
             (2, {"company": "1", "username": "user_1"}), (2, {"company": "1", "username": "user_2"})]
    out = alerts(spark, make_events(spark, specs), unique_rule("1", 3, 3, "company"))
    assert len(out) == 2
    for a in out:
        assert len(outputs(a)["0"]["matching_events"]) == 3
        assert outputs(a)["0"]["match_message"] == "Unique threshold exceeded."


def anomaly_specs(skip=(), last=100):
    specs = []
    for t in range(0, 540, 60):
        if t in skip:
            continue
        specs += [(t, {"type": "web_server", "hostname": "h1"})] * 10
    specs += [(540, {"type": "web_server", "hostname": "h1"})] * last
    return specs


def anomaly_rule(h):
    return rule([block("SIMPLE_ANOMALY", eq("type", "web_server"), 60, 0, SIMPLE_ANOMALY_THRESHOLD=h)],
                group_by="hostname")


def test_e7_anomaly(spark):
    ev = make_events(spark, anomaly_specs())
    out = alerts(spark, ev, anomaly_rule(10))
    assert len(out) == 1
    assert "100 matching events" in outputs(out[0])["0"]["match_message"]
    assert outputs(out[0])["0"]["match_message"] == \
        "100 matching events seen in 1 minutes, up from the average previous average of 10."
    assert alerts(spark, ev, anomaly_rule(12)) == []


def test_e8_anomaly_with_one_empty_subwindow(spark):
    assert len(alerts(spark, make_events(spark, anomaly_specs(skip=(120,))), anomaly_rule(10))) == 1


def drop_rule():
    return rule([block("DROP_TO_ZERO", eq("type", "web_server"), 60, 0)], group_by="hostname")


def test_e9_drop_to_zero(spark):
    busy = [(t, {"type": "web_server", "hostname": "h1"}) for t in range(0, 540, 60) for _ in range(10)]
    out = alerts(spark, make_events(spark, busy), drop_rule())
    assert len(out) == 1
    assert outputs(out[0])["0"]["match_message"] == "0 matching events seen in the last 60 seconds."
    assert out[0]["match_ms"] == START_MS + 600_000
    out = alerts(spark, make_events(spark, busy + [(540, {"type": "web_server", "hostname": "h1"})]), drop_rule())
    assert len(out) == 1
    assert out[0]["match_ms"] == START_MS + 660_000


def test_e10_drop_then_other_customer(spark):
    busy = [(t, {"type": "web_server", "hostname": "h1"}) for t in range(0, 540, 60) for _ in range(10)]
    busy.append((540, {"type": "web_server", "hostname": "h1", "customer": "Other"}))
    out = alerts(spark, make_events(spark, busy), drop_rule())
    mine = [a for a in out if a["customer"] == "CustomerOne"]
    assert len(mine) == 1 and mine[0]["match_ms"] == START_MS + 600_000


def checks(*names):
    return [block("SINGLE_EVENT", eq("check", n)) for n in names]


def test_e11_all_blocks(spark):
    ev = make_events(spark, [(0, {"type": "t", "check": "two"}), (1, {"type": "t", "check": "one"}),
                             (2, {"type": "t", "check": "two"}), (9, {"type": "t", "check": "three"})])
    r = rule(checks("one", "two", "three"), group_by="type", size=10, slide=2,
             condition=all_blocks(0, 1, 2), severity=27)
    out = alerts(spark, ev, r)
    assert len(out) == 1
    o = outputs(out[0])
    assert o["0"]["match_ms"] == START_MS + 1000 and o["2"]["match_ms"] == START_MS + 9000
    assert o["1"]["match_ms"] == START_MS + 2000  # last one wins
    assert out[0]["base_severity"] == 27


def test_e12_any_overlapping_windows(spark):
    ev = make_events(spark, [(0, {"type": "t", "check": "two"})])
    r = rule(checks("one", "two"), group_by="type", size=10, slide=2, condition=any_blocks(0, 1))
    assert len(alerts(spark, ev, r)) == 5


def test_e13_composite(spark):
    ev = make_events(spark, [(1, {"type": "t", "check": "one"}), (2, {"type": "t", "check": "three"}),
                             (9, {"type": "t", "check": "two"})])
    cond = composite_rule("OR", all_blocks(0, 1), all_blocks(2, 3))
    r = rule(checks("one", "two", "three", "four"), group_by="type", size=10, slide=2, condition=cond)
    assert len(alerts(spark, ev, r)) == 1


def seq_rule(names, entries):
    return rule(checks(*names), group_by="type", size=10, slide=2, condition=seq_cond(*entries))


def test_e14_sequence(spark):
    in_order = make_events(spark, [(1, {"type": "t", "check": "one"}), (2, {"type": "t", "check": "two"}),
                                   (9, {"type": "t", "check": "three"})])
    entries = [(0, False), (1, False), (2, False)]
    assert len(alerts(spark, in_order, seq_rule(["one", "two", "three"], entries))) == 1
    assert len(alerts(spark, in_order, seq_rule(["one", "three", "two"], entries))) == 0
    partial = make_events(spark, [(1, {"type": "t", "check": "one"}), (8, {"type": "t", "check": "two"})])
    assert len(alerts(spark, partial, seq_rule(["one", "two", "three"], entries))) == 0


def test_e15_sequence_not_present(spark):
    ev = make_events(spark, [(1, {"type": "t", "check": "one"}), (8, {"type": "t", "check": "two"}),
                             (9, {"type": "t", "check": "three"})])
    entries = [(0, False), (1, False), (2, True)]
    assert len(alerts(spark, ev, seq_rule(["one", "two", "four"], entries))) == 1
    assert len(alerts(spark, ev, seq_rule(["one", "two", "three"], entries))) == 0


def test_e16_out_of_order_arrival(spark):
    ev = make_events(spark, [(1, {"type": "t", "check": "one"}), (9, {"type": "t", "check": "three"}),
                             (2, {"type": "t", "check": "two"})])
    entries = [(0, False), (1, False), (2, False)]
    assert len(alerts(spark, ev, seq_rule(["one", "two", "three"], entries))) == 1


def logon_rule():
    fail = block("THRESHOLD", all_of(eq("type", "logon"), eq("status", "failure")), 2, 1, ["remoteIp"], THRESHOLD=3)
    ok = block("SINGLE_EVENT", all_of(eq("type", "logon"), eq("status", "success")))
    return rule([fail, ok], group_by="username", size=3, slide=3, condition=seq_cond((0, False), (1, False)))


def test_e17_threshold_then_single(spark):
    f = {"type": "logon", "status": "failure", "remoteIp": "1.2.3.4", "username": "bob"}
    s = {"type": "logon", "status": "success", "remoteIp": "1.2.3.4", "username": "bob"}
    assert len(alerts(spark, make_events(spark, [(0, f)] * 3 + [(1, s)]), logon_rule())) == 1
    assert len(alerts(spark, make_events(spark, [(0, f)] * 3 + [(1, {**s, "username": "eve"})]), logon_rule())) == 0
    nouser = {k: v for k, v in s.items() if k != "username"}
    assert len(alerts(spark, make_events(spark, [(0, f)] * 3 + [(1, nouser)]), logon_rule())) == 0


def test_e18_customers_do_not_mix(spark):
    ev = make_events(spark, [(0, {"type": "t", "check": "two", "customer": "Two"}),
                             (0, {"type": "t", "check": "one", "customer": "One"})])
    r = rule(checks("one", "two"), group_by="type", size=10, slide=10, condition=all_blocks(0, 1))
    assert alerts(spark, ev, r) == []


def test_e19_nested_condition_both_modes(spark):
    ev = make_events(spark, [
        (0, {"hostname": "importantLaptop", "destinationIp": "12.0.0.1"}),
        (1, {"hostname": "other", "testValue": "20", "destinationIp": "12.1.1.1"}),
        (2, {"hostname": "other", "testValue": "10", "destinationIp": "12.1.1.1"}),
        (3, {"hostname": "importantLaptop", "destinationIp": "13.0.0.1"})])
    cond = all_of(any_of(eq("hostname", "importantLaptop"), cmp("testValue", "GREATER_THAN", 15)),
                  regex("destinationIp", r"^12\."))
    r = rule([block("SINGLE_EVENT", cond)])
    assert len(alerts(spark, ev, r)) == 2
    assert len(alerts(spark, ev, r, mode="joined")) == 2
    r2 = rule([block("SINGLE_EVENT", all_of(eq("hostname", "nobody"), regex("destinationIp", r"^12\.")))])
    assert alerts(spark, ev, r2) == []
