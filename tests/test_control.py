"""Control log fold (K1-K6), validation (V1-V13), acks."""

import json

from rulestream.operators.control import acks_to_json, active_at, fold_control
from rulestream.operators.rules import rules_from_json
from rulestream.operators.validate import rule_errors
from rulestream.plans.catalog import all_blocks, block, eq, rule
from rulestream.sources.control import control_from_messages

TS = "2019-02-21T13:00:00.000Z"
RULE = rule([block("SINGLE_EVENT", eq("type", "x"))])
RULE2 = rule([block("SINGLE_EVENT", eq("type", "y"))])


def msg(kind, rid=None, ver=None, content=None, schema=1, ts=TS):
    d = {"timestamp": ts, "type": kind, "controlSchemaVersion": schema}
    if rid is not None:
        d["ruleId"] = rid
    if ver is not None:
        d["ruleVersion"] = ver
    if content is not None:
        d["content"] = content
    return json.dumps(d)


def run(spark, msgs):
    acks, hist = fold_control(control_from_messages(spark, msgs))
    return sorted(acks.collect(), key=lambda r: r["seq"]), hist


def test_control_log_fixture(spark):
    msgs = [msg("ADD_RULE", "r", 1, RULE), msg("ADD_RULE", "r", 2, RULE2), msg("ADD_RULE", "r", 1, RULE),
            msg("REMOVE_RULE", "r", 1), msg("QUERY_STATUS"), msg("REMOVE_RULE", "r", 2),
            msg("REMOVE_RULE", "r", 2), msg("ADD_RULE", "r", 1, RULE), msg("ADD_RULE", "r", 3, "{broken")]
    acks, hist = run(spark, msgs)
    got = [(a["status"], a["ruleVersion"]) for a in acks]
    assert got == [("RULE_ACTIVE", 1), ("RULE_ACTIVE", 2), ("RULE_ACTIVE", 2), ("ERROR", 1),
                   ("STATUS_UPDATE", 0), ("RULE_DEACTIVATED", 2), ("RULE_DEACTIVATED", 2),
                   ("RULE_ACTIVE", 1), ("ERROR", 3)]
    status = json.loads(acks[4]["content"])
    assert [(r["ruleId"], r["ruleVersion"]) for r in status] == [("r", 2)]
    assert "is active" in acks[3]["content"]
    assert acks[8]["content"].startswith("Control Input failed validation: ")
    h = sorted((r["rule_version"], r["valid_from_seq"], r["valid_to_seq"]) for r in hist.collect())
    assert h == [(1, 0, 1), (1, 7, None), (2, 1, 5)]
    assert [r["rule_version"] for r in active_at(hist).collect()] == [1]
    assert [r["rule_version"] for r in active_at(hist, 4).collect()] == [2]
    assert acks_to_json(fold_control(control_from_messages(spark, msgs[:1]))[0]).count() == 1


def test_e20_add_add_query(spark):
    acks, _ = run(spark, [msg("ADD_RULE", "rule_1", 1, RULE), msg("ADD_RULE", "rule_2", 1, RULE2),
                          msg("QUERY_STATUS")])
    assert acks[2]["status"] == "STATUS_UPDATE"
    assert [r["ruleId"] for r in json.loads(acks[2]["content"])] == ["rule_1", "rule_2"]


def test_e22_typographic_quotes_and_bad_messages(spark):
    bad = RULE.replace('"', "“")
    acks, _ = run(spark, [msg("ADD_RULE", "r", 1, bad), msg("ADD_RULE", "", 1, RULE),
                          msg("ADD_RULE", "r", 0, RULE), msg("ADD_RULE", "r", 1, RULE, schema=2),
                          msg("ADD_RULE", "r", 1, RULE, ts="yesterday"), "not json",
                          msg("REMOVE_RULE", None, 1)])
    assert [a["status"] for a in acks] == ["ERROR"] * 6


def errors_of(spark, content):
    return rule_errors(rules_from_json(spark, [("r", 1, content)])).first()["errors"]


def test_rule_validation(spark):
    ok = [RULE,
          rule([block("THRESHOLD", eq("a", "b"), 30, 10, ["x"], THRESHOLD=5)], group_by="h"),
          rule([block("SINGLE_EVENT", eq("a", "b")), block("SINGLE_EVENT", eq("a", "c"))],
               group_by="h", size=10, slide=2, condition=all_blocks(0, 1))]
    for c in ok:
        assert errors_of(spark, c) == [], c
    assert len(errors_of(spark, json.dumps({"blocks": []}))) == 1
    # multi-block without condition / window / slide
    assert len(errors_of(spark, rule([block("SINGLE_EVENT", eq("a", "b"))] * 2, group_by="h"))) == 3
    # threshold without group-by, aggregation fields, threshold
    assert len(errors_of(spark, rule([block("THRESHOLD", eq("a", "b"), 30, 10)]))) == 3
    assert len(errors_of(spark, rule([block("SIMPLE_ANOMALY", eq("a", "b"), 60, 5)], group_by="h"))) == 2
    assert len(errors_of(spark, rule([block("DROP_TO_ZERO", eq("a", "b"), 0, 0)], group_by="h"))) == 1
    assert len(errors_of(spark, rule([block("UNIQUE_THRESHOLD", eq("a", "b"), 3, 1, ["u"], THRESHOLD=3)],
                                     group_by="h"))) == 1
    assert len(errors_of(spark, rule([block("SINGLE_EVENT", eq("", "b"))]))) == 1
    assert len(errors_of(spark, rule([block("SINGLE_EVENT", {"@class": "x.Unknown", "key": "a"})]))) == 1
    assert len(errors_of(spark, json.dumps({"blocks": [{"type": "SINGLE_EVENT", "condition": eq("a", "b")}],
                                            "colour": "red"}))) == 1
    assert len(errors_of(spark, json.dumps({"blocks": [{"type": "NOPE", "condition": eq("a", "b")}],
                                            "groupByField": "h"}))) == 1
    assert len(errors_of(spark, json.dumps({"blocks": [{"type": "SINGLE_EVENT"}]}))) == 1
    idx = rule([block("SINGLE_EVENT", eq("a", "b"))] * 2, group_by="h", size=10, slide=2,
               condition=all_blocks(0, 0))
    assert len(errors_of(spark, idx)) == 1


def test_strict_schema_checks(spark):
    c = rule([block("SINGLE_EVENT", eq("a", "b"))], group_by="h")
    r = rules_from_json(spark, [("r", 1, c)])
    assert rule_errors(r).first()["errors"] == []
    assert len(rule_errors(r, strict=True).first()["errors"]) == 1


def test_rule_numbers_are_strict(spark):
    """Numbers may come as text; what is no whole number is an error, not 0."""
    one = {"blocks": [{"type": "SINGLE_EVENT", "condition": eq("a", "b")}]}
    for bad in ({"baseSeverity": "x"}, {"windowSize": "abc"}, {"windowSlide": 1.5}, {"version": "two"}, {"baseSeverity": [1]}):
        got = errors_of(spark, json.dumps(one | bad))
        assert len(got) == 1 and got[0].endswith(next(iter(bad))), (bad, got)
    for good in ({"baseSeverity": "7"}, {"baseSeverity": 7}, {"windowSize": "0"}, {"baseSeverity": None}):
        assert errors_of(spark, json.dumps(one | good)) == [], good


def status_log():
    """Adds, removals and status queries of many rules, some queries twice under one number."""
    out = []
    for i in range(120):
        r = f"r{i % 11}"
        out.append((i, msg("QUERY_STATUS") if i % 6 == 5 else msg("REMOVE_RULE", r, 1 + i % 3) if i % 7 == 3 else msg("ADD_RULE", r, 1 + i % 3, RULE)))
        if i % 30 == 29:
            out.append(out[-1])
    return out


def test_status_lists_the_rules_in_force(spark):
    """Each answer against the log replayed rule by rule; no row is made per query and rule."""
    from rulestream.sources.control import parse_control
    log = status_log()
    acks, hist = fold_control(parse_control(spark.createDataFrame(log, "seq bigint, value string"), seq_col="seq"))
    spans = [(r["rule_id"], r["rule_version"], r["valid_from_seq"], r["valid_to_seq"]) for r in hist.collect()]
    got = {r["seq"]: json.loads(r["content"]) for r in acks.where("action = 'QUERY_STATUS'").collect()}
    asked = [s for s, m in log if "QUERY_STATUS" in m]
    assert sorted(got) == sorted(set(asked)) and any(got.values())
    for seq, listed in got.items():
        want = sorted((r, v) for r, v, a, b in spans if a < seq and (b is None or b > seq) for _ in range(asked.count(seq)))
        assert [(x["ruleId"], x["ruleVersion"]) for x in listed] == want, seq
        assert all((d := json.loads(x["content"]))["id"] == x["ruleId"] and d["version"] == x["ruleVersion"] for x in listed)
    plan = acks._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "valid_to_seq" in line and "hi#" not in line]
    assert not joins, joins


def test_message_is_read_once(spark):
    """The filter on the type is no second reader of the messages before it."""
    from rulestream.sources.control import parse_control
    made = spark.range(3).selectExpr("id AS seq", "CASE id WHEN 0 THEN 'not json' WHEN 1 THEN '{\"type\":\"RESET\"}' ELSE '{\"type\":\"QUERY_STATUS\"}' END AS value")
    ctrl = parse_control(made, seq_col="seq")
    assert [r["seq"] for r in ctrl.collect()] == [2]
    assert ctrl._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_steady_rules_are_one_piece(spark):
    """Neighbours in force at all queries of a span are joined once, not per query."""
    from pyspark.sql import functions as F
    from rulestream.operators.control import _pieces
    rows = [(f"r{i:02d}", f"t{i}", 60 if i == 7 else 1, 70 if i in (11, 12) else 200 if i == 3 else None) for i in range(20)]
    listed = spark.createDataFrame([(rows, 50, 100), (rows[:1], 50, 100), (rows[7:8], 50, 100)],
                                   "listed array<struct<rule_id:string,text:string,valid_from_seq:bigint,valid_to_seq:bigint>>, first bigint, last bigint")
    got = [[tuple(p) for p in r["pieces"]] for r in listed.select(_pieces(F.col("listed"), F.col("first"), F.col("last")).alias("pieces")).collect()]
    text = lambda a, b: ",".join(f"t{i}" for i in range(a, b))
    assert got == [[(text(0, 7), None, None), ("t7", 60, None), (text(8, 11), None, None), ("t11", 1, 70), ("t12", 1, 70), (text(13, 20), None, None)],
                   [("t0", None, None)], [("t7", 60, None)]]


def test_listed_rules_are_read_once_each(monkeypatch):
    """Status answers against a plain reading of their JSON, also where an entry's text looks like the end of one."""
    from rulestream.plans import catalog
    read = []
    monkeypatch.setattr(catalog, "_listed_rule", lambda r, plain=catalog._listed_rule: read.append(r) or plain(r))
    two = json.dumps({"id": "b", "version": 2, "blocks": [{"type": "SINGLE_EVENT"}, {"type": "THRESHOLD"}]})
    rules = [{"ruleId": "b", "ruleVersion": 2, "content": two}, {"ruleId": "ü", "ruleVersion": 1, "content": '{"version":"7"}'},
             {"ruleId": "a", "ruleVersion": 3, "content": "{broken"}, {"ruleId": "c", "ruleVersion": 4}]
    answer = lambda r: json.dumps(r, separators=(",", ":"))
    seen = catalog._Listed()
    assert [seen.of(answer(rules[:n])) for n in (0, 1, 4, 4)] == ["", "b:2:2", *["a:3 b:2:2 c:4 ü:1:7"] * 2]
    assert len(read) == 4
    odd = [{"ruleId": "},{", "ruleVersion": 1, "content": "},{"}, *rules[:1]]
    assert seen.of(answer(odd)) == "b:2:2 },{:1" and seen.of("[{") is None and seen.of(json.dumps(rules[:1])) == "b:2:2"
    monkeypatch.setattr(catalog._Listed, "MOST", 0)
    assert seen.of(answer(rules[3:])) == "c:4" and len(seen) == 1
