"""Records set aside (B14, C5, P1): complements of what the operators keep."""

import json

from helpers import START_MS, iso

from rulestream.operators.rejects import REJECT_COLUMNS, control_rejects, event_rejects, match_rejects
from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import RuleSet
from rulestream.plans.catalog import all_of, any_of, block, cmp, eq, regex, rule
from rulestream.sources.control import parse_control
from rulestream.sources.events import parse_events

GOOD = json.dumps({"@timestamp": iso(START_MS), "customer": "c", "type": "a", "v": "x"})
RECORDS = [GOOD, None, "", "{", "[1]", '{"a":1}', json.dumps({"@timestamp": "yesterday"}), GOOD]


def test_every_record_is_an_event_or_a_reject(spark):
    df = spark.createDataFrame(list(enumerate(RECORDS)), "seq bigint, content string")
    for mode, bad in (("now", {1: "no text", 2: "not a JSON object", 3: "not a JSON object", 4: "not a JSON object"}),
                      ("drop", {1: "no text", 2: "not a JSON object", 3: "not a JSON object", 4: "not a JSON object",
                                5: "no usable @timestamp", 6: "no usable @timestamp"})):
        rejects = event_rejects(df, on_bad_ts=mode)
        assert rejects.columns == REJECT_COLUMNS
        assert {r["seq"]: r["reason"] for r in rejects.collect()} == bad
        kept = {r["arrival_seq"] for r in parse_events(df, seq_col="seq", on_bad_ts=mode).collect()}
        assert kept == set(range(len(RECORDS))) - set(bad)
    assert event_rejects(df.limit(0)).collect() == []


def test_every_message_is_parsed_or_a_reject(spark):
    texts = [json.dumps({"type": "QUERY_STATUS"}), None, "x", "[]", "{}", json.dumps({"type": "RESET"}), json.dumps({"type": "ADD_RULE", "ruleId": [1]})]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, value string")
    rejects = {r["seq"]: r["reason"] for r in control_rejects(df).collect()}
    assert rejects == {1: "no text", 2: "not a JSON object", 3: "not a JSON object", 4: "no control type", 5: "there is no control type RESET"}
    assert {r["seq"] for r in parse_control(df, seq_col="seq").collect()} == set(range(len(texts))) - set(rejects)


def test_conditions_in_error_name_their_block(spark):
    def number(op="GREATER_THAN"):
        return cmp("v", op, 1)
    rules = RuleSet(rules_from_json(spark, [
        ("plain", 1, rule([block("SINGLE_EVENT", number())])),
        ("decided", 1, rule([block("SINGLE_EVENT", any_of(eq("type", "a"), number()))])),
        ("poisoned", 1, rule([block("SINGLE_EVENT", any_of(number(), eq("type", "a")))])),
        ("pattern", 2, rule([block("SINGLE_EVENT", regex("type", "("))])),
        ("grouped", 1, rule([block("SINGLE_EVENT", all_of(eq("type", "a"), number()))], group_by="missing"))]))
    df = spark.createDataFrame([(0, GOOD), (1, GOOD.replace('"x"', '"5"')), (2, GOOD.replace('"v"', '"w"'))], "seq bigint, content string")
    got = {(r["seq"], r["rule_id"], r["rule_version"], r["block_index"], r["record"] is not None)
           for r in match_rejects(parse_events(df, seq_col="seq"), rules.blocks).collect()}
    assert got == {(0, "plain", 1, 0, True), (0, "poisoned", 1, 0, True)} | {(i, "pattern", 2, 0, True) for i in range(3)}
    assert match_rejects(parse_events(df, seq_col="seq"), []).collect() == []
