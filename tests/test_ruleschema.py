"""The declarative rule schema: whole rules, right and wrong, and what is reported where."""

import json

from rulestream.operators.rules import rules_from_json
from rulestream.operators.ruleschema import schema_violations
from rulestream.operators.validate import rule_errors
from rulestream.plans.catalog import all_blocks, all_of, any_blocks, block, cmp, composite_rule, eq, regex, rule, seq_cond

ONE = block("SINGLE_EVENT", eq("type", "error"))
THRESHOLD = block("THRESHOLD", eq("type", "error"), 60, 30, ["user"], THRESHOLD=5)


def several(condition, **more):
    return {**json.loads(rule([ONE, THRESHOLD], group_by="user", size=60, slide=30, condition=condition)), **more}


def of(*blocks, **more):
    return {"blocks": list(blocks), **more}


VALID = {
    "single event": of(ONE),
    "severity": of(ONE, baseSeverity=3, windowSize=0),
    "threshold": of(THRESHOLD, groupByField="user"),
    "unique threshold": of(block("UNIQUE_THRESHOLD", regex("a", ".*"), 60, 30, ["user"], THRESHOLD=2, UNIQUE_FIELD="u"), groupByField="user"),
    "anomaly": of(block("SIMPLE_ANOMALY", cmp("v", "LESS_THAN", 2.5), 60, SIMPLE_ANOMALY_THRESHOLD=2), groupByField="user"),
    "drop to zero": of(block("DROP_TO_ZERO", all_of(eq("a", "b"), eq("c", "")), 60), groupByField="user"),
    "sequence": several(seq_cond((0, False), (1, True))),
    "composite": several(composite_rule("OR", all_blocks(0, 1), any_blocks(1))),
}
DEEP = {"@class": "x.EqualCondition", "key": "", "value": "v"}
for _ in range(7):
    DEEP = all_of(DEEP, eq("a", "b"))
INVALID = {
    "no object": ([], ["$ is not a JSON object"]),
    "no blocks": ({}, ["$ blocks is missing"]),
    "empty blocks": (of(), ["$ blocks has too few entries"]),
    "null block": (of(None), ["$.blocks[0] is not a JSON object"]),
    "grouped single event": (of(ONE, groupByField="user"), ["$ groupByField is not allowed"]),
    "number as text": (of({**THRESHOLD, "windowSize": "60"}), ["$.blocks[0] windowSize is not of type integer"]),
    "null number": (of(ONE, baseSeverity=None), ["$ baseSeverity is not of type integer"]),
    "fraction": (of({**THRESHOLD, "windowSlide": 1.5}), ["$.blocks[0] windowSlide is not of type integer"]),
    "threshold as number": (of({**THRESHOLD, "parameters": {"THRESHOLD": 5}}), ["$.blocks[0].parameters THRESHOLD is not of type string"]),
    "foreign property": (of({**ONE, "windowSize": 5}), ["$.blocks[0] windowSize is not allowed"]),
    "no condition": (of({"type": "DROP_TO_ZERO", "windowSize": 5}), ["$.blocks[0] condition is missing"]),
    "unknown type": (of({**ONE, "type": "SOME_EVENT"}), ["$.blocks[0] is no known block"]),
    "unknown condition": (of(block("SINGLE_EVENT", {"@class": "x.Like", "key": "k"})), ["$.blocks[0].condition is no known condition"]),
    "property in a condition": (of(block("SINGLE_EVENT", {**eq("a", "b"), "regex": "x"})), ["$.blocks[0].condition regex is not allowed"]),
    "one of one": (of(block("SINGLE_EVENT", all_of(eq("a", "b")))), ["$.blocks[0].condition conditions has too few entries"]),
    "comparison": (of(block("SINGLE_EVENT", cmp("v", "EQUAL", "3"))),
                   ["$.blocks[0].condition thresholdValue is not of type number", "$.blocks[0].condition type is none of the allowed values"]),
    "deep": (of(block("SINGLE_EVENT", DEEP)), ["$.blocks[0].condition" + ".conditions[0]" * 7 + " key is too short"]),
    "no rule condition": ({k: v for k, v in several(all_blocks(0)).items() if k != "ruleCondition"}, ["$ ruleCondition is missing"]),
    "indices": (several(all_blocks(0, 0, -1)), ["$.ruleCondition blockIndices has an entry that is too small", "$.ruleCondition blockIndices has an entry twice"]),
    "sequence entry": (several(seq_cond((-1, False))), ["$.ruleCondition.conditions[0] blockIndex is too small"]),
}


def test_rules_of_every_shape(spark):
    cases = {name: (r, []) for name, r in VALID.items()} | INVALID
    names = {json.dumps(r): name for name, (r, _) in cases.items()}
    got = {name: [] for name in cases}
    for row in schema_violations(spark.createDataFrame([(t,) for t in names for _ in range(2)], "content string")).collect():
        got[names[row["content"]]].append(f"{row['path']} {row['problem']}")
    assert {n: sorted(g) for n, g in got.items()} == {n: sorted(e) for n, (_, e) in cases.items()}


def test_odd_texts_and_no_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("{broken",), ('{"blocks":[],"blocks":[]}',), ("3",)], "content string")
    got = {(r["content"], r["path"], r["problem"]) for r in schema_violations(df).collect()}
    assert got == {(t, "$", "is not a JSON object") for t in ("", "{broken", '{"blocks":[],"blocks":[]}', "3")}
    assert schema_violations(df.limit(0)).collect() == []


def test_strict_adds_the_schema_to_the_checks(spark):
    rules = rules_from_json(spark, [("good", 1, json.dumps(VALID["threshold"])), ("bad", 1, json.dumps(INVALID["one of one"][0])),
                                    ("same", 2, json.dumps(INVALID["one of one"][0]))])
    assert {r["rule_id"]: r["errors"] for r in rule_errors(rules).collect()} == {"good": [], "bad": [], "same": []}
    error = "schema: $.blocks[0].condition conditions has too few entries"
    assert {r["rule_id"]: r["errors"] for r in rule_errors(rules, strict=True).collect()} == {"good": [], "bad": [error], "same": [error]}
