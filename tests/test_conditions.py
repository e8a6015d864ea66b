"""Condition programs: compiled and higher-order forms agree; error semantics."""

import json

import pytest
from pyspark.sql import functions as F

from rulestream.functions.conditions import compile_condition, eval_condition, flatten_trees
from rulestream.plans.catalog import all_of, any_of, cmp, eq, regex

EVENTS = [
    {"a": "x", "n": "5", "s": "hello"},
    {"a": "y", "n": "abc", "s": "help"},
    {"a": "x", "n": "", "s": ""},
    {"n": "0.1"},
    {"a": "x", "n": "15.5", "s": "h.llo"},
]

CASES = [
    (eq("a", "x"), [True, False, True, False, True]),
    (regex("s", "^hel"), [True, True, False, False, False]),
    (regex("missing", ".*"), [True] * 5),                        # missing field = '' (Q6)
    (cmp("n", "GREATER_THAN", 4), [True, False, False, False, True]),   # 'abc' is an error
    (cmp("n", "GREATER_THAN", 0.1), [True, False, False, True, True]),  # float32 0.1 > 0.1 (Q7)
    (cmp("n", "LESS_THAN_OR_EQUAL", 5), [True, False, False, True, False]),
    # OR(error, true) -> no match; OR(true, error) -> match
    (any_of(cmp("n", "GREATER_THAN", 1), eq("a", "y")), [True, False, False, False, True]),
    (any_of(eq("a", "y"), cmp("n", "GREATER_THAN", 1)), [True, True, False, False, True]),
    # AND(false, error) -> false; nested
    (all_of(eq("a", "x"), any_of(regex("s", "l{2}"), cmp("n", "GREATER_THAN_OR_EQUAL", 15.5))),
     [True, False, False, False, True]),
    (regex("s", "[unclosed"), [False] * 5),                      # bad pattern never matches
]


@pytest.fixture(scope="module")
def frames(spark):
    ev = spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(EVENTS)], "i int, j string") \
        .select("i", F.from_json("j", "map<string,string>").alias("fields"))
    conds = spark.createDataFrame([(k, json.dumps(c)) for k, (c, _) in enumerate(CASES)], "k int, js string")
    progs = {r["k"]: r["p"] for r in flatten_trees(conds, ["k"], "js", "cond", "p").collect()}
    return ev, progs


@pytest.mark.parametrize("k", range(len(CASES)))
def test_compiled_and_hof_agree(spark, frames, k):
    ev, progs = frames
    expected = CASES[k][1]
    compiled = ev.select("i", compile_condition(progs[k], lambda key: F.col("fields")[key]).alias("m"))
    got = [r["m"] for r in compiled.orderBy("i").collect()]
    assert got == expected
    prog_col = F.lit(None)  # program as data: join it on a one-row frame
    pf = spark.createDataFrame([(progs[k],)], "p array<struct<op:string,key:string,val:string,num:double,n:int>>")
    hof = ev.crossJoin(pf).select("i", eval_condition(F.col("p"), lambda key: F.coalesce(
        F.col("fields")[key], F.lit(""))).alias("m"))
    del prog_col
    assert [r["m"] for r in hof.orderBy("i").collect()] == expected


def test_deep_nesting(spark):
    c = eq("a", "x")
    for i in range(12):
        c = all_of(c, any_of(eq("a", "x"), eq("a", "z"))) if i % 2 else any_of(c, eq("a", "never"))
    conds = spark.createDataFrame([(0, json.dumps(c))], "k int, js string")
    prog = flatten_trees(conds, ["k"], "js", "cond", "p").first()["p"]
    assert len(prog) == 1 + 12 * 2 + 6 * 2
    ev = spark.createDataFrame([(json.dumps({"a": "x"}),), (json.dumps({"a": "q"}),)], "j string") \
        .select(F.from_json("j", "map<string,string>").alias("fields"))
    got = [r["m"] for r in ev.select(compile_condition(prog, lambda k: F.col("fields")[k]).alias("m")).collect()]
    assert got == [True, False]


def _deep(depth):
    tree = '{"@class":"EqualCondition","key":"a","value":"1"}'
    for k in range(depth):
        tree = '{"@class":"CompositeCondition","type":"%s","conditions":[%s,{"@class":"EqualCondition","key":"b","value":"%d"}]}' % ("OR" if k % 2 else "AND", tree, k % 3)
    return tree


def test_deep_tree_is_whole(spark):
    depth = 70
    df = spark.createDataFrame([("t", _deep(depth))], "k string, js string")
    prog = flatten_trees(df, ["k"], "js", "cond", "p").first()["p"]
    assert len(prog) == 2 * depth + 1

    def want(a, b):
        v = a == "1"
        for k in range(depth):
            v = (v or b == str(k % 3)) if k % 2 else (v and b == str(k % 3))
        return v
    rows = [(a, b) for a in ("0", "1") for b in ("0", "1", "2", "9")]
    ev = spark.createDataFrame(rows, "a string, b string")
    got = {(r.a, r.b): r.m for r in ev.select("a", "b", compile_condition(prog, lambda n: F.col(n)).alias("m")).collect()}
    assert got == {r: want(*r) for r in rows}


def test_composite_without_operands_never_matches(spark):
    lone = [{"op": "and", "n": 1}]
    none = [{"op": "and", "n": 0}]
    df = spark.range(1)
    assert [df.select(compile_condition(p, lambda n: F.lit("x")).alias("m")).first().m for p in (lone, none)] == [False, False]
