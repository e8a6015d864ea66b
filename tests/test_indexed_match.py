"""Guard-indexed matching (large collected rule sets) agrees with compiled matching."""

import random

from helpers import make_events

from rulestream.operators.match import MAX_INLINE_BLOCKS, _guards, match_compiled, match_indexed
from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import RuleSet
from rulestream.plans.catalog import all_of, any_of, block, cmp, eq, regex, rule


def test_guards_of_programs():
    prog = [{"op": "eq", "key": "a", "val": "1"}, {"op": "eq", "key": "b", "val": "x"},
            {"op": "and", "n": 2}]
    assert _guards(prog) == [("a", frozenset({"1"})), ("b", frozenset({"x"}))]
    prog = [{"op": "eq", "key": "a", "val": "1"}, {"op": "eq", "key": "a", "val": "2"},
            {"op": "or", "n": 2}]
    assert _guards(prog) == [("a", frozenset({"1", "2"}))]
    prog = [{"op": "eq", "key": "a", "val": "1"}, {"op": "regex", "key": "a", "val": "x"},
            {"op": "or", "n": 2}]
    assert _guards(prog) == []


def _conditions(i):
    k = eq("k", str(i % 7))
    return [
        all_of(eq("type", ["a", "b", "c"][i % 3]), k),
        k,
        any_of(all_of(k, eq("type", "a")), all_of(eq("k", str((i + 1) % 7)), cmp("v", "GREATER_THAN", 3))),
        regex("type", "^[ab]"),
        all_of(eq("missing", ""), cmp("v", "LESS_THAN", 5)),
        any_of(eq("type", "c"), cmp("v", "GREATER_THAN_OR_EQUAL", 8)),
    ][i % 6]


def test_indexed_equals_compiled(spark):
    rnd = random.Random(7)
    n = MAX_INLINE_BLOCKS + 8
    rules = [(f"r{i}", 1, rule([block("SINGLE_EVENT", _conditions(i))],
                                group_by="type" if i % 5 == 0 else None)) for i in range(n)]
    specs = []
    for t in range(120):
        f = {"type": rnd.choice(["a", "b", "c", ""]), "k": str(rnd.randrange(8)), "v": str(rnd.randrange(12))}
        if rnd.random() < 0.2:
            del f["k"]
        specs.append((t, f))
    ev = make_events(spark, specs)
    rs = RuleSet(rules_from_json(spark, rules))
    cols = ["rule_id", "block_index", "group_by", "arrival_seq"]
    a = sorted(tuple(r) for r in match_indexed(ev, rs.frame, rs.blocks).select(*cols).collect())
    b = sorted(tuple(r) for r in match_compiled(ev, rs.blocks).select(*cols).collect())
    assert a == b
    assert len(a) > 100


def test_indexed_stream_equals_batch(spark):
    from test_streaming import _lines, run_stream

    from rulestream.plans.batch import run_blocks
    from rulestream.sources.events import parse_events
    rnd = random.Random(3)
    n = MAX_INLINE_BLOCKS + 4
    rs = RuleSet(rules_from_json(spark, [(f"r{i}", 1, rule([block("SINGLE_EVENT", _conditions(i))]))
                                         for i in range(n)]))
    specs = [(t, {"type": rnd.choice(["a", "b", "c"]), "k": str(rnd.randrange(8)), "v": str(rnd.randrange(12))})
             for t in range(60)]
    lines = _lines(specs)
    got = sorted((a["rule_id"], a["match_ms"]) for a in run_stream(spark, [lines[:30], lines[30:]], rule_set=rs))
    batch = parse_events(spark.createDataFrame([(x,) for x in lines], "content string"), on_bad_ts="drop")
    want = sorted((r["rule_id"], r["match_ms"]) for r in run_blocks(batch, rs).collect())
    assert got == want and len(got) > 20


def _events_and_rules(spark, n, seed=11):
    rnd = random.Random(seed)
    rules = [(f"r{i}", 1, rule([block("SINGLE_EVENT", _conditions(i))], group_by="type" if i % 5 == 0 else None))
             for i in range(n)]
    rules.append(("deep", 1, rule([block("SINGLE_EVENT", any_of(
        all_of(eq("k", "1"), any_of(eq("type", "a"), eq("type", "b"))), all_of(eq("type", "b"), cmp("v", "LESS_THAN", 4))))])))
    specs = []
    for t in range(150):
        f = {"type": rnd.choice(["a", "b", "c", ""]), "k": str(rnd.randrange(8)), "v": rnd.choice([str(rnd.randrange(12)), "x"])}
        if rnd.random() < 0.2:
            del f[rnd.choice(["k", "type"])]
        specs.append((t, f))
    return make_events(spark, specs), RuleSet(rules_from_json(spark, rules))


COLS = ["rule_id", "block_index", "group_by", "arrival_seq"]


def test_guard_index_as_data_equals_compiled(spark):
    from rulestream.operators.match import match_dynamic
    ev, rs = _events_and_rules(spark, 46)
    want = sorted(tuple(r) for r in match_compiled(ev, rs.blocks).select(*COLS).collect())
    for limit in (20000, 10):  # one broadcast; a planned equi-join and chunks of blocks without a guard
        m = match_dynamic(ev, rs.index, limit)
        assert sorted(tuple(r) for r in m.select(*COLS).collect()) == want and len(want) > 100
    plan = match_dynamic(ev, rs.index)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_guards_as_data_equal_guards_on_the_driver(spark):
    from pyspark.sql import functions as F

    from rulestream.operators.guards import guard_alternatives
    from rulestream.operators.rules import rule_blocks
    _, rs = _events_and_rules(spark, 30)
    for r in rule_blocks(rs.frame).select("cond", guard_alternatives(F.col("cond")).alias("g")).collect():
        got = {(a["key"], frozenset(a["vals"])) for a in r["g"]}
        assert got == {(k, v) for k, v in _guards(r["cond"]) if "" not in v}, r["cond"]


def test_streams_with_large_and_with_shuffled_rule_sets(spark, tmp_path):
    from test_streaming import _lines, run_stream

    from rulestream.plans.batch import run_blocks
    from rulestream.sources.events import parse_events
    from rulestream.streaming.pipeline import snapshot_rule_side, write_rule_snapshot
    rnd = random.Random(5)
    rules = rules_from_json(spark, [(f"r{i}", 1, rule([block("SINGLE_EVENT", _conditions(i))])) for i in range(12)])
    lines = _lines([(t, {"type": rnd.choice(["a", "b", "c"]), "k": str(rnd.randrange(8)), "v": str(rnd.randrange(12))}) for t in range(40)])
    batch = parse_events(spark.createDataFrame([(x,) for x in lines], "content string"), on_bad_ts="drop")
    want = sorted((r["rule_id"], r["match_ms"]) for r in run_blocks(batch, rules).collect())
    large = RuleSet(rules, limit=3)  # stands for a rule set that is too large to compile
    assert large.blocks is None
    got = sorted((a["rule_id"], a["match_ms"]) for a in run_stream(spark, [lines], rule_set=large))
    assert got == want and len(got) > 20
    snap = str(tmp_path)
    try:
        write_rule_snapshot(rules, snap, limit=3)
        raise AssertionError("published more rows than the bound")
    except ValueError:
        pass
    write_rule_snapshot(rules, snap, limit=None)
    got = run_stream(spark, [lines], rule_side=snapshot_rule_side(spark, snap), broadcast_rules=False)
    assert sorted((a["rule_id"], a["match_ms"]) for a in got) == want


def test_two_necessary_fields_guard_a_block(spark):
    """A block of two equalities meets only the events that carry both; blocks of one rule number keep their own."""
    from pyspark.sql import functions as F

    from rulestream.operators.guards import with_pairs
    from rulestream.operators.match import match_dynamic
    rules = [(f"r{u}.{k}", 1, rule([block("SINGLE_EVENT", all_of(eq("user", f"u{u}"), eq("k", str(k)), cmp("v", "GREATER_THAN", 2)))])) for u in range(6) for k in range(5)]
    rules += [("one", 1, rule([block("SINGLE_EVENT", eq("user", "u1"))])), ("none", 1, rule([block("SINGLE_EVENT", cmp("v", "GREATER_THAN", 3))])),
              ("twice", 1, rule([block("SINGLE_EVENT", all_of(eq("user", "u2"), eq("k", "1")))])), ("twice", 1, rule([block("SINGLE_EVENT", all_of(eq("user", "u3"), eq("k", "2")))])),
              ("same", 1, rule([block("SINGLE_EVENT", all_of(eq("k", "1"), eq("k", "2")))])), ("empty", 1, rule([block("SINGLE_EVENT", all_of(eq("user", "u4"), eq("k", "")))]))]
    specs = [(t, {"user": f"u{t % 7}", "k": str(t % 5), "v": str(t % 6)} if t % 9 else {"user": f"u{t % 7}", "v": "4"}) for t in range(210)]
    ev, rs = make_events(spark, specs), RuleSet(rules_from_json(spark, rules))
    want = sorted(tuple(r) for r in match_compiled(ev, rs.blocks).select(*COLS).collect())
    assert want and {r[0] for r in want} >= {"one", "none", "twice", "empty"}
    for limit in (20000, 3):
        assert sorted(tuple(r) for r in match_dynamic(ev, rs.index, limit).select(*COLS).collect()) == want
    assert set(rs.index.fields) >= {("user", "k"), ("user", "")}
    rows, met = rs.index.frame.where(F.col("rule_id").startswith("r")), rs.index.met_by(ev, False).select("g.*")
    one = with_pairs(ev, False, rs.index.keys).select("g.*")
    assert 5 * met.join(rows, ["gk", "gv", "hk", "hv"]).count() <= 6 * 5 * 210 // 6 < one.join(rows, ["gk", "gv"]).count() + 210
