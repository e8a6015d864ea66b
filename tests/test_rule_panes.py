"""Rule windows made from panes equal those made from every block result."""

import random

from helpers import make_events

from rulestream.operators.combine import _pane_outputs, _pane_windows, combine
from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import RuleSet, run_blocks
from rulestream.plans.catalog import all_blocks, any_blocks, block, composite_rule, eq, rule, seq_cond

KINDS = "abcd"


def random_events(spark, seed, n=160):
    r = random.Random(seed)
    # equal times, repeated texts, users with few and with many events
    return make_events(spark, [(r.randrange(0, 300) / 2, {"type": r.choice(KINDS), "user": r.choice(["u", "u", "u", "v", "w"])}) for _ in range(n)])


def single(kind):
    return block("SINGLE_EVENT", eq("type", kind))


RULES = [
    ("every", 1, rule([single("a"), single("b"), single("c")], group_by="user", size=30, slide=2, condition=all_blocks(0, 1, 2), severity=4)),
    ("uneven", 1, rule([single("a"), single("d")], group_by="user", size=25, slide=3, condition=any_blocks(0, 1))),
    ("gaps", 1, rule([single("a"), single("d")], group_by="user", size=3, slide=7, condition=all_blocks(0, 1))),
    ("walk", 1, rule([single(k) for k in KINDS], group_by="user", size=24, slide=4,
                     condition=composite_rule("AND", seq_cond((0, False), (1, False), (0, False), (2, False)), seq_cond((0, False), (3, True))))),
    ("mixed", 1, rule([block("THRESHOLD", eq("type", "a"), 10, 5, ["type"], THRESHOLD=2), single("b")], group_by="user", size=20, slide=4,
                      condition=seq_cond((0, False), (1, False)), severity=9)),
    ("mixed", 2, rule([single("c"), block("THRESHOLD", eq("type", "a"), 10, 5, ["type"], THRESHOLD=2)], group_by="user", size=20, slide=5,
                      condition=all_blocks(0, 1), severity=1)),
]


def rows(alerts):
    return sorted(repr((r["customer"], r["rule_id"], r["rule_version"], r["base_severity"], r["group_by"], r["match_ms"], r["window_start_ms"],
                        r["window_end_ms"], r["seen"], sorted(r["outputs"].items()))) for r in alerts.collect())


def test_panes_and_results_give_the_same_alerts(spark):
    for name in sorted({r[0] for r in RULES}):
        rs = RuleSet(rules_from_json(spark, [r for r in RULES if r[0] == name]))
        ensured = run_blocks(random_events(spark, name), rs)
        direct = rows(combine(ensured, rs.frame, rs.facts["max_seq"], True, 1))
        panes = rows(combine(ensured, rs.frame, rs.facts["max_seq"], True, None))
        assert panes == direct, name
        assert direct or name == "gaps", name


def test_no_block_results(spark):
    rs = RuleSet(rules_from_json(spark, RULES[:1]))
    none = run_blocks(random_events(spark, 1).limit(0), rs)
    assert combine(none, rs.frame, 0, True, None).collect() == []


def test_samples_are_not_copied_into_windows(spark):
    """Between the explosion into windows and the matches no column holds sample text."""
    rs = RuleSet(rules_from_json(spark, RULES[:1]))
    plan = combine(run_blocks(random_events(spark, 2), rs), rs.frame, 0, True, rs.facts["rule_fan"])._jdf.queryExecution().optimizedPlan().toString()
    generate = [line for line in plan.splitlines() if "Generate explode" in line and "sequence" in line]
    assert generate and not any("out#" in line for line in generate)


def test_windows_that_hold_the_same_are_one_row(spark):
    """600 windows per block result: the rows before the matches grow with the panes, not with the windows."""
    rs = RuleSet(rules_from_json(spark, [("fine", 1, rule([single("a"), single("b")], group_by="user", size=600, slide=1, condition=all_blocks(0, 1)))]))
    blocks = run_blocks(random_events(spark, 3), rs)
    panes = _pane_outputs(blocks)
    assert 0 < _pane_windows(panes).count() <= 3 * panes.count()
    direct = rows(combine(blocks, rs.frame, 0, True, 1))
    assert rows(combine(blocks, rs.frame, 0, True, None)) == direct and len(direct) > 600
