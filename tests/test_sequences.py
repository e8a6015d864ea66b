"""Sequence rule conditions (R7) against a brute-force walk.

Random windows of single-event block results and random sequence conditions
(repeated indices, notPresent entries, up to five entries) are run through
the batch plan; every (rule, group) verdict must equal a direct walk of the
reference semantics: sort by match time, find each wanted index at or after
the last matched position (inclusive), fail on a missing wanted index or a
present notPresent index.
"""

import random

from helpers import make_events

from rulestream.operators.rules import rules_from_json
from rulestream.plans.batch import run_rules
from rulestream.plans.catalog import block, eq, rule, seq_cond

N_IDX = 4


def walk(indices, entries):
    pos = 0
    for want, absent in entries:
        found = next((p for p in range(pos, len(indices)) if indices[p] == want), None)
        if absent:
            if found is not None:
                return False
        else:
            if found is None:
                return False
            pos = found
    return True


def seq_rule(entries):
    blocks = [block("SINGLE_EVENT", eq("check", str(i))) for i in range(N_IDX)]
    return rule(blocks, group_by="g", size=3600, slide=3600, condition=seq_cond(*entries))


def run_case(spark, seed, n_rules=10, n_groups=40):
    rnd = random.Random(seed)
    rules = []
    for r in range(n_rules):
        n = rnd.randint(1, 5)
        rules.append([(rnd.randrange(N_IDX), rnd.random() < 0.25) for _ in range(n)])
    specs, per_group = [], {}
    for g in range(n_groups):
        times = rnd.sample(range(0, 3000), rnd.randint(1, 9))
        for t in times:
            i = rnd.randrange(N_IDX)
            specs.append((t, {"g": f"g{g}", "check": str(i)}))
            per_group.setdefault(f"g=g{g}", []).append((t, i))
    rnd.shuffle(specs)  # arrival order differs from time order
    ev = make_events(spark, specs)
    rf = rules_from_json(spark, [(f"r{r}", 1, seq_rule(e)) for r, e in enumerate(rules)])
    got = {(a["rule_id"], a["group_by"]) for a in run_rules(ev, rf).collect()}
    want = set()
    for r, entries in enumerate(rules):
        for g, evs in per_group.items():
            if walk([i for _, i in sorted(evs)], entries):
                want.add((f"r{r}", g))
    return got, want


def test_sequences_match_brute_force(spark):
    for seed in (1, 2, 3):
        got, want = run_case(spark, seed)
        assert got == want, (seed, sorted(got ^ want)[:10])


def test_sequence_needs_exact_next_position(spark):
    # 0 then 1 then 2: the first 1 (t=1) is before the 0 (t=2), so the walk
    # must find the 1 at t=3 - the span of index 1 alone cannot tell.
    ev = make_events(spark, [(1, {"g": "a", "check": "1"}), (2, {"g": "a", "check": "0"}),
                             (3, {"g": "a", "check": "1"}), (4, {"g": "a", "check": "2"}),
                             (1, {"g": "b", "check": "1"}), (2, {"g": "b", "check": "0"}),
                             (4, {"g": "b", "check": "2"}), (5, {"g": "b", "check": "1"})])
    rf = rules_from_json(spark, [("r", 1, seq_rule([(0, False), (1, False), (2, False)]))])
    assert [a["group_by"] for a in run_rules(ev, rf).collect()] == ["g=a"]


def test_same_millisecond_results_follow_arrival(spark):
    # same match time: the event that arrived first counts first, whatever its block's index
    ev = make_events(spark, [(1, {"g": "a", "check": "1"}), (1, {"g": "a", "check": "0"}),
                             (1, {"g": "b", "check": "0"}), (1, {"g": "b", "check": "1"})])
    rf = rules_from_json(spark, [("r", 1, seq_rule([(0, False), (1, False)]))])
    assert [a["group_by"] for a in run_rules(ev, rf).collect()] == ["g=b"]
