"""Batch plan: events + rules -> block results -> alerts.

    events --match--> matched --block processors--> block results
        simple rules  -> alerts directly (R1, O1)
        complex rules -> rule windows -> rule condition -> alerts (R2-R7, O2)

Rule-set facts that shape the plan (largest THRESHOLD, longest sequence,
block types in use) are read from the rules frame, which is configuration
and is size-checked before anything is brought to the driver.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.operators import blocks as B
from rulestream.operators.alerts import simple_alerts
from rulestream.operators.combine import combine
from rulestream.operators.match import (MAX_BROADCAST_BLOCKS, MAX_COMPILED_BLOCKS, MAX_INLINE_BLOCKS, GuardIndex,
                                        match_compiled, match_dynamic, match_indexed)
from rulestream.operators.rules import rule_blocks


class RuleSet:
    """A parsed rule set, ready to plan with.

    Rules are configuration: the frame is brought to the driver once (its
    size checked first) and planning facts - largest THRESHOLD, longest
    sequence, block types in use - are read from it.  Rule sets above the
    compile limit stay distributed and are matched with a broadcast join.
    """

    def __init__(self, rules: DataFrame, limit: int = MAX_COMPILED_BLOCKS):
        rows = rules.limit(limit + 1).collect()
        n_blocks = sum(len(r["blocks"] or []) for r in rows)
        self.compiled = len(rows) <= limit and n_blocks <= limit
        if self.compiled:
            spark = rules.sparkSession
            self.frame = spark.createDataFrame(rows, rules.schema) if rows else rules
            self.blocks = []
            for r in rows:
                d = r.asDict(recursive=True)
                for b in d.pop("blocks") or []:
                    self.blocks.append({**d, **b})
            self.facts = _facts_from_rows([r.asDict(recursive=True) for r in rows])
        else:
            self.frame = rules
            self.blocks = None
            self.facts = rule_set_facts(rules)

    @cached_property
    def index(self) -> GuardIndex:
        """The guard index of the rule set, made on first use."""
        return GuardIndex(rule_blocks(self.frame, program=True))


def _facts_from_rows(rows: list[dict]) -> dict:
    types, thr, seq, fan, rule_fan = [], 0, 0, 0, 0
    for r in rows:
        size, slide = r.get("rule_window_size") or 0, r.get("rule_window_slide") or 0
        if size > 0 and slide > 0:
            rule_fan = max(rule_fan, -(-size // slide))
        for b in r.get("blocks") or []:
            if b.get("block_type") and b["block_type"] not in types:
                types.append(b["block_type"])
            thr = max(thr, b.get("threshold") or 0)
            size, slide = b.get("window_size") or 0, b.get("window_slide") or 0
            if size > 0 and slide > 0:
                fan = max(fan, -(-size // slide))
        for x in r.get("rule_program") or []:
            if x.get("op") == "seq":
                seq = max(seq, len(x.get("idx") or []))
    return {"n_rules": len(rows), "n_blocks": sum(len(r.get("blocks") or []) for r in rows),
            "max_threshold": thr, "max_seq": seq, "types": types, "max_fan": fan, "rule_fan": rule_fan,
            "any_complex": any(r.get("rule_type") == "COMPLEX" for r in rows),
            "any_simple": any(r.get("rule_type") != "COMPLEX" for r in rows)}


def rule_set_facts(rules: DataFrame) -> dict:
    """Planning facts of a large rule set, as one small aggregate."""
    r = rules.select(
        F.count(F.lit(1)).alias("n_rules"),
        F.sum("n_blocks").alias("n_blocks"),
        F.max(F.aggregate(F.transform("blocks", lambda b: F.coalesce(b["threshold"], F.lit(0))),
                          F.lit(0), lambda a, x: F.greatest(a, x))).alias("max_threshold"),
        F.max(F.aggregate(F.transform(F.coalesce("rule_program", F.array().cast(rules.schema["rule_program"].dataType)),
                                      lambda x: F.when(x["op"] == "seq", F.size(x["idx"])).otherwise(F.lit(0))),
                          F.lit(0), lambda a, x: F.greatest(a, x))).alias("max_seq"),
        F.array_distinct(F.flatten(F.collect_list(F.transform("blocks", lambda b: b["block_type"])))).alias("types"),
        F.max(F.when(F.col("rule_type") == "COMPLEX", 1).otherwise(0)).alias("any_complex"),
        F.max(F.when(F.col("rule_type") == "COMPLEX", 0).otherwise(1)).alias("any_simple"),
    ).first()
    return {"n_rules": r["n_rules"] or 0, "n_blocks": r["n_blocks"] or 0,
            "max_threshold": r["max_threshold"] or 0, "max_seq": r["max_seq"] or 0,
            "types": [t for t in (r["types"] or []) if t], "any_complex": bool(r["any_complex"]),
            "any_simple": bool(r["any_simple"])}


def block_results(matched: DataFrame, types: list[str], max_threshold: int,
                  max_fan: int | None = None) -> DataFrame:
    procs = B.processors(max_threshold, max_fan)
    parts = [procs[t](matched) for t in types if t in procs]
    if not parts:
        return B.single_event(matched.where(F.lit(False)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_blocks(events: DataFrame, rules, mode: str = "auto", cache_matched: bool = True) -> DataFrame:
    """Events + rules (frame or RuleSet) -> block results."""
    rs = rules if isinstance(rules, RuleSet) else RuleSet(rules)
    facts = rs.facts
    inline = False
    if rs.compiled and mode == "auto" and len(rs.blocks) > MAX_INLINE_BLOCKS and not events.isStreaming:
        matched = match_indexed(events, rs.frame, rs.blocks)
    elif rs.compiled and mode in ("auto", "compiled"):
        matched, inline = match_compiled(events, rs.blocks), True
    else:
        matched = match_dynamic(events, rs.index).drop("program")
    types = facts["types"]
    # THRESHOLD reads the matches a second time on few columns, without the event text: where conditions
    # are part of the projection, evaluating them again costs less than keeping every match
    consumers = sum({"THRESHOLD": 1 if inline else 2, "UNIQUE_THRESHOLD": 3}.get(t, 1) for t in types)
    if cache_matched and consumers > 1:
        # several block processors read the matches: scan and match once
        matched = matched.persist(StorageLevel.MEMORY_AND_DISK)
    return block_results(matched, types, facts["max_threshold"], facts.get("max_fan"))


def run_rules(events: DataFrame, rules, mode: str = "auto", materialize: bool = True) -> DataFrame:
    """Events + rules (frame or RuleSet) -> alert rows (see ``operators.alerts``)."""
    rs = rules if isinstance(rules, RuleSet) else RuleSet(rules)
    facts = rs.facts
    blocks = run_blocks(events, rs, mode)
    if not facts["any_complex"]:
        return simple_alerts(blocks)
    small = facts["n_rules"] <= MAX_BROADCAST_BLOCKS
    if not facts["any_simple"]:
        return combine(blocks, rs.frame, facts["max_seq"], small, facts.get("rule_fan"))
    if materialize:
        # block results feed both simple alerts and rule windows: write them
        # once to the shared checkpoint folder (reliable, lineage cut)
        # instead of recomputing the event pipeline per use.
        blocks = blocks.checkpoint(eager=True)
    return simple_alerts(blocks).unionByName(combine(blocks, rs.frame, facts["max_seq"], small, facts.get("rule_fan")))
