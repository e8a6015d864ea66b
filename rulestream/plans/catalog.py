"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads the whole ``events`` table (through the S7 adapter:
customer = user_id % 5, fields user / type / value / k / event_id) and runs
one rule set; rules are JSON, exactly as a control message would carry them.
Outputs are flat rows (no JSON text, no processing time) so they can be
compared value by value with the SQL oracle.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.functions.windows import sec_to_ms, sliding_starts
from rulestream.operators import blocks as B
from rulestream.operators.alerts import flat_alerts
from rulestream.operators.match import match_compiled, match_dynamic, match_joined
from rulestream.operators.rules import parse_rules, rules_from_json
from rulestream.plans.batch import RuleSet, run_blocks, run_rules
from rulestream.session import ensure_checkpoint_dir
from rulestream.sources.events import read_events_table

PKG = "rulestream.conditions."
HOUR = 3600
DAY = 24 * HOUR


# ---------------------------------------------------------------------------
# rule JSON builders (the public rule format)
# ---------------------------------------------------------------------------

def eq(key, value):
    return {"@class": PKG + "EqualCondition", "key": key, "value": value}


def regex(key, rx):
    return {"@class": PKG + "RegexCondition", "key": key, "regex": rx}


def cmp(key, op, threshold):
    return {"@class": PKG + "ComparisonCondition", "key": key, "thresholdValue": threshold, "type": op}


def all_of(*cs):
    return {"@class": PKG + "CompositeCondition", "type": "AND", "conditions": list(cs)}


def any_of(*cs):
    return {"@class": PKG + "CompositeCondition", "type": "OR", "conditions": list(cs)}


def block(btype, cond, size=None, slide=None, agg=None, **params):
    b = {"type": btype, "condition": cond}
    if size is not None:
        b["windowSize"] = size
    if slide is not None:
        b["windowSlide"] = slide
    if agg is not None:
        b["aggregationGroupingFields"] = agg
    if params:
        b["parameters"] = {k: str(v) for k, v in params.items()}
    return b


def rule(blocks, group_by=None, size=None, slide=None, condition=None, severity=None):
    r = {"blocks": blocks}
    if group_by:
        r["groupByField"] = group_by
    if size is not None:
        r["windowSize"] = size
    if slide is not None:
        r["windowSlide"] = slide
    if condition is not None:
        r["ruleCondition"] = condition
    if severity is not None:
        r["baseSeverity"] = severity
    return json.dumps(r)


def seq_cond(*entries):
    return {"@class": "rulestream.rules.SequenceRuleCondition",
            "conditions": [{"blockIndex": i, "notPresent": bool(neg)} for i, neg in entries]}


def all_blocks(*idx):
    return {"@class": "rulestream.rules.AllBlocksOccurredRuleCondition", "blockIndices": list(idx)}


def any_blocks(*idx):
    return {"@class": "rulestream.rules.AnyBlocksOccurredRuleCondition", "blockIndices": list(idx)}


def composite_rule(kind, *conds):
    return {"@class": "rulestream.rules.CompositeRuleCondition", "type": kind, "conditions": list(conds)}


# ---------------------------------------------------------------------------
# rule sets of the registered queries
# ---------------------------------------------------------------------------

RULES = {
    "single_event": [("err", 1, rule([block("SINGLE_EVENT", eq("type", "error"))]))],
    "nested_condition": [("nested", 1, rule([block("SINGLE_EVENT", all_of(
        any_of(eq("type", "purchase"), cmp("value", "GREATER_THAN", 45.5)),
        regex("k", "^[1-4]")))]))],
    "threshold": [("thr24", 1, rule([block("THRESHOLD", eq("type", "error"), DAY, DAY // 2, ["user"],
                                            THRESHOLD=5)], group_by="customer"))],
    "threshold_small": [("thr6", 1, rule([block("THRESHOLD", eq("type", "error"), 6 * HOUR, 2 * HOUR, ["user"],
                                                THRESHOLD=3)], group_by="customer"))],
    "threshold_fine": [("thrfine", 1, rule([block("THRESHOLD", eq("type", "error"), 6 * HOUR, HOUR // 2, ["user"],
                                                 THRESHOLD=4)], group_by="customer"))],
    "unique_threshold": [("uniq", 1, rule([block("UNIQUE_THRESHOLD", eq("type", "error"), DAY, DAY // 2, ["user"],
                                                 THRESHOLD=3, UNIQUE_FIELD="user")], group_by="customer"))],
    "unique_threshold_fine": [("uniqfine", 1, rule([block("UNIQUE_THRESHOLD", eq("type", "error"), 6 * HOUR, HOUR // 2, ["user"],
                                                         THRESHOLD=4, UNIQUE_FIELD="user")], group_by="customer"))],
    # a THRESHOLD beyond the head limit over keys that hold a fifth of all events each, beside a small one
    "threshold_large": [("thrlarge", 1, rule([block("THRESHOLD", regex("type", ".*"), 20 * DAY, 5 * DAY, ["type"],
                                                    THRESHOLD=1200)], group_by="customer")),
                        ("thr24", 1, rule([block("THRESHOLD", eq("type", "error"), DAY, DAY // 2, ["user"],
                                                 THRESHOLD=5)], group_by="customer"))],
    "anomaly_6h": [("anom6", 1, rule([block("SIMPLE_ANOMALY", regex("type", ".*"), 6 * HOUR, 0,
                                            SIMPLE_ANOMALY_THRESHOLD=2)], group_by="type"))],
    "anomaly_1h": [("anom1", 1, rule([block("SIMPLE_ANOMALY", regex("type", ".*"), HOUR, 0,
                                            SIMPLE_ANOMALY_THRESHOLD=2)], group_by="type"))],
    "drop_to_zero": [("drop2", 1, rule([block("DROP_TO_ZERO", regex("type", ".*"), 2 * HOUR, 0)],
                                       group_by="type"))],
    "sequence": [("seq", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                  block("SINGLE_EVENT", eq("type", "purchase"))],
                                 group_by="user", size=DAY, slide=DAY // 2,
                                 condition=seq_cond((0, False), (1, False)), severity=5))],
    "all_blocks": [("all3", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                     block("SINGLE_EVENT", eq("type", "signup")),
                                     block("SINGLE_EVENT", eq("type", "view"))],
                                    group_by="user", size=6 * HOUR, slide=3 * HOUR,
                                    condition=all_blocks(0, 1, 2), severity=3))],
    # 72 rule windows per block result
    "rule_windows_fine": [("fine72", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                              block("SINGLE_EVENT", eq("type", "signup")),
                                              block("SINGLE_EVENT", eq("type", "view"))],
                                             group_by="user", size=6 * HOUR, slide=HOUR // 12,
                                             condition=all_blocks(0, 1, 2), severity=3))],
    "composite": [("comp", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                    block("SINGLE_EVENT", eq("type", "purchase")),
                                    block("SINGLE_EVENT", eq("type", "signup")),
                                    block("SINGLE_EVENT", eq("type", "click"))],
                                   group_by="user", size=6 * HOUR, slide=3 * HOUR,
                                   condition=composite_rule("OR", all_blocks(0, 1), all_blocks(2, 3)),
                                   severity=4))],
    "any_blocks": [("any2", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                     block("SINGLE_EVENT", eq("type", "purchase"))],
                                    group_by="user", size=12 * HOUR, slide=12 * HOUR,
                                    condition=any_blocks(0, 1), severity=1))],
    "sequence_absent": [("seqnp", 1, rule([block("SINGLE_EVENT", eq("type", "error")),
                                           block("SINGLE_EVENT", eq("type", "purchase")),
                                           block("SINGLE_EVENT", eq("type", "click"))],
                                          group_by="user", size=DAY, slide=DAY // 2,
                                          condition=seq_cond((0, False), (1, False), (2, True)), severity=6))],
    "threshold_then_single": [("thrseq", 1, rule([
        block("THRESHOLD", eq("type", "error"), 6 * HOUR, 6 * HOUR, ["type"], THRESHOLD=2),
        block("SINGLE_EVENT", eq("type", "purchase"))],
        group_by="user", size=12 * HOUR, slide=12 * HOUR, condition=seq_cond((0, False), (1, False)),
        severity=9))],
    # samples in alert JSON: the rule's group-by field is one that events also have
    "samples": [("thruser", 1, rule([block("THRESHOLD", regex("type", ".*"), DAY, DAY // 2, ["type"], THRESHOLD=3)],
                                    group_by="user"))],
    # conditions that some records break: before and after an entry that decides
    "breakable": [("ordered", 1, rule([block("SINGLE_EVENT", all_of(eq("type", "error"), cmp("value", "GREATER_THAN", 1)))])),
                  ("poisoned", 1, rule([block("SINGLE_EVENT", any_of(cmp("value", "GREATER_THAN", 1), eq("type", "click")))],
                                       group_by="user"))],
    "feedback": [("fb", 1, rule([block("SINGLE_EVENT", all_of(eq("source", "rulestream"),
                                                              eq("matchedRuleId", "err")))]))],
}

# The five event types of the driver's events table.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _generated_rule(i: int) -> tuple[str, int, str]:
    """Rule i of the 100-rule set: it watches events whose k is i, with one
    of four condition shapes (equality, float comparison, regex, OR of ANDs)."""
    k = eq("k", str(i))
    form = i % 4
    if form == 0:
        c = all_of(eq("type", EVENT_TYPES[i % 5]), k)
    elif form == 1:
        c = all_of(k, cmp("value", "GREATER_THAN", 50))
    elif form == 2:
        c = all_of(k, regex("type", "^(click|view)$"))
    else:
        c = any_of(all_of(k, eq("type", "error")), all_of(k, cmp("value", "LESS_THAN", 5)))
    return (f"r{i:03d}", 1, rule([block("SINGLE_EVENT", c)]))


RULES["single_event_100"] = [_generated_rule(i) for i in range(100)]

# A control log for the effective-dated replay query: version 1 watches
# errors from 1 January, version 2 watches purchases from 15 January.
HISTORY_LOG = [
    json.dumps({"timestamp": "2024-01-01T00:00:00.000Z", "type": "ADD_RULE", "ruleId": "hist", "ruleVersion": 1,
                "controlSchemaVersion": 1, "content": rule([block("SINGLE_EVENT", eq("type", "error"))])}),
    json.dumps({"timestamp": "2024-01-15T00:00:00.000Z", "type": "ADD_RULE", "ruleId": "hist", "ruleVersion": 2,
                "controlSchemaVersion": 1, "content": rule([block("SINGLE_EVENT", eq("type", "purchase"))])}),
]


# A windowed rule that is resized, and a multi-block rule that changes its blocks and windows, on 15 January.
HISTORY_DATES = ("2024-01-01", "2024-01-15")
HISTORY_VERSIONS = {
    "histthr": [rule([block("THRESHOLD", eq("type", "error"), DAY, DAY // 2, ["user"], THRESHOLD=5)], group_by="customer"),
                rule([block("THRESHOLD", eq("type", "purchase"), 6 * HOUR, 3 * HOUR, ["user"], THRESHOLD=3)], group_by="customer")],
    "histall": [rule([block("SINGLE_EVENT", eq("type", "error")), block("SINGLE_EVENT", eq("type", "signup"))],
                     group_by="user", size=6 * HOUR, slide=3 * HOUR, condition=all_blocks(0, 1), severity=2),
                rule([block("SINGLE_EVENT", eq("type", "view")), block("SINGLE_EVENT", eq("type", "click"))],
                     group_by="user", size=8 * HOUR, slide=8 * HOUR, condition=all_blocks(0, 1), severity=7)],
}
HISTORY_WINDOWS_LOG = [
    json.dumps({"timestamp": f"{HISTORY_DATES[v]}T00:00:00.000Z", "type": "ADD_RULE", "ruleId": rule_id, "ruleVersion": v + 1,
                "controlSchemaVersion": 1, "content": versions[v]}) for v in (0, 1) for rule_id, versions in HISTORY_VERSIONS.items()]


def _spark_rules(spark: SparkSession, name: str) -> DataFrame:
    return rules_from_json(spark, RULES[name])


_RULE_SETS: dict = {}


def rule_set(spark: SparkSession, name: str) -> RuleSet:
    """Parsed rule set of a catalogue entry, parsed once per session (a rule
    store is loaded once and then serves every query)."""
    key = (id(spark), name)
    if key not in _RULE_SETS:
        _RULE_SETS[key] = RuleSet(_spark_rules(spark, name))
    return _RULE_SETS[key]


def _flat_blocks(b: DataFrame) -> DataFrame:
    return b.select("rule_id", "customer", "group_by", "block_index", "phase", "window_start_ms",
                    "window_end_ms", "match_ms", "event_count",
                    F.size(F.coalesce("matching_events", F.array())).cast("bigint").alias("n_keys"),
                    "match_message")


def _blocks_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat_blocks(run_blocks(read_events_table(spark, sf_dir), rule_set(spark, name)))
    return q


def _alerts_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat_alerts(run_rules(read_events_table(spark, sf_dir), rule_set(spark, name)))
    return q


def q_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J4 + P6 with rules as data (broadcast join, HOF condition programs)."""
    if "matched_joined" not in RULES:
        RULES["matched_joined"] = RULES["threshold"] + RULES["unique_threshold"] + RULES["nested_condition"]
    rs = rule_set(spark, "matched_joined")
    m = match_dynamic(read_events_table(spark, sf_dir), rs.index)
    return m.select("rule_id", "block_index", "block_type", "rule_type", "customer", "group_by",
                    "agg_key", "unique_value", F.col("arrival_seq").alias("event_id"), "event_ms")


def derived_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule set made from the data: one rule per (user, k) that occurs, for
    values over half of the largest seen there.  Rule JSON, as a control
    message would carry it, built and decoded by Spark."""
    k = F.get_json_object("props", "$.k")
    seen = (spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").cast("string").alias("user"), k.alias("k"), "value")
            .where(F.col("user").isNotNull() & F.col("k").isNotNull() & F.col("value").isNotNull())
            .groupBy("user", "k").agg((F.max("value") / 2).alias("over")))
    leaf = lambda cls, **cols: F.struct(F.lit(PKG + cls).alias("@class"), *[c.alias(n) for n, c in cols.items()])
    kids = F.concat_ws(
        ",", F.to_json(leaf("EqualCondition", key=F.lit("user"), value=F.col("user"))),
        F.to_json(leaf("EqualCondition", key=F.lit("k"), value=F.col("k"))),
        F.to_json(leaf("ComparisonCondition", key=F.lit("value"), thresholdValue=F.col("over"), type=F.lit("GREATER_THAN"))))
    content = F.format_string('{"blocks":[{"type":"SINGLE_EVENT","condition":{"@class":"%s","type":"AND","conditions":[%s]}}]}',
                              F.lit(PKG + "CompositeCondition"), kids)
    store = seen.select(F.format_string("u%s.k%s", "user", "k").alias("rule_id"), F.lit(1).alias("rule_version"), content.alias("content"))
    ensure_checkpoint_dir(spark)
    return parse_rules(store.checkpoint(eager=True))  # a rule store is written once; decoding reads it several times


def q_dynamic_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as data, as many as the data has (user, k) pairs, met through the guard index."""
    m = match_joined(read_events_table(spark, sf_dir), derived_rules(spark, sf_dir))
    return m.select("rule_id", "rule_version", "block_index", "block_type", "customer", F.col("arrival_seq").alias("event_id"), "event_ms")


def q_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a slide that does not divide the size (1 h 30 min / 1 h)."""
    ev = read_events_table(spark, sf_dir)
    size, slide = F.lit(5400000).cast("bigint"), F.lit(3600000).cast("bigint")
    return ev.select(F.col("arrival_seq").alias("event_id"),
                     F.explode(sliding_starts(F.col("event_ms"), size, slide)).alias("window_start_ms"))


def q_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts per (customer, type, hour)."""
    rs = rule_set(spark, "anomaly_1h")
    matched = match_compiled(read_events_table(spark, sf_dir), rs.blocks)
    c = B.window_counts(matched, "SIMPLE_ANOMALY")
    return c.select("customer", "group_by", F.col("p").alias("window_start_ms"),
                    F.col("n").alias("event_count"))


def q_alert_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S5: alerts serialised to JSON are events again; a rule on the
    alert fields (source, matchedRuleId) matches every fed-back alert."""
    from rulestream.operators.alerts import alerts_to_json
    from rulestream.sources.events import alerts_as_events
    first = run_rules(read_events_table(spark, sf_dir), rule_set(spark, "single_event"))
    back = alerts_as_events(alerts_to_json(first))
    b = run_blocks(back, rule_set(spark, "feedback"))
    return b.select("rule_id", "customer", "block_index", "phase", "event_count", "match_message")


def q_history_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K6 + as-of matching: fold a control log into effective-dated rule
    versions and match every event against the version in force at its time."""
    key = (id(spark), "history")
    if key not in _RULE_SETS:
        from rulestream.operators.control import fold_control, rules_from_history
        from rulestream.sources.control import control_from_messages
        _, hist = fold_control(control_from_messages(spark, HISTORY_LOG))
        _RULE_SETS[key] = RuleSet(rules_from_history(hist))
    b = run_blocks(read_events_table(spark, sf_dir), _RULE_SETS[key])
    return b.select("rule_id", "rule_version", "customer", F.col("match_ms").alias("event_ms"))


def q_history_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed and multi-block rules change in the middle; every event goes to the windows of the version in force."""
    key = (id(spark), "history_windows")
    if key not in _RULE_SETS:
        from rulestream.operators.control import fold_control, rules_from_history
        from rulestream.sources.control import control_from_messages
        _, hist = fold_control(control_from_messages(spark, HISTORY_WINDOWS_LOG))
        _RULE_SETS[key] = RuleSet(rules_from_history(hist))
    return flat_alerts(run_rules(read_events_table(spark, sf_dir), _RULE_SETS[key]))


def q_alert_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert JSON read back: one row per alert and key, with its sample event and the group-by field."""
    from rulestream.operators.alerts import alerts_to_json
    alert = F.from_json("value", "matchTime string, matchedRuleId string, customer string, groupBy string, user string, blockOutput map<string,struct<"
                        "matchMessage:string,matchingEvents:array<struct<key:string,sampleEventContent:struct<event_id:bigint,type:string,value:double>,count:bigint>>>>")
    js = alerts_to_json(run_rules(read_events_table(spark, sf_dir), rule_set(spark, "samples")))
    # explode alone has a filter inferred on its input, for which all JSON would be written and read once more
    a = js.select(alert.alias("a")).select("a.*", F.explode_outer(F.col("a.blockOutput")["0"]["matchingEvents"]).alias("e")).where(F.col("e").isNotNull())
    return a.select(F.col("matchedRuleId").alias("rule_id"), "customer", F.col("groupBy").alias("group_by"), F.col("user").alias("user_field"),
                    F.col("matchTime").alias("match_time"), F.col("blockOutput")["0"]["matchMessage"].alias("match_message"), F.col("e.key").alias("agg_key"),
                    F.col("e.sampleEventContent.event_id").alias("sample_event_id"), F.col("e.sampleEventContent.value").alias("sample_value"), F.col("e.count").alias("n"))


def damaged_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events as records (seq, content), and as control messages (seq, value), damaged as the event's k has it."""
    ev = read_events_table(spark, sf_dir).select(F.col("arrival_seq").alias("seq"), "content", (F.col("fields")["k"].cast("int") % 10).alias("d"))
    d, text = F.col("d"), F.col("content")
    records = ev.select("seq", F.when(d == 0, F.expr("substring(content, 1, length(content) - 1)"))
                        .when(d == 1, F.replace(text, F.lit('"@timestamp":"'), F.lit('"@timestamp":"on '))).when(d == 2, F.lit(None).cast("string")).when(d == 3, "[]")
                        .when(d == 5, F.regexp_replace(text, '"value":[^,]*', '"value":"n/a"')).otherwise(text).alias("content"))
    log = control_log_of_events(spark, sf_dir).join(ev.select("seq", "d"), "seq")
    messages = log.select("seq", F.when(d == 6, F.regexp_replace("value", '"type":"[A-Z]+_[A-Z]+","ruleId"', '"type":"RESET","ruleId"'))
                          .when(d == 7, "not json").when(d == 8, F.lit(None).cast("string")).otherwise(F.col("value")).alias("value"))
    return records, messages


def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record, message and (event, block) pair that is set aside, with the reason."""
    from rulestream.operators.rejects import control_rejects, event_rejects, match_rejects
    from rulestream.sources.events import parse_events
    records, messages = damaged_records(spark, sf_dir)
    events = parse_events(records, seq_col="seq", on_bad_ts="drop")
    out = event_rejects(records, on_bad_ts="drop").unionByName(control_rejects(messages)).unionByName(
        match_rejects(events, rule_set(spark, "breakable").blocks))
    return out.select("place", F.col("seq").alias("event_id"), "rule_id", "rule_version", "block_index", "reason")


def control_log_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control log made from all events: errors remove the user's rule, the
    other types add it, a signup with k = 7 asks for the status; the version
    is k mod 4 (0 is invalid).  Messages are JSON text."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "error", "REMOVE_RULE").when((F.col("event_type") == "signup") & (k == 7), "QUERY_STATUS") \
        .otherwise("ADD_RULE")
    user = F.col("user_id").cast("string")
    content = F.format_string('{"blocks":[{"type":"SINGLE_EVENT","condition":{"@class":"%sEqualCondition","key":"user","value":"%s"}}]}',
                              F.lit(PKG), user)
    message = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), kind.alias("type"), F.concat(F.lit("u"), user).alias("ruleId"),
        (k % 4).alias("ruleVersion"), F.lit(1).alias("controlSchemaVersion"), F.when(kind == "ADD_RULE", content).alias("content")))
    return ev.select(F.col("event_id").alias("seq"), message.alias("value"))


def _written_once(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder, for what reads it several times, by column."""
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def q_control_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K5: every event as a control message; the log is folded in two
    batches, the second from the rules active after the first."""
    from rulestream.operators.control import active_at, fold_messages
    from rulestream.sources.control import parse_control
    ctrl = _written_once(parse_control(control_log_of_events(spark, sf_dir), seq_col="seq"))  # as the job keeps its control log
    middle = ctrl.agg(F.floor(F.avg("seq"))).first()[0]
    acks, hist = fold_messages(ctrl.where(F.col("seq") <= middle))
    more, _ = fold_messages(ctrl.where(F.col("seq") > middle), active_at(hist))
    columns = "seq bigint, action string, status string, ruleId string, ruleVersion int, content string"
    return acks.unionByName(more).select(*[c.split()[0] for c in columns.split(", ")]).mapInArrow(_read_status, columns)


class _Listed(dict):
    """JSON of a rule in a status answer (without ``{"`` and ``}``) -> id:version:version within; each text is read once."""

    MOST = 32 << 20
    size = 0

    def __missing__(self, text: str) -> str:
        self[text] = entry = _listed_rule(json.loads('{"' + text + "}", parse_int=str, parse_float=str))
        self.size += len(text)
        return entry

    def of(self, answer: str) -> str | None:
        """The rules of one answer: cut where one ends and the next begins; if a part is then no object, read as a whole."""
        if self.size > self.MOST:
            self.clear()
            self.size = 0
        try:
            if answer.startswith('[{"') and answer.endswith("}]"):
                texts = answer.split('},{"')
                texts[0] = texts[0][3:]
                texts[-1] = texts[-1][:-2]
                try:
                    return " ".join(sorted(map(self.__getitem__, texts)))
                except ValueError:
                    pass
            return " ".join(sorted(map(_listed_rule, json.loads(answer, parse_int=str, parse_float=str))))
        except ValueError:
            return None


def _listed_rule(rule: dict) -> str:
    try:
        stored = json.loads(rule.get("content") or "", parse_int=str, parse_float=str)
    except ValueError:
        stored = None
    version = stored.get("version") if isinstance(stored, dict) else None
    version = version if version is None or isinstance(version, str) else json.dumps(version)
    return ":".join(x for x in (rule.get("ruleId"), rule.get("ruleVersion"), version) if x is not None)


_LISTED = _Listed()


def _read_status(it):
    """Acks, with the JSON of status answers as the ids and versions of the rules that it lists, in order."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def read(batch):
        status, content = batch.column("status"), batch.column("content")
        if not pc.any(pc.equal(status, "STATUS_UPDATE")).as_py():
            return batch
        texts = (_LISTED.of(c.as_py()) if s == "STATUS_UPDATE" else c.as_py() for s, c in zip(status.to_pylist(), content))
        return batch.set_column(batch.schema.get_field_index("content"), "content", pa.array(texts, pa.string()))
    return map(read, it)  # holds no batch while the next one comes


def rules_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule submitted by every event, right or wrong as the event's numbers
    have it: block type by event type (none for every 13th event), sizes and
    thresholds from k, groupings and the number of blocks from the user."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k, user = F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(0)), F.coalesce("user_id", F.lit(0))
    ev = ev.select("event_id", "event_type", k.alias("k"), user.alias("user"))
    k, user = F.col("k"), F.col("user")
    kind = F.when(F.col("event_id") % 13 == 0, "NOPE")
    for event_type, block_type in SUBMITTED.items():
        kind = kind.when(F.col("event_type") == event_type, block_type)
    ev = ev.withColumn("kind", kind.otherwise("DROP_TO_ZERO"))
    kind = F.col("kind")
    sliding = kind.isin("THRESHOLD", "UNIQUE_THRESHOLD")
    leaf = F.struct(F.lit(PKG + "EqualCondition").alias("@class"), F.when(k % 7 == 0, "").otherwise("type").alias("key"),
                    F.col("event_type").alias("value"))
    both = F.to_json(F.struct(F.lit(PKG + "CompositeCondition").alias("@class"), F.lit("AND").alias("type"), F.array(leaf).alias("conditions")))
    block_json = F.to_json(F.struct(
        kind.alias("type"), F.when((kind != "SINGLE_EVENT") | (user % 5 == 0), k - 10).alias("windowSize"),
        F.when(sliding | (user % 5 == 1), k % 3).alias("windowSlide"),
        F.when(sliding & (user % 4 > 0), F.array(F.when(user % 4 == 1, "").otherwise("user"))).alias("aggregationGroupingFields"),
        F.when(sliding, F.struct((k % 5).cast("string").alias("THRESHOLD"), F.when(kind == "UNIQUE_THRESHOLD", F.when(user % 2 == 0, "").otherwise("user")).alias("UNIQUE_FIELD"))).alias("parameters"),
        F.when(k % 11 == 0, "red").alias("colour")))
    # parameters of another type stand beside those above under the one name
    anomaly = F.when(kind == "SIMPLE_ANOMALY", F.concat(F.lit(',"parameters":'), F.to_json(F.struct(
        F.when(k % 5 == 4, "x").otherwise((k % 5).cast("string")).alias("SIMPLE_ANOMALY_THRESHOLD")))))
    condition = F.when(k % 9 == 4, both).otherwise(F.to_json(leaf))
    one = F.concat(F.expr("substring(__b, 1, length(__b) - 1)"), F.coalesce(F.col("__a"), F.lit("")), F.lit(',"condition":'), F.col("__c"), F.lit("}"))
    ev = ev.select("*", block_json.alias("__b"), anomaly.alias("__a"), condition.alias("__c")).withColumn("__one", one)
    several = user % 7 == 0
    head = F.to_json(F.struct(
        F.when(user % 3 != 0, "user").alias("groupByField"), F.when(k % 17 != 0, k % 10).alias("baseSeverity"),
        F.when(several, 60).alias("windowSize"), F.when(several & (user % 2 == 1), 30).alias("windowSlide"),
        F.when(several, F.struct(F.lit("rulestream.rules.AllBlocksOccurredRuleCondition").alias("@class"), F.array(F.lit(0), k % 2).alias("blockIndices"))).alias("ruleCondition"),
        F.lit(1).alias("blocks")))
    blocks = F.concat(F.lit('"blocks":['), F.when(several, F.concat_ws(",", "__one", "__one")).otherwise(F.col("__one")), F.lit("]"))
    severity = F.when(k % 17 == 0, '{"baseSeverity":"high",').otherwise("{")
    content = F.concat(severity, F.substr(F.replace(head, F.lit('"blocks":1'), blocks), F.lit(2)))
    return ev.select("event_id", content.alias("content"))


# Block types of the submitted rules, by event type (any other: DROP_TO_ZERO).
SUBMITTED = {"click": "SINGLE_EVENT", "error": "THRESHOLD", "purchase": "UNIQUE_THRESHOLD", "signup": "SIMPLE_ANOMALY"}


def q_rule_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is wrong with the rule of each event, by the checks and by the schema."""
    from rulestream.operators.validate import rule_errors
    ensure_checkpoint_dir(spark)
    rules = rules_of_events(spark, sf_dir).checkpoint(eager=True)  # a rule store, as in derived_rules
    checked = rule_errors(parse_rules(rules.select("content", F.lit("r").alias("rule_id"), F.lit(1).alias("rule_version")).distinct()), strict=True)
    return rules.join(checked.select("content", "errors"), "content").select("event_id", F.explode("errors").alias("error")).groupBy(
        "event_id", "error").agg(F.count(F.lit(1)).alias("n"))


def q_rule_windows_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rule windows per block result, from panes; one row per (alert, block) with its sample event."""
    a = run_rules(read_events_table(spark, sf_dir), rule_set(spark, "rule_windows_fine"))
    return a.select("rule_id", "customer", "group_by", "window_start_ms", "window_end_ms", "match_ms", F.explode("outputs").alias("block", "o")).select(
        "rule_id", "customer", "group_by", "window_start_ms", "window_end_ms", "match_ms", "block", F.col("o.match_ms").alias("block_match_ms"),
        F.get_json_object(F.col("o.matching_events")[0]["sample"], "$.event_id").cast("bigint").alias("sample_event_id"))


def q_block_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: one row per (alert, block output) - last result per block index."""
    a = run_rules(read_events_table(spark, sf_dir), rule_set(spark, "all_blocks"))
    return a.select("rule_id", "customer", "group_by", "window_start_ms",
                    F.explode("outputs").alias("block", "o")).select(
        "rule_id", "customer", "group_by", "window_start_ms", "block",
        F.col("o.match_ms").alias("block_match_ms"), F.col("o.match_message").alias("match_message"),
        F.size("o.matching_events").cast("bigint").alias("n_keys"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "single_event": _blocks_query("single_event"),
        "single_event_100": _blocks_query("single_event_100"),
        "nested_condition": _blocks_query("nested_condition"),
        "threshold": _blocks_query("threshold"),
        "threshold_small": _blocks_query("threshold_small"),
        "threshold_fine": _blocks_query("threshold_fine"),
        "threshold_large": _blocks_query("threshold_large"),
        "unique_threshold": _blocks_query("unique_threshold"),
        "unique_threshold_fine": _blocks_query("unique_threshold_fine"),
        "anomaly_6h": _blocks_query("anomaly_6h"),
        "anomaly_1h": _blocks_query("anomaly_1h"),
        "drop_to_zero": _blocks_query("drop_to_zero"),
        "sequence_alerts": _alerts_query("sequence"),
        "all_blocks_alerts": _alerts_query("all_blocks"),
        "composite_alerts": _alerts_query("composite"),
        "any_blocks_alerts": _alerts_query("any_blocks"),
        "sequence_absent_alerts": _alerts_query("sequence_absent"),
        "threshold_then_single_alerts": _alerts_query("threshold_then_single"),
        "alert_feedback": q_alert_feedback,
        "history_replay": q_history_replay,
        "control_acks": q_control_acks,
        "rule_errors": q_rule_errors,
        "history_windows": q_history_windows,
        "alert_samples": q_alert_samples,
        "rejects": q_rejects,
        "block_outputs": q_block_outputs,
        "rule_windows_fine": q_rule_windows_fine,
        "matched_joined": q_matched,
        "dynamic_match": q_dynamic_match,
        "sliding_windows": q_sliding_windows,
        "window_counts": q_window_counts,
    }
    return q


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

EV = """ev AS (
  SELECT event_id, event_type AS type, value, CAST(user_id % 5 AS VARCHAR) AS customer,
         CAST(user_id AS VARCHAR) AS usr, json_extract_string(props, '$.k') AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events)"""


def _windows_sql(src: str, size_ms: int, slide_ms: int) -> str:
    n = -(-size_ms // slide_ms)
    return (f"SELECT s.*, s.ms - (s.ms % {slide_ms}) - r.i * {slide_ms} AS ws FROM {src} s, "
            f"range(0, {n + 1}) r(i) WHERE s.ms - (s.ms % {slide_ms}) - r.i * {slide_ms} > s.ms - {size_ms}")


def _threshold_sql(rule_id: str, size: int, slide: int, n: int, where: str = "type = 'error'", agg: str = "'user=' || usr") -> str:
    size_ms, slide_ms = size * 1000, slide * 1000
    return f"""WITH {EV},
m AS (SELECT customer, 'customer=' || customer AS group_by, {agg} AS agg_key, ms, event_id
      FROM ev WHERE {where}),
w AS ({_windows_sql('m', size_ms, slide_ms)}),
r AS (SELECT *, row_number() OVER (PARTITION BY customer, ws ORDER BY ms, event_id) AS rn,
             count(*) OVER (PARTITION BY customer, ws) AS cnt FROM w),
fin AS (SELECT customer, group_by, ws, 'final' AS phase, max(ms) AS match_ms, count(*) AS event_count,
               count(DISTINCT agg_key) AS n_keys FROM r WHERE cnt >= {n} GROUP BY ALL),
ini AS (SELECT customer, group_by, ws, 'initial' AS phase, max(ms) AS match_ms, count(*) AS event_count,
               count(DISTINCT agg_key) AS n_keys FROM r WHERE cnt >= {n} AND rn <= {n} GROUP BY ALL)
SELECT '{rule_id}' AS rule_id, customer, group_by, 0 AS block_index, phase, ws AS window_start_ms,
       ws + {size_ms} AS window_end_ms, match_ms, event_count, n_keys,
       'Threshold exceeded. ' || event_count || ' events were observed in the last 0 minutes.' AS match_message
FROM (SELECT * FROM fin UNION ALL SELECT * FROM ini)"""


def _rule_errors_sql() -> str:
    """Which errors the rule of an event must have, from the event's numbers alone."""
    sliding, counting = "kind IN ('THRESHOLD', 'UNIQUE_THRESHOLD')", "kind IN ('SIMPLE_ANOMALY', 'DROP_TO_ZERO')"
    known, at = "kind <> 'NOPE'", "'schema: $.blocks[' || i || ']"
    per_block = [
        ("kind = 'NOPE'", "'there is no block type NOPE.'"),
        ("kind = 'SINGLE_EVENT' AND usr % 5 = 0 AND k <> 10", "'a SINGLE_EVENT block takes no windowSize'"),
        ("kind = 'SINGLE_EVENT' AND usr % 5 = 1 AND k % 3 <> 0", "'a SINGLE_EVENT block takes no windowSlide'"),
        (f"({sliding} OR {counting}) AND k <= 10", "'a windowed block needs a windowSize above 0'"),
        (f"{sliding} AND k % 3 = 0", "'a sliding block needs a windowSlide above 0'"),
        (f"{counting} AND usr % 5 = 1 AND k % 3 > 0", "'a counting block takes no windowSlide'"),
        (f"{sliding} AND usr % 4 = 0", "'a threshold block needs aggregationGroupingFields'"),
        (f"{sliding} AND usr % 4 = 1", "'an entry of aggregationGroupingFields is empty'"),
        (f"{sliding} AND k % 5 = 0", "'THRESHOLD must be a whole number above 0'"),
        ("kind = 'UNIQUE_THRESHOLD' AND usr % 2 = 0", "'a UNIQUE_THRESHOLD block needs UNIQUE_FIELD'"),
        ("kind = 'SIMPLE_ANOMALY' AND k % 5 IN (0, 4)", "'SIMPLE_ANOMALY_THRESHOLD must be a whole number above 0'"),
        ("k % 7 = 0", "'a condition names no field'"),
        ("kind = 'NOPE'", f"{at} is no known block'"),
        (f"{known} AND k % 11 = 0", f"{at} colour is not allowed'"),
        ("kind = 'SINGLE_EVENT' AND usr % 5 = 0", f"{at} windowSize is not allowed'"),
        (f"(kind = 'SINGLE_EVENT' OR {counting}) AND usr % 5 = 1", f"{at} windowSlide is not allowed'"),
        (f"({sliding} OR {counting}) AND k <= 10", f"{at} windowSize is too small'"),
        (f"{sliding} AND k % 3 = 0", f"{at} windowSlide is too small'"),
        (f"{sliding} AND usr % 4 = 0", f"{at} aggregationGroupingFields is missing'"),
        (f"{sliding} AND usr % 4 = 1", f"{at} aggregationGroupingFields has an entry that is too short'"),
        ("kind = 'UNIQUE_THRESHOLD' AND usr % 2 = 0", f"{at}.parameters UNIQUE_FIELD is too short'"),
        ("kind = 'SIMPLE_ANOMALY' AND k % 5 = 4", f"{at}.parameters SIMPLE_ANOMALY_THRESHOLD has a wrong form'"),
        (f"{known} AND k % 7 = 0 AND k % 9 <> 4", f"{at}.condition key is too short'"),
        (f"{known} AND k % 7 = 0 AND k % 9 = 4", f"{at}.condition.conditions[0] key is too short'"),
        (f"{known} AND k % 9 = 4", f"{at}.condition conditions has too few entries'"),
    ]
    per_rule = [
        ("k % 11 = 0", "'unknown block property: colour' || CASE WHEN nb = 2 THEN ',colour' ELSE '' END"),
        ("k % 17 = 0", "'not a whole number: baseSeverity'"),
        ("nb = 2 AND usr % 2 = 0", "'several blocks need a rule windowSlide'"),
        ("nb = 2 AND k % 2 = 0", "'a rule condition lists a block twice'"),
        ("usr % 3 = 0 AND NOT (nb = 1 AND kind = 'SINGLE_EVENT')", "'all rules but those of one SINGLE_EVENT block need a groupByField'"),
        ("nb = 1 AND kind = 'SINGLE_EVENT' AND usr % 3 <> 0", "'schema: $ groupByField is not allowed'"),
        ("nb = 2 AND usr % 3 = 0", "'schema: $ groupByField is missing'"),
        ("nb = 2 AND usr % 2 = 0", "'schema: $ windowSlide is missing'"),
        ("k % 17 = 0", "'schema: $ baseSeverity is not of type integer'"),
        ("nb = 2 AND k % 2 = 0", "'schema: $.ruleCondition blockIndices has an entry twice'"),
    ]
    kinds = " ".join(f"WHEN event_type = '{e}' THEN '{b}'" for e, b in SUBMITTED.items())
    lists = [f"SELECT event_id, {what} AS error FROM {src} WHERE {where}" for src, cases in (("b", per_block), ("r", per_rule)) for where, what in cases]
    return f"""WITH r AS (
  SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INT), 0) AS k, coalesce(user_id, 0) AS usr,
         CASE WHEN event_id % 13 = 0 THEN 'NOPE' {kinds} ELSE 'DROP_TO_ZERO' END AS kind,
         CASE WHEN coalesce(user_id, 0) % 7 = 0 THEN 2 ELSE 1 END AS nb
  FROM events),
b AS (SELECT r.*, t.i FROM r, range(0, 2) t(i) WHERE t.i < r.nb)
SELECT event_id, error, count(*) AS n FROM ({' UNION ALL '.join(lists)}) GROUP BY ALL"""


def _unique_sql(rule_id: str, size: int, slide: int, n: int) -> str:
    size_ms, slide_ms = size * 1000, slide * 1000
    return f"""WITH {EV},
m AS (SELECT customer, 'customer=' || customer AS group_by, 'user=' || usr AS agg_key, usr AS uv, ms, event_id
      FROM ev WHERE type = 'error' AND usr <> ''),
w AS ({_windows_sql('m', size_ms, slide_ms)}),
firsts AS (SELECT customer, ws, uv, arg_min(ms, (ms, event_id)) AS fms, arg_min(event_id, (ms, event_id)) AS fid
           FROM w GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer, ws ORDER BY fms, fid) AS rn FROM firsts),
fire AS (SELECT customer, ws, fms, fid FROM ranked WHERE rn = {n}),
ini AS (SELECT w.customer, w.group_by, w.ws, 'initial' AS phase, max(w.ms) AS match_ms, count(*) AS event_count,
               count(DISTINCT w.agg_key) AS n_keys
        FROM w JOIN fire f ON w.customer = f.customer AND w.ws = f.ws
        WHERE w.ms < f.fms OR (w.ms = f.fms AND w.event_id <= f.fid) GROUP BY ALL),
fin AS (SELECT w.customer, w.group_by, w.ws, 'final' AS phase, max(w.ms) AS match_ms, count(*) AS event_count,
               count(DISTINCT w.agg_key) AS n_keys
        FROM w JOIN fire f ON w.customer = f.customer AND w.ws = f.ws GROUP BY ALL)
SELECT '{rule_id}' AS rule_id, customer, group_by, 0 AS block_index, phase, ws AS window_start_ms,
       ws + {size_ms} AS window_end_ms, match_ms, event_count, n_keys,
       'Unique threshold exceeded.' AS match_message
FROM (SELECT * FROM fin UNION ALL SELECT * FROM ini)"""


def _counts_cte(where: str, size_ms: int) -> str:
    return f"""c AS (SELECT customer, 'type=' || type AS group_by, ms - (ms % {size_ms}) AS p,
             (ms - (ms % {size_ms})) // {size_ms} AS o, count(*) AS n
      FROM ev WHERE {where} GROUP BY ALL)"""


def _anomaly_sql(rule_id: str, where: str, size: int, h: int) -> str:
    size_ms = size * 1000
    return f"""WITH {EV}, {_counts_cte(where, size_ms)},
f AS (SELECT *, count(*) OVER w AS k, (sum(n) OVER w) - n AS prev
      FROM c WINDOW w AS (PARTITION BY customer, group_by ORDER BY o RANGE BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT '{rule_id}' AS rule_id, customer, group_by, 0 AS block_index, 'close' AS phase,
       p + {size_ms} - {10 * size_ms} AS window_start_ms, p + {size_ms} AS window_end_ms, p + {size_ms} AS match_ms,
       n AS event_count, 0::BIGINT AS n_keys,
       n || ' matching events seen in {size // 60} minutes, up from the average previous average of '
         || (prev // 9) || '.' AS match_message
FROM f WHERE k >= 9 AND n >= (prev // 9) * {h}"""


def _drop_sql(rule_id: str, where: str, size: int) -> str:
    size_ms = size * 1000
    return f"""WITH {EV}, {_counts_cte(where, size_ms)},
f AS (SELECT *, count(*) OVER (PARTITION BY customer, group_by ORDER BY o RANGE BETWEEN 8 PRECEDING AND CURRENT ROW) AS k,
             lead(o) OVER (PARTITION BY customer, group_by ORDER BY o) AS nxt FROM c)
SELECT '{rule_id}' AS rule_id, customer, group_by, 0 AS block_index, 'close' AS phase,
       p + {2 * size_ms} - {10 * size_ms} AS window_start_ms, p + {2 * size_ms} AS window_end_ms,
       p + {2 * size_ms} AS match_ms, 0::BIGINT AS event_count, 0::BIGINT AS n_keys,
       '0 matching events seen in the last {size} seconds.' AS match_message
FROM f WHERE k = 9 AND (nxt IS NULL OR nxt <> o + 1)"""


def _single_sql(rule_id: str, where: str) -> str:
    return f"""WITH {EV}
SELECT '{rule_id}' AS rule_id, customer, CAST(NULL AS VARCHAR) AS group_by, 0 AS block_index, 'event' AS phase,
       CAST(NULL AS BIGINT) AS window_start_ms, CAST(NULL AS BIGINT) AS window_end_ms, ms AS match_ms,
       1::BIGINT AS event_count, 1::BIGINT AS n_keys,
       'An event matching the specified conditions was observed.' AS match_message
FROM ev WHERE {where}"""


def _generated_rules_sql() -> str:
    types = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    return f"""WITH {EV}, e AS (SELECT *, TRY_CAST(k AS INTEGER) AS ki FROM ev)
SELECT 'r' || lpad(ki::VARCHAR, 3, '0') AS rule_id, customer, CAST(NULL AS VARCHAR) AS group_by, 0 AS block_index,
       'event' AS phase, CAST(NULL AS BIGINT) AS window_start_ms, CAST(NULL AS BIGINT) AS window_end_ms,
       ms AS match_ms, 1::BIGINT AS event_count, 1::BIGINT AS n_keys,
       'An event matching the specified conditions was observed.' AS match_message
FROM e WHERE ki BETWEEN 0 AND 99 AND k = ki::VARCHAR AND (
   (ki % 4 = 0 AND type = list_extract([{types}], ki % 5 + 1))
   OR (ki % 4 = 1 AND value::FLOAT::DOUBLE > 50)
   OR (ki % 4 = 2 AND regexp_matches(type, '^(click|view)$'))
   OR (ki % 4 = 3 AND (type = 'error' OR value::FLOAT::DOUBLE < 5)))"""


def _sequence_sql() -> str:
    size_ms, slide_ms = DAY * 1000, DAY // 2 * 1000
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by, CASE WHEN type = 'error' THEN 0 ELSE 1 END AS bi, ms, event_id
      FROM ev WHERE type IN ('error', 'purchase')),
w AS ({_windows_sql('b', size_ms, slide_ms)}),
o AS (SELECT *, ms::HUGEINT * 100000000 + event_id AS ord FROM w),
p1 AS (SELECT customer, group_by, ws, min(ord) AS pos FROM o WHERE bi = 0 GROUP BY ALL),
p2 AS (SELECT o.customer, o.group_by, o.ws, min(o.ord) AS pos FROM o JOIN p1
       ON o.customer = p1.customer AND o.group_by = p1.group_by AND o.ws = p1.ws
       WHERE o.bi = 1 AND o.ord >= p1.pos GROUP BY ALL),
g AS (SELECT customer, group_by, ws, max(ms) AS match_ms, string_agg(DISTINCT bi::VARCHAR, ',' ORDER BY bi::VARCHAR) AS blocks
      FROM o GROUP BY ALL)
SELECT 'seq' AS rule_id, g.customer, g.group_by, 1 AS rule_version, 5 AS base_severity, g.match_ms,
       g.ws AS window_start_ms, g.ws + {size_ms} AS window_end_ms, g.blocks
FROM g JOIN p2 ON g.customer = p2.customer AND g.group_by = p2.group_by AND g.ws = p2.ws"""


def _all_blocks_sql() -> str:
    size_ms, slide_ms = 6 * HOUR * 1000, 3 * HOUR * 1000
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by,
             CASE type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS bi, ms, event_id
      FROM ev WHERE type IN ('error', 'signup', 'view')),
w AS ({_windows_sql('b', size_ms, slide_ms)}),
g AS (SELECT customer, group_by, ws, max(ms) AS match_ms, count(DISTINCT bi) AS nb,
             string_agg(DISTINCT bi::VARCHAR, ',' ORDER BY bi::VARCHAR) AS blocks FROM w GROUP BY ALL)
SELECT 'all3' AS rule_id, customer, group_by, 1 AS rule_version, 3 AS base_severity, match_ms,
       ws AS window_start_ms, ws + {size_ms} AS window_end_ms, blocks
FROM g WHERE nb = 3"""


def _matched_sql() -> str:
    return f"""WITH {EV}
SELECT 'thr24' AS rule_id, 0 AS block_index, 'THRESHOLD' AS block_type, 'SIMPLE' AS rule_type, customer,
       'customer=' || customer AS group_by, 'user=' || usr AS agg_key, CAST(NULL AS VARCHAR) AS unique_value,
       event_id, ms AS event_ms FROM ev WHERE type = 'error'
UNION ALL
SELECT 'uniq', 0, 'UNIQUE_THRESHOLD', 'SIMPLE', customer, 'customer=' || customer, 'user=' || usr, usr,
       event_id, ms FROM ev WHERE type = 'error'
UNION ALL
SELECT 'nested', 0, 'SINGLE_EVENT', 'SIMPLE', customer, NULL, NULL, NULL, event_id, ms FROM ev
WHERE (type = 'purchase' OR value::FLOAT::DOUBLE > 45.5) AND regexp_matches(k, '^[1-4]')"""


def _multi_alerts_sql(rule_id: str, types: list[str], size: int, slide: int, sev: int, cond: str, also: str = "") -> str:
    """Alerts of a multi-block rule of SINGLE_EVENT blocks (one per type) per
    user; ``cond`` is a SQL predicate over has0..hasN of the window, ``also`` one over the events."""
    size_ms, slide_ms = size * 1000, slide * 1000
    case = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(types))
    has = ", ".join(f"bool_or(bi = {i}) AS has{i}" for i in range(len(types)))
    tl = ", ".join(f"'{t}'" for t in types)
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by, CASE type {case} END AS bi, ms, event_id
      FROM ev WHERE type IN ({tl}) {also}),
w AS ({_windows_sql('b', size_ms, slide_ms)}),
g AS (SELECT customer, group_by, ws, max(ms) AS match_ms, {has},
             string_agg(DISTINCT bi::VARCHAR, ',' ORDER BY bi::VARCHAR) AS blocks FROM w GROUP BY ALL)
SELECT '{rule_id}' AS rule_id, customer, group_by, 1 AS rule_version, {sev} AS base_severity, match_ms,
       ws AS window_start_ms, ws + {size_ms} AS window_end_ms, blocks
FROM g WHERE {cond}"""


def _rule_windows_fine_sql() -> str:
    size, slide = 6 * HOUR * 1000, HOUR // 12 * 1000
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by, CASE type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS bi, ms, event_id
      FROM ev WHERE type IN ('error', 'signup', 'view')),
w AS ({_windows_sql('b', size, slide)}),
i AS (SELECT customer, group_by, ws, bi, max(ms) AS block_match_ms, arg_max(event_id, (ms, event_id)) AS sample_event_id FROM w GROUP BY ALL),
g AS (SELECT *, max(block_match_ms) OVER k AS match_ms, count(*) OVER k AS n FROM i WINDOW k AS (PARTITION BY customer, group_by, ws))
SELECT 'fine72' AS rule_id, customer, group_by, ws AS window_start_ms, ws + {size} AS window_end_ms, match_ms, bi::VARCHAR AS block, block_match_ms,
       sample_event_id FROM g WHERE n = 3"""


def _history_windows_sql() -> str:
    """Per version: its own query over the events of its time."""
    cut = "1705276800000"  # 2024-01-15
    spans = (f"ms >= 1704067200000 AND ms < {cut}", f"ms >= {cut}")
    thr = [_threshold_sql("histthr", DAY, DAY // 2, 5, f"type = 'error' AND {spans[0]}"),
           _threshold_sql("histthr", 6 * HOUR, 3 * HOUR, 3, f"type = 'purchase' AND {spans[1]}")]
    both = [_multi_alerts_sql("histall", ["error", "signup"], 6 * HOUR, 3 * HOUR, 2, "has0 AND has1", f"AND {spans[0]}"),
            _multi_alerts_sql("histall", ["view", "click"], 8 * HOUR, 8 * HOUR, 7, "has0 AND has1", f"AND {spans[1]}")]
    flat = [f"SELECT rule_id, customer, group_by, {v + 1} AS rule_version, 0 AS base_severity, match_ms, window_start_ms, window_end_ms, '0' AS blocks FROM ({q})"
            for v, q in enumerate(thr)]
    flat += [f"SELECT * REPLACE ({v + 1} AS rule_version) FROM ({q})" for v, q in enumerate(both)]
    return " UNION ALL ".join(flat)


def _alert_samples_sql() -> str:
    size, slide, n = DAY * 1000, DAY // 2 * 1000, 3
    return f"""WITH {EV},
m AS (SELECT customer, usr, 'type=' || type AS agg_key, value, ms, event_id FROM ev WHERE usr IS NOT NULL AND usr <> '' AND regexp_matches(coalesce(type, ''), '')),
w AS ({_windows_sql('m', size, slide)}),
r AS (SELECT *, row_number() OVER (PARTITION BY customer, usr, ws ORDER BY ms, event_id) AS rn, count(*) OVER (PARTITION BY customer, usr, ws) AS cnt FROM w),
f AS (SELECT 'initial' AS phase, * FROM r WHERE cnt >= {n} AND rn <= {n} UNION ALL SELECT 'final' AS phase, * FROM r WHERE cnt >= {n}),
a AS (SELECT phase, customer, usr, ws, max(ms) AS match_ms, count(*) AS total FROM f GROUP BY ALL),
g AS (SELECT phase, customer, usr, ws, agg_key, count(*) AS n, arg_min(event_id, rn) AS sample_event_id, arg_min(value, rn) AS sample_value FROM f GROUP BY ALL)
SELECT 'thruser' AS rule_id, customer, 'user=' || usr AS group_by, usr AS user_field, strftime(make_timestamp(match_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS match_time,
       'Threshold exceeded. ' || total || ' events were observed in the last 0 minutes.' AS match_message, agg_key, sample_event_id, sample_value, n
FROM g JOIN a USING (phase, customer, usr, ws)"""


def _rejects_sql() -> str:
    row = "SELECT '{}' AS place, event_id, {} AS rule_id, {} AS rule_version, {} AS block_index, {} AS reason FROM d WHERE {}"
    none = ("NULL::VARCHAR", "NULL::INT", "NULL::INT")
    broken = "'the condition cannot be evaluated'"
    parts = [row.format("event", *none, "'not a JSON object'", "d IN (0, 3)"), row.format("event", *none, "'no usable @timestamp'", "d = 1"),
             row.format("event", *none, "'no text'", "d = 2"), row.format("control", *none, "'there is no control type RESET'", "d = 6"),
             row.format("control", *none, "'not a JSON object'", "d = 7"), row.format("control", *none, "'no text'", "d = 8"),
             row.format("match", "'ordered'", 1, 0, broken, "d = 5 AND value IS NOT NULL AND type = 'error'"),
             row.format("match", "'poisoned'", 1, 0, broken, "d = 5 AND value IS NOT NULL")]
    return f"WITH {EV}, d AS (SELECT *, k::INT % 10 AS d FROM ev) " + " UNION ALL ".join(parts)


def _sequence_absent_sql() -> str:
    size_ms, slide_ms = DAY * 1000, DAY // 2 * 1000
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by,
             CASE type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS bi, ms, event_id
      FROM ev WHERE type IN ('error', 'purchase', 'click')),
w AS ({_windows_sql('b', size_ms, slide_ms)}),
o AS (SELECT *, ms::HUGEINT * 100000000 + event_id AS ord FROM w),
p1 AS (SELECT customer, group_by, ws, min(ord) AS pos FROM o WHERE bi = 0 GROUP BY ALL),
p2 AS (SELECT o.customer, o.group_by, o.ws, min(o.ord) AS pos FROM o JOIN p1
       ON o.customer = p1.customer AND o.group_by = p1.group_by AND o.ws = p1.ws
       WHERE o.bi = 1 AND o.ord >= p1.pos GROUP BY ALL),
bad AS (SELECT DISTINCT o.customer, o.group_by, o.ws FROM o JOIN p2
        ON o.customer = p2.customer AND o.group_by = p2.group_by AND o.ws = p2.ws
        WHERE o.bi = 2 AND o.ord >= p2.pos),
g AS (SELECT customer, group_by, ws, max(ms) AS match_ms,
             string_agg(DISTINCT bi::VARCHAR, ',' ORDER BY bi::VARCHAR) AS blocks FROM o GROUP BY ALL)
SELECT 'seqnp' AS rule_id, g.customer, g.group_by, 1 AS rule_version, 6 AS base_severity, g.match_ms,
       g.ws AS window_start_ms, g.ws + {size_ms} AS window_end_ms, g.blocks
FROM g JOIN p2 ON g.customer = p2.customer AND g.group_by = p2.group_by AND g.ws = p2.ws
WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.customer = g.customer AND bad.group_by = g.group_by
                  AND bad.ws = g.ws)"""


def _threshold_then_single_sql() -> str:
    t_ms, r_ms = 6 * HOUR * 1000, 12 * HOUR * 1000
    return f"""WITH {EV},
e AS (SELECT customer, 'user=' || usr AS group_by, ms, event_id FROM ev WHERE type = 'error'),
tw AS (SELECT *, ms - (ms % {t_ms}) AS ws FROM e),
tr AS (SELECT *, row_number() OVER (PARTITION BY customer, group_by, ws ORDER BY ms, event_id) AS rn,
              count(*) OVER (PARTITION BY customer, group_by, ws) AS cnt FROM tw),
thr AS (SELECT customer, group_by, max(ms) AS match_ms, ws + {t_ms} - 1 AS emit_ms, 0 AS bi, ws AS tb
        FROM tr WHERE cnt >= 2 AND rn <= 2 GROUP BY customer, group_by, ws
        UNION ALL
        SELECT customer, group_by, max(ms), ws + {t_ms} - 1, 0, ws FROM tr WHERE cnt >= 2
        GROUP BY customer, group_by, ws),
single AS (SELECT customer, 'user=' || usr AS group_by, ms AS match_ms, ms AS emit_ms, 1 AS bi, event_id AS tb
           FROM ev WHERE type = 'purchase'),
blk AS (SELECT *, emit_ms - (emit_ms % {r_ms}) AS rws,
               (((match_ms::HUGEINT * 4398046511104 + emit_ms) * 2 + 1 - bi) * 4398046511104) + tb AS ord
        FROM (SELECT * FROM thr UNION ALL SELECT * FROM single)),
p1 AS (SELECT customer, group_by, rws, min(ord) AS pos FROM blk WHERE bi = 0 GROUP BY ALL),
p2 AS (SELECT blk.customer, blk.group_by, blk.rws FROM blk JOIN p1
       ON blk.customer = p1.customer AND blk.group_by = p1.group_by AND blk.rws = p1.rws
       WHERE blk.bi = 1 AND blk.ord >= p1.pos GROUP BY ALL),
g AS (SELECT customer, group_by, rws, max(match_ms) AS match_ms,
             string_agg(DISTINCT bi::VARCHAR, ',' ORDER BY bi::VARCHAR) AS blocks FROM blk GROUP BY ALL)
SELECT 'thrseq' AS rule_id, g.customer, g.group_by, 1 AS rule_version, 9 AS base_severity, g.match_ms,
       g.rws AS window_start_ms, g.rws + {r_ms} AS window_end_ms, g.blocks
FROM g JOIN p2 ON g.customer = p2.customer AND g.group_by = p2.group_by AND g.rws = p2.rws"""


def _block_outputs_sql() -> str:
    size_ms, slide_ms = 6 * HOUR * 1000, 3 * HOUR * 1000
    return f"""WITH {EV},
b AS (SELECT customer, 'user=' || usr AS group_by,
             CASE type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS bi, ms, event_id
      FROM ev WHERE type IN ('error', 'signup', 'view')),
w AS ({_windows_sql('b', size_ms, slide_ms)}),
ok AS (SELECT customer, group_by, ws FROM w GROUP BY ALL HAVING count(DISTINCT bi) = 3)
SELECT 'all3' AS rule_id, w.customer, w.group_by, w.ws AS window_start_ms, w.bi::VARCHAR AS block,
       max(w.ms) AS block_match_ms, 'An event matching the specified conditions was observed.' AS match_message,
       1::BIGINT AS n_keys
FROM w JOIN ok ON w.customer = ok.customer AND w.group_by = ok.group_by AND w.ws = ok.ws
GROUP BY w.customer, w.group_by, w.ws, w.bi"""


def _control_sql() -> str:
    return f"""WITH RECURSIVE {EV},
m AS (SELECT event_id AS seq, 'u' || usr AS rid, k::INTEGER % 4 AS v,
             CASE WHEN type = 'error' THEN 'REMOVE_RULE' WHEN type = 'signup' AND k = '7' THEN 'QUERY_STATUS' ELSE 'ADD_RULE' END AS kind FROM ev),
c AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY seq) AS n FROM m WHERE kind <> 'QUERY_STATUS'),
f AS (SELECT rid, 0::BIGINT AS n, NULL::BIGINT AS seq, NULL::VARCHAR AS kind, NULL::INTEGER AS v, NULL::INTEGER AS before, NULL::INTEGER AS cur
      FROM (SELECT DISTINCT rid FROM c)
      UNION ALL
      SELECT c.rid, c.n, c.seq, c.kind, c.v, f.cur,
             CASE WHEN c.v = 0 THEN f.cur WHEN c.kind = 'ADD_RULE' THEN greatest(coalesce(f.cur, c.v), c.v)
                  WHEN f.cur = c.v THEN NULL ELSE f.cur END
      FROM f JOIN c ON c.rid = f.rid AND c.n = f.n + 1),
ch AS (SELECT seq, kind AS action,
              CASE WHEN v = 0 THEN 'ERROR' WHEN kind = 'ADD_RULE' THEN 'RULE_ACTIVE'
                   WHEN before IS NULL OR before = v THEN 'RULE_DEACTIVATED' ELSE 'ERROR' END AS status,
              rid AS "ruleId", CASE WHEN v > 0 AND kind = 'ADD_RULE' THEN cur ELSE v END AS "ruleVersion",
              CASE WHEN v = 0 THEN 'Control Input failed validation: rule versions start at 1, not 0'
                   WHEN kind = 'REMOVE_RULE' AND before <> v THEN 'Cannot remove version ' || v || ' of rule ' || rid || ': version ' || before || ' is active' END AS content
       FROM f WHERE n > 0),
spans AS (SELECT rid, cur, seq, lead(seq) OVER (PARTITION BY rid ORDER BY n) AS nxt FROM f WHERE n > 0),
q AS (SELECT m.seq, 'QUERY_STATUS' AS action, 'STATUS_UPDATE' AS status, NULL::VARCHAR AS "ruleId", 0 AS "ruleVersion",
             coalesce(string_agg(s.rid || ':' || s.cur || ':' || s.cur, ' ' ORDER BY s.rid || ':' || s.cur || ':' || s.cur), '') AS content
      FROM m LEFT JOIN spans s ON s.seq < m.seq AND (s.nxt IS NULL OR s.nxt > m.seq) AND s.cur IS NOT NULL
      WHERE m.kind = 'QUERY_STATUS' GROUP BY m.seq)
SELECT * FROM ch UNION ALL SELECT * FROM q"""


def oracle_sql() -> dict[str, str]:
    return {
        "single_event": _single_sql("err", "type = 'error'"),
        "single_event_100": _generated_rules_sql(),
        "nested_condition": _single_sql(
            "nested", "(type = 'purchase' OR value::FLOAT::DOUBLE > 45.5) AND regexp_matches(k, '^[1-4]')"),
        "threshold": _threshold_sql("thr24", DAY, DAY // 2, 5),
        "threshold_small": _threshold_sql("thr6", 6 * HOUR, 2 * HOUR, 3),
        "threshold_fine": _threshold_sql("thrfine", 6 * HOUR, HOUR // 2, 4),
        "threshold_large": "SELECT * FROM (" + _threshold_sql("thrlarge", 20 * DAY, 5 * DAY, 1200, "true", "'type=' || type")
                           + ") UNION ALL SELECT * FROM (" + _threshold_sql("thr24", DAY, DAY // 2, 5) + ")",
        "unique_threshold": _unique_sql("uniq", DAY, DAY // 2, 3),
        "unique_threshold_fine": _unique_sql("uniqfine", 6 * HOUR, HOUR // 2, 4),
        "anomaly_6h": _anomaly_sql("anom6", "true", 6 * HOUR, 2),
        "anomaly_1h": _anomaly_sql("anom1", "true", HOUR, 2),
        "drop_to_zero": _drop_sql("drop2", "true", 2 * HOUR),
        "sequence_alerts": _sequence_sql(),
        "all_blocks_alerts": _all_blocks_sql(),
        "composite_alerts": _multi_alerts_sql("comp", ["error", "purchase", "signup", "click"], 6 * HOUR,
                                              3 * HOUR, 4, "(has0 AND has1) OR (has2 AND has3)"),
        "any_blocks_alerts": _multi_alerts_sql("any2", ["error", "purchase"], 12 * HOUR, 12 * HOUR, 1,
                                               "has0 OR has1"),
        "sequence_absent_alerts": _sequence_absent_sql(),
        "threshold_then_single_alerts": _threshold_then_single_sql(),
        "alert_feedback": f"""WITH {EV}
SELECT 'fb' AS rule_id, customer, 0 AS block_index, 'event' AS phase, 1::BIGINT AS event_count,
       'An event matching the specified conditions was observed.' AS match_message FROM ev WHERE type = 'error'""",
        "history_replay": f"""WITH {EV}
SELECT 'hist' AS rule_id, CASE WHEN type = 'error' THEN 1 ELSE 2 END AS rule_version, customer, ms AS event_ms
FROM ev WHERE (type = 'error' AND ms >= 1704067200000 AND ms < 1705276800000)
   OR (type = 'purchase' AND ms >= 1705276800000)""",
        "control_acks": _control_sql(),
        "rule_errors": _rule_errors_sql(),
        "rule_windows_fine": _rule_windows_fine_sql(),
        "history_windows": _history_windows_sql(),
        "alert_samples": _alert_samples_sql(),
        "rejects": _rejects_sql(),
        "block_outputs": _block_outputs_sql(),
        "matched_joined": _matched_sql(),
        "dynamic_match": f"""WITH {EV},
r AS (SELECT usr, k, max(value) / 2 AS over FROM ev WHERE usr IS NOT NULL AND k IS NOT NULL AND value IS NOT NULL GROUP BY usr, k)
SELECT 'u' || usr || '.k' || k AS rule_id, 1 AS rule_version, 0 AS block_index, 'SINGLE_EVENT' AS block_type, customer, event_id, ms AS event_ms
FROM ev JOIN r USING (usr, k) WHERE value::FLOAT::DOUBLE > over""",
        "sliding_windows": f"""WITH {EV}, s AS (SELECT event_id, ms FROM ev)
SELECT event_id, ws AS window_start_ms FROM ({_windows_sql('s', 5400000, 3600000)})""",
        "window_counts": f"""WITH {EV}
SELECT customer, 'type=' || type AS group_by, ms - (ms % 3600000) AS window_start_ms, count(*) AS event_count
FROM ev GROUP BY ALL""",
    }
