"""Control log fold (K1-K6): control messages -> acknowledgements + rule history.

The rule store is a fold over the control log in arrival order, per rule id:
the state is the active version (or none) and its content.

* ADD_RULE applies when the id is absent or the new version is higher;
  otherwise nothing changes and the ack carries the *current* version.
* REMOVE_RULE of an absent rule acknowledges; of another version is an
  error; of the active version removes it (any version may be added again).
* A message failing validation is an ERROR ack and changes nothing.
* QUERY_STATUS acknowledges with the list of rules active at that point.

The fold is incremental: ``fold_messages`` takes the messages of a batch and
the rules active before it, and yields acks, the effective-dated history
that the batch touches, and with it (``active_at``) the rules active after
it.  A whole log is the case of no rules before (``fold_control``).  Messages
are dealt by rule id and sorted; one pass with a rule's current version as
its only state answers them, so neither a rule's log nor the rule store is
ever held in a row by the fold.  The history (``valid_from_seq``/``valid_to_seq``, and the
control timestamps as ``valid_from_ms``/``valid_to_ms``) comes from ``lead``
over the applied changes, and status queries are answered from the lists of
the rules in force in their stretch of the log.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulestream.operators.validate import control_errors
from rulestream.schemas import MSG_VALIDATION_PREFIX, OUTPUT_TIME_FORMAT
from rulestream.session import ensure_checkpoint_dir

STATUS_SPANS = 256
ENGINE_VERSION = "rulestream-0.1"

_STEPS = ("rk string, seq bigint, status string, ack_version int, message string, applied boolean, cur int, "
          "cur_content string")
ACTIVE = "rule_id string, rule_version int, content string, valid_from_seq bigint, valid_from_ms bigint"


def _answer(kind: str, rule_id: str, version: int, errors: str | None, cur: int | None):
    """One message against the rule's current version: status, acknowledged version, message, applied, new version."""
    if errors is not None:
        return "ERROR", version, MSG_VALIDATION_PREFIX + errors, False, cur
    if kind == "ADD_RULE":
        if cur is None or version > cur:
            return "RULE_ACTIVE", version, None, True, version
        return "RULE_ACTIVE", cur, None, False, cur
    if cur is None or cur == version:
        return "RULE_DEACTIVATED", version, None, cur is not None, None
    return "ERROR", version, f"Cannot remove version {version} of rule {rule_id}: version {cur} is active", False, cur


def _run_steps(it):
    """Rows by rule id, the state before its messages, messages in order -> one answer per message."""
    rule, cur = None, None
    for batch in it:
        out = []
        for rk, seq, kind, version, content, errors in zip(*(c.to_pylist() for c in batch.columns)):
            if rk != rule:
                rule, cur = rk, None
            if kind == "STATE":
                cur = version
                continue
            status, ack_version, message, applied, cur = _answer(kind, rk, version, errors, cur)
            out.append((rk, seq, status, ack_version, message, applied, cur, content if applied and kind == "ADD_RULE" else None))
        if out:
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.string())
            names = [c.split()[0] for c in _STEPS.split(", ")]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def fold_messages(ctrl: DataFrame, active: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(messages, rules active before) -> (acks, history).

    acks: one row per message - version, timestamp, inputTimestamp, action,
    status, ruleId, ruleVersion, controlSchemaVersion, content (+ seq).
    history: rule_id, rule_version, content, valid_from_seq, valid_to_seq,
    valid_from_ms, valid_to_ms - every version that is active before, during
    or after the batch.
    """
    if active is None:
        active = ctrl.sparkSession.createDataFrame([], ACTIVE)
    ensure_checkpoint_dir(ctrl.sparkSession)
    c = control_errors(ctrl, strict)
    kept = F.when(F.size("errors") == 0, F.col("content")).alias("content")  # no other content is read again
    c = c.select("seq", "timestamp", "type", "rule_id", "rule_version", kept, "errors").checkpoint(eager=True)  # decoded and checked once
    changes = c.where(F.col("type").isin("ADD_RULE", "REMOVE_RULE")).select(
        F.coalesce("rule_id", F.lit("")).alias("rk"), "seq", F.col("type").alias("kind"), "rule_version", "content",
        F.when(F.size("errors") > 0, F.array_join("errors", " ")).alias("errors"))
    before = active.join(changes.select(F.col("rk").alias("rule_id")).distinct(), "rule_id", "left_semi").select(
        F.col("rule_id").alias("rk"), F.lit(-1).cast("bigint").alias("seq"), F.lit("STATE").alias("kind"), "rule_version",
        F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("errors"))
    rows = before.unionByName(changes).repartition("rk").sortWithinPartitions("rk", "seq")
    steps = rows.mapInArrow(_run_steps, _STEPS)
    base = c.select("seq", "timestamp", "type", "rule_id", "rule_version", "errors")
    change_acks = steps.join(base, "seq").select(
        "seq", "timestamp", "type", "rule_id", F.col("ack_version").alias("rule_version"), "status",
        F.col("message").alias("content"))
    applied = steps.where("applied").join(base.select("seq", "timestamp"), "seq").select(
        F.col("rk").alias("rule_id"), F.col("cur").alias("rule_version"), F.col("cur_content").alias("content"),
        F.col("seq").alias("valid_from_seq"), _ts_ms(F.col("timestamp")).alias("valid_from_ms"))
    hist = history_of(applied.unionByName(active.select(*applied.columns))).checkpoint(eager=True)  # read by queries, and by the next batch
    queries = c.where(F.col("type") == "QUERY_STATUS")
    status = status_acks(queries, hist)
    acks = change_acks.unionByName(status)
    now = F.date_format(F.current_timestamp(), OUTPUT_TIME_FORMAT)
    acks = acks.select(
        F.lit(ENGINE_VERSION).alias("version"), now.alias("timestamp"), F.col("timestamp").alias("inputTimestamp"),
        F.col("type").alias("action"), "status", F.col("rule_id").alias("ruleId"),
        F.col("rule_version").alias("ruleVersion"), F.lit(0).alias("controlSchemaVersion"), "content", "seq")
    return acks, hist


def fold_control(ctrl: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """A whole control log -> (acks, history), see ``fold_messages``."""
    return fold_messages(ctrl, None, strict)


def _ts_ms(ts):
    return F.unix_millis(F.try_to_timestamp(ts))


def history_of(applied: DataFrame) -> DataFrame:
    """K6: applied changes (rule_version NULL: removed) -> effective-dated rule versions."""
    w = Window.partitionBy("rule_id").orderBy("valid_from_seq")
    h = applied.select("*", F.lead("valid_from_seq").over(w).alias("valid_to_seq"), F.lead("valid_from_ms").over(w).alias("valid_to_ms"))
    return h.where(F.col("rule_version").isNotNull()).select(
        "rule_id", "rule_version", "content", "valid_from_seq", "valid_to_seq", "valid_from_ms", "valid_to_ms")


def active_at(history: DataFrame, seq: int | None = None) -> DataFrame:
    """Rules active after control message ``seq`` (default: at the end)."""
    h = history
    if seq is None:
        return h.where(F.col("valid_to_seq").isNull())
    return h.where((F.col("valid_from_seq") <= seq) & (F.col("valid_to_seq").isNull() | (F.col("valid_to_seq") > seq)))


def stored_rule(content: Column, rule_id: Column, version: Column) -> Column:
    """Rule JSON with its id and version set, as the store keeps it."""
    own = F.map_filter(F.from_json(content, "map<string,variant>"), lambda k, _: ~k.isin("id", "version"))
    ids = F.create_map(F.lit("id"), rule_id.cast("variant"), F.lit("version"), version.cast("variant"))
    return F.coalesce(F.to_json(F.map_concat(ids, own)), content)


def status_acks(queries: DataFrame, history: DataFrame) -> DataFrame:
    """K3: each QUERY_STATUS -> JSON list of the rules active at that point.

    The log between the first and the last query is cut into ``STATUS_SPANS``
    spans.  Each rule version is written as JSON once, and the versions in
    force at any query of a span are listed once per span, in the order of
    the answer (whose size the list has, but for the span's own changes).
    Neighbours in force at all of the span's queries are joined to one piece
    of text there (``_pieces``), so a query picks among as many pieces as the
    span has changes, and copies long texts: no row is made, sent or sorted,
    and no rule is looked at, per query and rule.  The number of queries is
    not bounded.
    """
    ends = queries.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    span = lambda c: F.floor((c - F.col("lo")) / F.ceil((F.col("hi") - F.col("lo") + 1) / STATUS_SPANS))
    q = queries.groupBy("seq", "timestamp", "type", "errors").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    q = q.join(ends).select("seq", "timestamp", "type", "errors", "copies", span(F.col("seq")).alias("span"))
    asked = q.groupBy("span").agg(F.min("seq").alias("first"), F.max("seq").alias("last"), F.max("copies").alias("most"))
    listed = F.struct("rule_id", F.to_json(F.struct(
        F.col("rule_id").alias("ruleId"), F.col("rule_version").alias("ruleVersion"),
        stored_rule(F.col("content"), F.col("rule_id"), F.col("rule_version")).alias("content"))).alias("text"), "valid_from_seq", "valid_to_seq")
    h = history.join(ends).where((F.col("valid_from_seq") < F.col("hi")) & (F.coalesce("valid_to_seq", "hi") >= F.col("lo")))
    first, last = F.greatest("valid_from_seq", "lo"), F.least(F.coalesce("valid_to_seq", "hi"), "hi")
    h = h.where(F.col("rule_id").isNotNull()).select(listed.alias("r"), F.sequence(span(first), span(last)).alias("spans"))
    h = h.select("r", F.explode("spans").alias("span"))
    # by number, so that AQE joins no spans: a list is many times its shuffled size
    h = h.repartition(STATUS_SPANS, "span").groupBy("span").agg(F.sort_array(F.collect_list("r")).alias("listed")).join(F.broadcast(asked), "span")
    single = F.when(F.col("most") > 1, F.col("listed")).alias("single")  # only equal queries need each text by itself
    h = h.select("span", single, _pieces(F.col("listed"), F.col("first"), F.col("last")).alias("pieces"))
    lists = q.repartition(STATUS_SPANS, "span").join(h, "span", "left")
    live = lambda c: F.filter(c, lambda r: (r["valid_from_seq"].isNull() | (r["valid_from_seq"] < F.col("seq"))) & (
        r["valid_to_seq"].isNull() | (r["valid_to_seq"] > F.col("seq"))))
    repeated = F.transform(live("single"), lambda r: F.array_join(F.array_repeat(r["text"], F.col("copies")), ","))
    text = F.array_join(F.when(F.col("copies") > 1, repeated).otherwise(live("pieces")["text"]), ",")
    invalid = F.size("errors") > 0
    return lists.select(
        "seq", "timestamp", "type", F.lit(None).cast("string").alias("rule_id"),
        F.lit(0).alias("rule_version"),
        F.when(invalid, F.lit("ERROR")).otherwise(F.lit("STATUS_UPDATE")).alias("status"),
        F.when(invalid, F.concat(F.lit(MSG_VALIDATION_PREFIX), F.array_join("errors", " ")))
        .otherwise(F.concat(F.lit("["), F.coalesce(text, F.lit("")), F.lit("]"))).alias("content"))


def _pieces(listed: Column, first: Column, last: Column) -> Column:
    """A span's versions in order -> texts: neighbours in force from ``first`` to ``last`` joined, without bounds; each other one by itself."""
    steady = lambda r: (r["valid_from_seq"] < first) & (r["valid_to_seq"].isNull() | (r["valid_to_seq"] > last))
    size, kind = F.size(listed), "array<struct<text:string,valid_from_seq:bigint,valid_to_seq:bigint>>"
    changing = F.filter(F.sequence(F.lit(1), size), lambda i: ~steady(F.element_at(listed, i)))
    none, no_bound = F.array().cast(kind), F.lit(None).cast("bigint")

    def between(a: Column, b: Column) -> Column:
        """The piece of the versions after a and before b, and that of b."""
        run = F.array(F.struct(F.array_join(F.slice(listed, a + 1, b - a - 1)["text"], ","), no_bound, no_bound)).cast(kind)
        at = F.element_at(listed, b)
        alone = F.array(F.struct(at["text"], at["valid_from_seq"], at["valid_to_seq"])).cast(kind)
        return F.concat(F.when(b - a > 1, run).otherwise(none), F.when(b <= size, alone).otherwise(none))

    return F.flatten(F.zip_with(F.concat(F.array(F.lit(0)), changing), F.concat(changing, F.array(size + 1)), between))


def acks_to_json(acks: DataFrame) -> DataFrame:
    """Acknowledgement rows -> JSON text (column ``value``)."""
    return acks.select(F.to_json(F.struct("version", "timestamp", "inputTimestamp", "action", "status", "ruleId",
                                          "ruleVersion", "controlSchemaVersion", "content")).alias("value"))


def rules_from_history(history: DataFrame) -> DataFrame:
    """Effective-dated history -> parsed rules frame carrying validity bounds
    (event time in [valid_from_ms, valid_to_ms)) for historical replays."""
    from rulestream.operators.rules import parse_rules
    return parse_rules(history.select("rule_id", "rule_version", "content", "valid_from_ms", "valid_to_ms"))
