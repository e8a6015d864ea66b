"""Rule and control validation (V1-V13) as DataFrame checks.

``rule_errors(rules)`` adds ``errors ARRAY<STRING>`` to a parsed rules frame
(V2-V12, plus the property-name check of V13 that decoding needs);
``control_errors(ctrl)`` adds the control-message checks (V1) and, for
ADD_RULE rows, the errors of the decoded rule.  An empty array means valid.
``strict=True`` adds the violations of the declarative rule schema (``ruleschema``).

Every check is a Column expression: ``when(bad, message)`` entries collected
into an array and filtered for NULLs - no Python per rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.functions.frames import join_ns
from rulestream.operators.rules import parse_rules
from rulestream.operators.ruleschema import schema_violations
from rulestream.schemas import BLOCK_KEYS, BLOCK_TYPES, RULE_KEYS, RULE_NUMBERS
from rulestream.session import ensure_checkpoint_dir

_ISO_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?Z$"


def _errs(*pairs) -> Column:
    """Array of messages whose condition holds (conditions NULL = false)."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), m) for c, m in pairs]),
                    lambda x: x.isNotNull())


def _lit(s: str) -> Column:
    return F.lit(s)


def _positive_int(params: Column, name: str) -> Column:
    v = params[F.lit(name)]
    return v.isNotNull() & (v != "") & F.coalesce(v.try_cast("int") > 0, F.lit(False))


def _condition_errors(prog: Column) -> Column:
    """V10 over a postfix condition program."""
    return F.flatten(F.transform(prog, lambda i: _errs(
        (i["op"] == "bad", F.concat(_lit("undecodable condition: "), F.coalesce(i["val"], _lit("")))),
        (i["op"].isin("eq", "regex", "err", "gt", "ge", "lt", "le") & (F.coalesce(i["key"], _lit("")) == ""),
         _lit("a condition names no field")),
        ((i["op"] == "eq") & (F.coalesce(i["val"], _lit("")) == ""), _lit("an equality has no value to compare with")),
        (i["op"].isin("regex", "err") & (F.coalesce(i["val"], _lit("")) == "") & i["num"].isNull(),
         _lit("a regex condition has no pattern")),
        (i["op"].isin("and", "or") & (F.coalesce(i["n"], F.lit(0)) == 0),
         _lit("a composite condition is empty")),
    )))


def _rule_condition_errors(prog: Column) -> Column:
    """V11 over a postfix rule-condition program."""
    return F.flatten(F.transform(prog, lambda i: _errs(
        (i["op"] == "bad", _lit("undecodable rule condition")),
        (i["op"].isin("all", "any") & (F.coalesce(F.size(i["idx"]), F.lit(0)) <= 0),
         _lit("a rule condition lists no blocks")),
        (i["op"].isin("all", "any") & F.exists(F.coalesce(i["idx"], F.array().cast("array<int>")),
                                                lambda b: b.isNull() | (b < 0)),
         _lit("a rule condition lists a missing or negative block index")),
        (i["op"].isin("all", "any") & (F.size(F.array_distinct(i["idx"])) != F.size(i["idx"])),
         _lit("a rule condition lists a block twice")),
        ((i["op"] == "seq") & (F.coalesce(F.size(i["idx"]), F.lit(0)) <= 0),
         _lit("a sequence is empty")),
        ((i["op"] == "seq") & F.exists(F.coalesce(i["idx"], F.array().cast("array<int>")), lambda b: b.isNull()),
         _lit("a sequence has an entry without a block")),
        (i["op"].isin("and", "or") & (F.coalesce(i["n"], F.lit(0)) == 0),
         _lit("a composite rule condition is empty")),
    )))


def _block_errors(b: Column) -> Column:
    """V3-V9 for one block."""
    t = b["block_type"]
    p = F.coalesce(b["params"], F.create_map().cast("map<string,string>"))
    agg = b["agg_fields"]
    windowed = t.isin("THRESHOLD", "UNIQUE_THRESHOLD")
    counted = t.isin("SIMPLE_ANOMALY", "DROP_TO_ZERO")
    base = _errs(
        (b["cond"].isNull(), _lit("a block has no condition")),
        (t.isNull(), _lit("a block has no type")),
        (t.isNotNull() & ~t.isin(*BLOCK_TYPES), F.concat(_lit("there is no block type "), F.coalesce(t, _lit("")), _lit("."))),
        # SINGLE_EVENT
        ((t == "SINGLE_EVENT") & (b["window_size"] != 0), _lit("a SINGLE_EVENT block takes no windowSize")),
        ((t == "SINGLE_EVENT") & (b["window_slide"] != 0), _lit("a SINGLE_EVENT block takes no windowSlide")),
        ((t == "SINGLE_EVENT") & agg.isNotNull() & (F.size(agg) > 0),
         _lit("a SINGLE_EVENT block takes no aggregationGroupingFields")),
        # windowed blocks
        ((windowed | counted) & (b["window_size"] <= 0), _lit("a windowed block needs a windowSize above 0")),
        (windowed & (b["window_slide"] <= 0), _lit("a sliding block needs a windowSlide above 0")),
        (counted & (b["window_slide"] > 0), _lit("a counting block takes no windowSlide")),
        (windowed & (agg.isNull() | (F.size(agg) == 0)), _lit("a threshold block needs aggregationGroupingFields")),
        (windowed & agg.isNotNull() & F.exists(F.coalesce(agg, F.array().cast("array<string>")),
                                                lambda f: f.isNull() | (f == "")),
         _lit("an entry of aggregationGroupingFields is empty")),
        (windowed & ~_positive_int(p, "THRESHOLD"), _lit("THRESHOLD must be a whole number above 0")),
        ((t == "UNIQUE_THRESHOLD") & (F.coalesce(p[F.lit("UNIQUE_FIELD")], _lit("")) == ""),
         _lit("a UNIQUE_THRESHOLD block needs UNIQUE_FIELD")),
        ((t == "SIMPLE_ANOMALY") & ~_positive_int(p, "SIMPLE_ANOMALY_THRESHOLD"),
         _lit("SIMPLE_ANOMALY_THRESHOLD must be a whole number above 0")),
    )
    return F.concat(base, F.coalesce(_condition_errors(b["cond"]), F.array().cast("array<string>")))


def rule_errors(rules: DataFrame, strict: bool = False) -> DataFrame:
    """Parsed rules (``operators.rules.parse_rules``) + ``errors``."""
    blocks = F.coalesce(F.col("blocks"), F.array().cast(rules.schema["blocks"].dataType))
    nb = F.size(blocks)
    raw = F.from_json("content", "map<string,string>")
    raw_blocks = F.from_json(F.col("content"), "struct<blocks:array<map<string,string>>>")["blocks"]
    unknown_rule_keys = F.array_except(F.map_keys(raw), F.array(*[F.lit(k) for k in RULE_KEYS]))
    unknown_block_keys = F.flatten(F.transform(
        F.coalesce(raw_blocks, F.array().cast("array<map<string,string>>")),
        lambda m: F.array_except(F.map_keys(m), F.array(*[F.lit(k) for k in BLOCK_KEYS]))))
    # numbers may come as text, but must be numbers
    bad_numbers = F.filter(F.array(*[F.lit(k) for k in RULE_NUMBERS]),
                           lambda k: raw[k].isNotNull() & raw[k].try_cast("int").isNull())
    single_event_only = (nb == 1) & (blocks[0]["block_type"] == "SINGLE_EVENT")
    rule_level = _errs(
        (F.col("content").isNull() | (F.col("content") == ""), _lit("there is no rule")),
        (F.col("content").isNotNull() & raw.isNull(), _lit("the rule is not a JSON object")),
        (F.size(unknown_rule_keys) > 0, F.concat(_lit("unknown rule property: "),
                                                 F.array_join(unknown_rule_keys, ","))),
        (F.size(unknown_block_keys) > 0, F.concat(_lit("unknown block property: "),
                                                  F.array_join(unknown_block_keys, ","))),
        (F.size(bad_numbers) > 0, F.concat(_lit("not a whole number: "), F.array_join(bad_numbers, ","))),
        (raw.isNotNull() & (nb == 0), _lit("the rule has no blocks")),
        ((nb > 1) & F.col("rule_program").isNull(), _lit("several blocks need a ruleCondition")),
        ((nb > 1) & (F.col("rule_window_size") <= 0), _lit("several blocks need a rule windowSize")),
        ((nb > 1) & (F.col("rule_window_slide") <= 0), _lit("several blocks need a rule windowSlide")),
        ((nb == 1) & F.col("rule_program").isNotNull(), _lit("one block takes no ruleCondition")),
        ((nb == 1) & (F.col("rule_window_size") > 0), _lit("one block takes no rule windowSize")),
        ((nb == 1) & (F.col("rule_window_slide") > 0), _lit("one block takes no rule windowSlide")),
        ((nb >= 1) & ~single_event_only & (F.coalesce(F.col("group_by_field"), _lit("")) == ""),
         _lit("all rules but those of one SINGLE_EVENT block need a groupByField")),
    )
    all_errs = F.concat(
        rule_level,
        F.flatten(F.transform(blocks, _block_errors)),
        F.coalesce(F.when(nb > 1, _rule_condition_errors(F.col("rule_program"))), F.array().cast("array<string>")))
    checked = rules.withColumn("errors", all_errs)
    if not strict:
        return checked
    found = schema_violations(rules).groupBy(F.col("content").alias("_text")).agg(F.array_sort(F.collect_list(
        F.concat_ws(" ", F.lit("schema:"), "path", "problem"))).alias("_found"))
    joined = checked.join(found, F.col("content") == F.col("_text"), "left")
    return joined.withColumn("errors", F.concat("errors", F.coalesce("_found", F.array().cast("array<string>")))).drop("_text", "_found")


def control_errors(ctrl: DataFrame, strict: bool = False) -> DataFrame:
    """Control frame (``sources.control.parse_control``) + ``errors`` (V1)."""
    add = ctrl.where(F.col("type") == "ADD_RULE").select("seq", "content")
    # what is wrong with a rule is in its text: each text is checked once, and kept for the jobs that decode it
    ensure_checkpoint_dir(ctrl.sparkSession)
    texts = add.select("content").distinct().checkpoint(eager=True)
    checked = rule_errors(parse_rules(texts.select(F.lit("r").alias("rid"), F.lit(0).alias("rv"), "content"), id_col="rid", version_col="rv"), strict)
    dec = F.from_json(F.col("content"), "struct<id:string,version:string>")
    rule_side = join_ns(add, checked.select("content", F.col("errors").alias("rule_errs")), ["content"], "left").drop("content")
    c = ctrl.join(rule_side, "seq", "left")
    is_add, is_remove = F.col("type") == "ADD_RULE", F.col("type") == "REMOVE_RULE"
    bad_id = F.coalesce(F.col("rule_id"), _lit("")) == ""
    bad_version = F.col("rule_version") <= 0
    content_id = dec["id"]
    content_version = F.coalesce(dec["version"].try_cast("int"), F.lit(0))
    v1 = _errs(
        (F.col("schema_version") != 1, F.format_string("control schema %d is unknown, this engine reads 1", F.col("schema_version"))),
        (F.col("timestamp").isNull(), _lit("the message has no timestamp")),
        (F.col("timestamp").isNotNull() & ~F.col("timestamp").rlike(_ISO_INSTANT),
         F.concat(_lit("not an ISO instant: "), F.coalesce(F.col("timestamp"), _lit("")))),
        ((is_add | is_remove) & bad_id, F.concat(_lit("unusable rule id: "), F.coalesce(F.col("rule_id"), _lit("null")))),
        ((is_add | is_remove) & bad_version, F.format_string("rule versions start at 1, not %d", F.col("rule_version"))),
        (is_add & content_id.isNotNull() & (content_id != F.coalesce(F.col("rule_id"), _lit(""))),
         F.format_string("the rule calls itself %s, the message calls it %s",
                         content_id, F.col("rule_id"))),
        (is_add & (content_version != 0) & (content_version != F.col("rule_version")),
         F.format_string("the rule is of version %d, the message of version %d",
                         content_version, F.col("rule_version"))),
    )
    return c.withColumn("errors", F.concat(
        v1, F.when(is_add, F.coalesce("rule_errs", F.array().cast("array<string>")))
        .otherwise(F.array().cast("array<string>")))).drop("rule_errs")
