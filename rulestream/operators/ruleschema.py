"""The declarative rule schema (V13): a constraint table, and the checks made from it.

``SHAPES`` says which properties an object of a rule may hold.  Its keys are
``kind/shape``: the kind is where the object stands, the shape is told by the
object itself (``_shape``).  A property's constraints are

    type, required, low, high, length (least), pattern, among (allowed texts),
    least (entries), distinct, item_type / item_low / item_length (of entries),
    child (kind of the object it holds), each (kind of the objects in its list)

The table reaches Spark as one literal, and one expression applies it to any
object, so a schema change is a table change.  Objects are checked one nesting
level per step, as conditions nest freely; JSON types are kept (variant), so
``"5"`` is no integer.  ``schema_violations`` returns one row per violation.
Text that is no JSON, an object that names a property twice, and a value that
is no object where one is wanted are violations too; NULL text is none of the
schema's business (``validate`` reports it) and an empty frame gives no rows.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.schemas import BLOCK_TYPES, COMPARISON_TYPES, COMPOSITE_TYPES
from rulestream.session import ensure_checkpoint_dir


def _one(type_: str, **more) -> dict:
    return {"type": type_, **more}


def _needs(**constraints) -> dict:
    return {"required": True, **constraints}


_TEXT, _NAME = _one("string"), _one("string", length=1)
_ZERO, _COUNT = _one("integer", low=0, high=0), _one("integer", low=1)
_NUMERAL = _one("string", pattern="^[0-9]+$")
_CONDITION = _needs(type="object", child="condition")
_CLASS = {"@class": _needs(**_TEXT)}
_BLOCKS = _needs(type="array", least=1, each="block")
_INDICES = {"blockIndices": _needs(type="array", distinct=True, item_type="integer", item_low=0)}


def _block_shape(holds: str | None, **more) -> dict:
    held = {} if holds is None else {"parameters": _needs(type="object", child=holds)}
    return {"type": _needs(type="string", among=BLOCK_TYPES), "condition": _CONDITION, **held, **more}


_SLIDING = {"windowSize": _needs(**_COUNT), "windowSlide": _needs(**_COUNT),
            "aggregationGroupingFields": _needs(type="array", item_type="string", item_length=1)}
_SEVERITY = {"baseSeverity": _one("integer")}

SHAPES = {
    "rule/SINGLE_EVENT": {**_SEVERITY, "blocks": _BLOCKS, "windowSize": _ZERO, "windowSlide": _ZERO},
    "rule/one block": {**_SEVERITY, "blocks": _BLOCKS, "groupByField": _TEXT, "windowSize": _ZERO, "windowSlide": _ZERO},
    "rule/several blocks": {**_SEVERITY, "blocks": _BLOCKS, "groupByField": _needs(**_TEXT), "windowSize": _needs(**_COUNT),
                            "windowSlide": _needs(**_COUNT), "ruleCondition": _needs(type="object", child="rule condition")},
    "block/SINGLE_EVENT": _block_shape(None, parameters=_one("object")),
    "block/THRESHOLD": _block_shape("threshold parameters", **_SLIDING),
    "block/UNIQUE_THRESHOLD": _block_shape("threshold parameters", **_SLIDING),
    "block/SIMPLE_ANOMALY": _block_shape("anomaly parameters", windowSize=_needs(**_COUNT)),
    "block/DROP_TO_ZERO": _block_shape(None, windowSize=_needs(**_COUNT)),
    "threshold parameters/": {"THRESHOLD": _NUMERAL, "UNIQUE_FIELD": _NAME},
    "anomaly parameters/": {"SIMPLE_ANOMALY_THRESHOLD": _NUMERAL},
    "condition/EqualCondition": {**_CLASS, "key": _needs(**_NAME), "value": _needs(**_TEXT)},
    "condition/RegexCondition": {**_CLASS, "key": _needs(**_NAME), "regex": _needs(**_TEXT)},
    "condition/ComparisonCondition": {**_CLASS, "key": _needs(**_NAME), "thresholdValue": _needs(type="number"),
                                      "type": _needs(type="string", among=list(COMPARISON_TYPES))},
    "condition/CompositeCondition": {**_CLASS, "type": _needs(type="string", among=COMPOSITE_TYPES),
                                     "conditions": _needs(type="array", least=2, each="condition")},
    "rule condition/AllBlocksOccurredRuleCondition": {**_CLASS, **_INDICES},
    "rule condition/AnyBlocksOccurredRuleCondition": {**_CLASS, **_INDICES},
    "rule condition/CompositeRuleCondition": {**_CLASS, "type": _needs(type="string", among=COMPOSITE_TYPES),
                                              "conditions": _needs(type="array", each="rule condition")},
    "rule condition/SequenceRuleCondition": {**_CLASS, "conditions": _needs(type="array", each="sequence entry")},
    "sequence entry/": {"blockIndex": _one("integer", low=0), "notPresent": _one("boolean")},
}
# Objects of these kinds may hold further properties.
OPEN_KINDS = ["threshold parameters", "anomaly parameters", "sequence entry"]

_CONSTRAINT = ("name string, type string, required boolean, low double, high double, length int, pattern string, "
               "among array<string>, least int, distinct boolean, item_type string, item_low double, item_length int, "
               "child string, each string")


def _table() -> Column:
    """The constraint table as a literal: kind/shape -> constraints."""
    rows = {shape: [{"name": name, **c} for name, c in props.items()] for shape, props in SHAPES.items()}
    return F.from_json(F.lit(json.dumps(rows)), f"map<string,array<struct<{_CONSTRAINT.replace(' ', ':').replace(',:', ',')}>>>")


def _type_of(v: Column) -> Column:
    """JSON type of a variant."""
    t = F.schema_of_variant(v)
    return (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").when(t == "STRING", "string")
            .when(t == "BOOLEAN", "boolean").when(t == "VOID", "null")
            .when(t.rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\))$"), "integer").otherwise("number"))


def _is(found: Column, type_: Column) -> Column:
    return (found == type_) | ((type_ == "number") & (found == "integer"))


def _get(v: Column, as_: str) -> Column:
    return F.try_variant_get(v, "$", as_)


def _violations() -> Column:
    """What is wrong with a property ``p`` (NULL: absent) of type ``t`` under its constraints ``c``."""
    c = {name: F.col(f"c.{name}") for name in ("name", "type", "required", "low", "high", "length", "pattern", "among", "least",
                                                "distinct", "item_type", "item_low", "item_length")}
    typed, text, entries = F.coalesce("typed", F.lit(False)), F.col("text"), F.col("entries")
    texts = F.transform(entries, lambda e: F.to_json(e))
    cases = [
        (F.col("t").isNull() & c["required"], F.lit("is missing")),
        (~F.col("typed"), F.concat(F.lit("is not of type "), c["type"])),
        (typed & (F.col("number") < c["low"]), F.lit("is too small")),
        (typed & (F.col("number") > c["high"]), F.lit("is too large")),
        (F.length(text) < c["length"], F.lit("is too short")),
        (~F.regexp_like(text, c["pattern"]), F.lit("has a wrong form")),
        (~F.array_contains(c["among"], text), F.lit("is none of the allowed values")),
        (F.size(entries) < c["least"], F.lit("has too few entries")),
        (c["distinct"] & (F.size(F.array_distinct(texts)) < F.size(texts)), F.lit("has an entry twice")),
        (F.exists(entries, lambda e: ~_is(_type_of(e), c["item_type"])), F.concat(F.lit("has an entry not of type "), c["item_type"])),
        (F.exists(entries, lambda e: _get(e, "double") < c["item_low"]), F.lit("has an entry that is too small")),
        (F.exists(entries, lambda e: F.length(_get(e, "string")) < c["item_length"]), F.lit("has an entry that is too short")),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.concat(c["name"], F.lit(" "), what)) for bad, what in cases]))


def _shape(kind: Column, m: Column) -> Column:
    """Which of its kind's shapes an object claims to have."""
    text = lambda name: F.coalesce(_get(m[name], "string"), F.lit(""))
    blocks = _get(m["blocks"], "array<variant>")
    first = F.try_variant_get(F.get(blocks, F.lit(0)), "$.type", "string")
    return (F.when(kind == "rule", F.when(F.size(blocks) > 1, "several blocks").when(first == "SINGLE_EVENT", "SINGLE_EVENT").otherwise("one block"))
            .when(kind == "block", text("type"))
            .when(kind.isin("condition", "rule condition"), F.regexp_extract(text("@class"), r"([^.]*)$", 1))
            .otherwise(""))


def _children() -> Column:
    """The objects that a property holds, with their kind and path."""
    at = F.concat("path", F.lit("."), F.col("c.name"))
    node = lambda kind, where, v: F.struct(F.col(kind).alias("kind"), where.alias("path"), F.to_json(v).alias("js"))
    return (F.when(F.col("c.child").isNotNull() & (F.col("t") == "object"), F.array(node("c.child", at, F.col("p"))))
            .when(F.col("c.each").isNotNull(), F.transform("entries", lambda e, i: node(
                "c.each", F.concat(at, F.lit("["), i.cast("string"), F.lit("]")), e))))


def schema_violations(rules: DataFrame, content_col: str = "content") -> DataFrame:
    """(content, path, problem): every violation of the schema, for each distinct rule text."""
    nodes = rules.select(F.col(content_col).cast("string").alias("content")).where("content is not null").distinct()
    nodes = nodes.select("content", F.lit("rule").alias("kind"), F.lit("$").alias("path"), F.col("content").alias("js"))
    ensure_checkpoint_dir(rules.sparkSession)
    found = []
    while True:
        nodes = nodes.checkpoint(eager=True)  # every level is written once, so deep rules cost one pass per level
        if nodes.isEmpty():
            break
        level = nodes.withColumn("v", F.try_parse_json("js")).withColumn("m", F.when(_type_of(F.col("v")) == "object", _get(F.col("v"), "map<string,variant>")))
        level = level.withColumn("shape", F.concat("kind", F.lit("/"), _shape(F.col("kind"), F.col("m"))))
        level = level.withColumn("known", F.element_at(_table(), F.col("shape")))
        m, known = F.col("m"), F.col("known")
        extra = F.array_sort(F.array_except(F.map_keys(m), F.transform(known, lambda c: c["name"])))
        whole = (F.when(m.isNull(), F.array(F.lit("is not a JSON object")))
                 .when(known.isNull(), F.array(F.concat(F.lit("is no known "), F.col("kind"))))
                 .when(~F.col("kind").isin(*OPEN_KINDS), F.transform(extra, lambda k: F.concat(k, F.lit(" is not allowed")))))
        found.append(level.select("content", "path", F.explode(whole).alias("problem")))
        held = level.where(m.isNotNull()).select("content", "path", "m", F.explode(known).alias("c"))
        held = held.withColumn("p", m[F.col("c.name")]).withColumn("t", F.when(F.col("p").isNotNull(), _type_of(F.col("p"))))
        held = held.select("content", "path", "c", "p", "t", _is(F.col("t"), F.col("c.type")).alias("typed"),
                           F.when(F.col("t") == "string", _get(F.col("p"), "string")).alias("text"),
                           F.when(F.col("t").isin("integer", "number"), _get(F.col("p"), "double")).alias("number"),
                           F.when(F.col("t") == "array", _get(F.col("p"), "array<variant>")).alias("entries"))
        found.append(held.select("content", "path", F.explode(_violations()).alias("problem")))
        nodes = held.select("content", F.explode(_children()).alias("n")).select("content", "n.*")
    if not found:
        return nodes.select("content", "path", F.col("js").alias("problem"))
    return reduce(DataFrame.unionByName, found)
