"""Rule decoding: rule JSON (control ``content``) -> rules frame.

One row per rule version:

    rule_id, rule_version, base_severity, group_by_field,
    rule_window_size, rule_window_slide (seconds), n_blocks, rule_type,
    rule_program (postfix rule condition), blocks ARRAY<block>, content

with ``block`` = (block_index, block_type, cond (postfix program),
window_size, window_slide, agg_fields, params, threshold, unique_field,
anomaly_threshold).  Decoding is a Spark expression over the rules frame.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.functions.conditions import flatten_trees
from rulestream.schemas import (PARAM_ANOMALY_THRESHOLD, PARAM_THRESHOLD, PARAM_UNIQUE_FIELD,
                                RULE_JSON, RULE_TYPE_COMPLEX, RULE_TYPE_SIMPLE)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _seconds(c: Column) -> Column:
    """Absent: 0; not a whole number: -1, which no block type accepts."""
    return F.when(c.isNull(), F.lit(0).cast("bigint")).otherwise(F.coalesce(c.try_cast("bigint"), F.lit(-1).cast("bigint")))


def decode_rule(content: Column) -> Column:
    """Rule JSON text -> struct of decoded fields (NULL if not JSON)."""
    return F.from_json(content, RULE_JSON)


def _block(b: Column, i: Column, cond: Column) -> Column:
    params = b["parameters"]
    return F.struct(
        i.cast("int").alias("block_index"),
        b["type"].alias("block_type"),
        cond.alias("cond"),
        _seconds(b["windowSize"]).alias("window_size"),
        _seconds(b["windowSlide"]).alias("window_slide"),
        b["aggregationGroupingFields"].alias("agg_fields"),
        params.alias("params"),
        _int(params[F.lit(PARAM_THRESHOLD)]).alias("threshold"),
        params[F.lit(PARAM_UNIQUE_FIELD)].alias("unique_field"),
        _int(params[F.lit(PARAM_ANOMALY_THRESHOLD)]).alias("anomaly_threshold"),
    )


def parse_rules(df: DataFrame, id_col: str = "rule_id", version_col: str = "rule_version",
                content_col: str = "content") -> DataFrame:
    """Decode rule content.  ``df`` has one row per rule version to load;
    its other columns (e.g. validity bounds) are carried through.

    Condition trees are flattened once per distinct rule text; the programs
    are joined back by that text.
    """
    contents = df.select(F.col(content_col).alias("content")).where(F.col("content").isNotNull()).distinct()
    dec = contents.select("content", decode_rule(F.col("content")).alias("_r"))
    blk = dec.select("content", F.posexplode("_r.blocks").alias("block_index", "b"))
    cond = flatten_trees(blk.select("content", "block_index", F.col("b.condition").alias("js")),
                         ["content", "block_index"], "js", "cond", "cond").drop("js")
    blk = blk.join(cond, ["content", "block_index"], "left")
    by_index = lambda l, r: F.when(l["block_index"] < r["block_index"], -1) \
        .when(l["block_index"] > r["block_index"], 1).otherwise(0)
    blocks = blk.groupBy("content").agg(F.array_sort(F.collect_list(
        _block(F.col("b"), F.col("block_index"), F.col("cond"))), by_index).alias("blocks"))
    rprog = flatten_trees(dec.select("content", F.col("_r.ruleCondition").alias("js")),
                          ["content"], "js", "rule", "rule_program").drop("js")
    parsed = dec.join(rprog, "content", "left").join(blocks, "content", "left")
    keep = [c for c in df.columns if c not in (id_col, version_col, content_col)
            and c not in ("rule_id", "rule_version", "content")]
    out = df.select(
        F.col(id_col).cast("string").alias("rule_id"),
        F.col(version_col).cast("int").alias("rule_version"),
        F.col(content_col).alias("content"), *keep)
    out = out.join(parsed, "content", "left")
    rr = F.col("_r")
    return out.select(
        "rule_id", "rule_version",
        F.coalesce(_int(rr["baseSeverity"]), F.lit(0)).alias("base_severity"),
        rr["groupByField"].alias("group_by_field"),
        F.coalesce(rr["windowSize"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("rule_window_size"),
        F.coalesce(rr["windowSlide"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("rule_window_slide"),
        F.coalesce(F.size(rr["blocks"]), F.lit(0)).alias("n_blocks"),
        F.when(F.size(rr["blocks"]) > 1, F.lit(RULE_TYPE_COMPLEX)).otherwise(F.lit(RULE_TYPE_SIMPLE)).alias("rule_type"),
        "rule_program",
        F.coalesce("blocks", F.array().cast(blocks.schema["blocks"].dataType)).alias("blocks"),
        "content", *keep)


def rules_from_json(spark: SparkSession, rules: Iterable[tuple[str, int, str]]) -> DataFrame:
    """Rules given as (rule_id, version, json) triples, e.g. a rule catalogue in code."""
    df = spark.createDataFrame(list(rules), "rule_id string, rule_version int, content string")
    return parse_rules(df)


def rule_blocks(rules: DataFrame, program: bool = False) -> DataFrame:
    """One row per (rule version, block): the rule side of the match join; with
    the rule-condition program as JSON text (``program``) where asked for."""
    validity = [c for c in ("valid_from_ms", "valid_to_ms") if c in rules.columns]
    if program:
        validity.append(F.to_json("rule_program").alias("program"))
    return rules.select(
        "rule_id", "rule_version", "base_severity", "group_by_field", "rule_window_size",
        "rule_window_slide", "n_blocks", "rule_type", *validity, F.explode("blocks").alias("b")
    ).select("*", "b.*").drop("b")
