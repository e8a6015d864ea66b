"""Guard index: rules as data, met by an equi-join instead of a nested loop.

A block's condition usually implies an equality: its program can only be true
when some field's text is one of a few values.  ``guard_index`` derives such
an equality for every block as a Spark expression over the postfix program
(nothing is collected) and yields one row per (block, guard value):

    gk, gv (guard field and value), and the block's own columns

Blocks that imply no equality get the pair ('', ''), and every event carries
that pair too, so one equi-join on (gk, gv) serves all blocks of a rule side
that is broadcast: an event meets the blocks its values can satisfy, and the
full condition is evaluated on those pairs alone.

An event's pairs are its own top-level fields, whatever they are, so the
join follows the rules when they change while a stream runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.functions.frames import join_ns

_ALT = "array<struct<key:string,vals:array<string>>>"


def guard_alternatives(prog: Column) -> Column:
    """Necessary equalities of a condition program: (field, values), any one of which is a valid guard.

    AND keeps the alternatives of all children; OR keeps a field that every
    child constrains, with the union of the values; other leaves give none.
    A value '' also stands for a missing field, which no event carries as a
    pair, so alternatives with '' are left out.
    """
    none = F.array().cast(_ALT)

    def step(st, i):
        n = F.coalesce(i["n"], F.lit(0))
        kids = F.slice(st, F.greatest(F.size(st) - n + 1, F.lit(1)), n)
        head = F.slice(st, F.lit(1), F.greatest(F.size(st) - n, F.lit(0)))
        vals = F.when(i["val"].isNull(), F.array().cast("array<string>")).otherwise(F.array(i["val"]))
        leaf = F.when((i["op"] == "eq") & (F.coalesce(i["key"], F.lit("")) != ""),
                      F.array(F.struct(i["key"].alias("key"), vals.alias("vals")))).otherwise(none)
        held = F.filter(F.coalesce(F.try_element_at(kids, F.lit(1)), none),
                        lambda a: F.forall(kids, lambda k: F.exists(k, lambda b: b["key"] == a["key"])))
        either = F.transform(held, lambda a: F.struct(
            a["key"].alias("key"),
            F.array_distinct(F.flatten(F.transform(
                kids, lambda k: F.get(F.filter(k, lambda b: b["key"] == a["key"]), F.lit(0))["vals"]))).alias("vals")))
        top = F.when(i["op"] == "or", either).when(i["op"] == "and", F.flatten(kids)).otherwise(leaf)
        rest = F.when(i["op"].isin("and", "or"), head).otherwise(st)
        return F.concat(rest, F.array(top))

    stack = F.aggregate(prog, F.array().cast(f"array<{_ALT}>"), step)
    alts = F.coalesce(F.try_element_at(stack, F.lit(-1)), none)
    return F.filter(alts, lambda a: ~F.array_contains(a["vals"], ""))


def guard_index(rb: DataFrame, second: bool = False) -> DataFrame:
    """Rule blocks (``rules.rule_blocks``) -> one row per (block, guard value).

    Of several alternatives a block takes the field with the most distinct
    guard values in the rule set: it splits the rules finest.  With ``second``
    the rows also have hk, hv: the next such field, of those that the block
    holds to a single value, or ('', '').  Both equalities are necessary, so
    an event need only meet the blocks whose two values it carries.
    """
    key = ["rule_id", "rule_version", "block_index"] + [c for c in ("valid_from_ms", "valid_to_ms") if c in rb.columns]
    if second:
        key.append("cond")  # blocks of one number keep their own pairs of equalities
    alts = rb.select(*key, F.explode(guard_alternatives(F.col("cond"))).alias("a")).select(*key, "a.key", "a.vals")
    spread = (alts.select("key", F.explode("vals").alias("v")).groupBy("key")
              .agg(F.count_distinct("v").alias("n_values")))
    order = F.struct(F.coalesce("n_values", F.lit(0)).alias("n"), (-F.size("vals")).alias("s"), "key")
    ranked = alts.join(spread, "key", "left")
    if second:
        ranked = ranked.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct(order.alias("o"), "key", "vals")), False).alias("a"))
        others = F.filter("a", lambda a: (a["key"] != F.col("a")[0]["key"]) & (F.size(a["vals"]) == 1))
        best = ranked.select(*key, F.col("a")[0].alias("g"), F.get(others, F.lit(0)).alias("h"))
    else:
        best = ranked.groupBy(*key).agg(F.max_by(F.struct("key", "vals"), order).alias("g"))
    j = join_ns(rb, best, key, "left")
    pairs = F.when(F.col("g").isNull(), F.array(F.struct(F.lit("").alias("gk"), F.lit("").alias("gv")))) \
        .otherwise(F.transform("g.vals", lambda v: F.struct(F.col("g.key").alias("gk"), v.alias("gv"))))
    also = [F.coalesce("h.key", F.lit("")).alias("hk"), F.coalesce(F.get("h.vals", F.lit(0)), F.lit("")).alias("hv")] if second else []
    return j.select(*rb.columns, *also, F.explode(pairs).alias("p")).select("p.gk", "p.gv", *(["hk", "hv"] if second else []), *rb.columns)


def with_pairs(events: DataFrame, free: bool = True, keys: list[str] | None = None) -> DataFrame:
    """Events, once per (field, value) pair ``g`` of theirs; with ``free`` also once for ('', '').

    ``keys`` are the guard fields where they are known; other fields' pairs
    are then not made at all.
    """
    entries = F.map_entries("fields")
    if keys is not None:
        entries = F.filter(entries, lambda e: e["key"].isin(keys)) if keys else F.slice(entries, 1, 0)
    pairs = F.transform(F.filter(entries, lambda e: e["value"].isNotNull() & (e["key"] != "")),
                        lambda e: F.struct(e["key"].alias("gk"), e["value"].alias("gv")))
    if free:
        pairs = F.concat(F.array(F.struct(F.lit("").alias("gk"), F.lit("").alias("gv"))), pairs)
    return events.select("*", F.explode(pairs).alias("g"))


def with_double_pairs(events: DataFrame, free: bool, fields: list[tuple[str, str]]) -> DataFrame:
    """Events, once per pair of guard fields (gk, hk) of which they have values, and with ``free`` for ('', ''); hk may be ''."""
    fields = [*([("", "")] if free else []), *fields]
    if not fields:
        return events.select("*", F.explode(F.array().cast("array<struct<gk:string,gv:string,hk:string,hv:string>>")).alias("g"))
    value = lambda k: F.col("fields")[F.lit(k)] if k else F.lit("")
    pairs = F.array(*[F.struct(F.lit(a).alias("gk"), value(a).alias("gv"), F.lit(b).alias("hk"), value(b).alias("hv")) for a, b in fields])
    return events.select("*", F.explode(F.filter(pairs, lambda p: p["gv"].isNotNull() & p["hv"].isNotNull())).alias("g"))
