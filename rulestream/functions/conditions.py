"""Block conditions and rule conditions as Spark Columns.

A condition tree arrives as JSON (``@class`` discriminated).  Spark types
cannot recurse, so the tree is flattened into a postfix program
(``schemas.COND_PROGRAM``) one tree level at a time (``flatten_trees``), so
any nesting depth works with small expressions.  The program can then be

* evaluated row by row with higher-order functions (rules as data: the
  rule side of a broadcast join, or rules that change while a stream runs),
* or compiled on the driver into ordinary Column expressions (rules known
  when the plan is built: whole-stage codegen, parquet pushdown).

Error semantics (the reference catches an exception per block): a leaf that
cannot be evaluated yields NULL; ``and``/``or`` fold their children in order
so that an error before a deciding child poisons the result and an error
after it does not; a NULL result means "no match".
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.schemas import COMPARISON_TYPES
from rulestream.session import ensure_checkpoint_dir


def _cls(m: Column) -> Column:
    # '@class' is matched on its last dotted segment only.
    return F.regexp_extract(F.coalesce(m["@class"], F.lit("")), r"([^.]*)$", 1)


def _op(op, key=None, val=None, num=None, n=None) -> Column:
    def lit(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return x if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(lit(op, "string").alias("op"), lit(key, "string").alias("key"),
                    lit(val, "string").alias("val"), lit(num, "double").alias("num"),
                    lit(n, "int").alias("n"))


def _rop(op, idx=None, neg=None, n=None) -> Column:
    def lit(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return x if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(lit(op, "string").alias("op"), lit(idx, "array<int>").alias("idx"),
                    lit(neg, "array<boolean>").alias("neg"), lit(n, "int").alias("n"))


def _keys(*names) -> Column:
    return F.array(F.lit("@class"), *[F.lit(n) for n in names])


def _regex_ok(rx: Column) -> Column:
    # java.util.regex.Pattern.matches(rx, "") raises on a bad pattern.
    return F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("matches"),
                           rx, F.lit("")).isNotNull()


def _cond_node(m: Column, cls: Column, nkids: Column) -> Column:
    """One block-condition node -> program instruction."""
    key = m["key"]
    cmp_case = m["type"]
    cmp_op = F.when(m["type"].isNull(), F.lit("err"))
    for jtype, op in COMPARISON_TYPES.items():
        cmp_op = cmp_op.when(cmp_case == jtype, F.lit(op))
    cmp_op = cmp_op.otherwise(F.lit("bad"))
    regex = m["regex"]
    regex_op = F.when(regex.isNull(), F.lit("err")).when(_regex_ok(regex), F.lit("regex")).otherwise(F.lit("err"))
    num = F.coalesce(m["thresholdValue"].try_cast("double"), F.lit(0.0))
    ctype = m["type"]
    comp_kind = (F.when(m["type"].isNull() | (ctype == "AND"), F.lit("and"))
                 .when(ctype == "OR", F.lit("or")).otherwise(F.lit("bad")))
    unknown = F.size(F.array_except(F.map_keys(m), F.when(cls == "EqualCondition", _keys("key", "value"))
                                    .when(cls == "RegexCondition", _keys("key", "regex"))
                                    .when(cls == "ComparisonCondition", _keys("key", "thresholdValue", "type"))
                                    .otherwise(_keys("type", "conditions")))) > 0
    return (F.when(unknown, _op("bad", val=F.lit("unknown property")))
            .when(cls == "EqualCondition", _op("eq", key=key, val=m["value"]))
            .when(cls == "RegexCondition", _op(regex_op, key=key, val=regex))
            .when(cls == "ComparisonCondition", _op(cmp_op, key=key, num=num))
            .when(cls == "CompositeCondition", _op(comp_kind, n=nkids))
            .otherwise(_op("bad", val=F.concat(F.lit("unknown condition "), F.coalesce(cls, F.lit(""))))))


def _rule_node(m: Column, cls: Column, nkids: Column) -> Column:
    """One rule-condition node -> program instruction."""
    idx = F.from_json(m["blockIndices"], "array<int>")
    entries = F.from_json(m["conditions"], "array<struct<blockIndex:int,notPresent:boolean>>")
    ctype = m["type"]
    comp_kind = (F.when(m["type"].isNull() | (ctype == "AND"), F.lit("and"))
                 .when(ctype == "OR", F.lit("or")).otherwise(F.lit("bad")))
    unknown = F.size(F.array_except(F.map_keys(m), F.when(
        cls.isin("AllBlocksOccurredRuleCondition", "AnyBlocksOccurredRuleCondition"), _keys("blockIndices"))
        .otherwise(_keys("type", "conditions")))) > 0
    return (F.when(unknown, _rop("bad"))
            .when(cls == "AllBlocksOccurredRuleCondition", _rop("all", idx=idx))
            .when(cls == "AnyBlocksOccurredRuleCondition", _rop("any", idx=idx))
            .when(cls == "SequenceRuleCondition", _rop(
                "seq", idx=F.transform(entries, lambda e: e["blockIndex"]),
                neg=F.transform(entries, lambda e: F.coalesce(e["notPresent"], F.lit(False)))))
            .when(cls == "CompositeRuleCondition", _rop(comp_kind, n=nkids))
            .otherwise(_rop("bad")))


PLAIN_LEVELS = 4
_COMPOSITES = {"cond": "CompositeCondition", "rule": "CompositeRuleCondition"}


def flatten_trees(df: DataFrame, id_cols: list[str], js_col: str, kind: str,
                  out_col: str) -> DataFrame:
    """JSON condition trees -> postfix programs, one tree level per step.

    Each step parses the current level's nodes and explodes the children of
    composite nodes with their path; the loop ends when a level has no
    composite nodes (a small action on the rules frame, which is
    configuration-sized), however deep the trees are.  From level
    ``PLAIN_LEVELS`` on every level is checkpointed, so a deep tree costs one
    pass per level.  Nodes are then ordered post-order by their path
    (children before parents, siblings in order) and collected per tree.
    Rows whose tree is NULL get a NULL program.
    """
    node_fn = _cond_node if kind == "cond" else _rule_node
    comp = _COMPOSITES[kind]
    frontier = df.select(*id_cols, F.array().cast("array<int>").alias("path"), F.col(js_col).alias("js")) \
                 .where(F.col("js").isNotNull())
    levels = []
    while True:
        if len(levels) >= PLAIN_LEVELS:
            ensure_checkpoint_dir(df.sparkSession)
            frontier = frontier.checkpoint(eager=True)
        m = F.from_json("js", "map<string,string>")
        lvl = frontier.select(*id_cols, "path", m.alias("m")).select(
            *id_cols, "path", "m", _cls(F.col("m")).alias("cls"))
        kids = F.coalesce(F.from_json(F.col("m")["conditions"], "array<string>"), F.array().cast("array<string>"))
        lvl = lvl.select(*id_cols, "path", "m", "cls",
                         F.when(F.col("cls") == comp, kids).alias("kids"))
        levels.append(lvl.select(*id_cols, "path", node_fn(F.col("m"), F.col("cls"), F.size("kids")).alias("ins")))
        frontier = lvl.where(F.col("kids").isNotNull()).select(
            *id_cols, F.posexplode("kids").alias("i", "js"), "path"
        ).select(*id_cols, F.concat("path", F.array("i")).alias("path"), "js")
        if frontier.isEmpty():
            break
    nodes = levels[0]
    for lv in levels[1:]:
        nodes = nodes.unionByName(lv)
    # paths end in the largest int: [1, 0, max] sorts before [1, max] (child
    # before parent) and before [2, max] (siblings in order).
    key = F.concat("path", F.array(F.lit(2**31 - 1)))
    progs = nodes.groupBy(*id_cols).agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("ins").alias("ins")))).alias("p")
    ).select(*id_cols, F.transform("p", lambda x: x["ins"]).alias(out_col))
    return df.join(progs, id_cols, "left")


# ---------------------------------------------------------------------------
# Evaluation with higher-order functions (rules as data)
# ---------------------------------------------------------------------------

def _fold_or(cs: Column) -> Column:
    return F.aggregate(cs, F.lit(False), lambda x, y: F.when(x.isNull(), F.lit(None).cast("boolean"))
                       .when(x, F.lit(True)).otherwise(y))


def _fold_and(cs: Column) -> Column:
    return F.aggregate(cs, F.lit(True), lambda x, y: F.when(x.isNull(), F.lit(None).cast("boolean"))
                       .when(x, y).otherwise(F.lit(False)))


def float_value(v: Column) -> Column:
    """Text -> float32 widened to double, as a Java Float.parseFloat would."""
    return v.try_cast("float").cast("double")


def _eval_leaf(i: Column, field: Callable[[Column], Column]) -> Column:
    """One leaf instruction -> nullable boolean (NULL = error / never)."""
    v = field(i["key"])
    fv = float_value(v)
    empty = v == F.lit("")
    return (F.when(i["op"] == "eq", v == i["val"])
            .when(i["op"] == "regex", F.regexp(v, i["val"]))
            .when(i["op"] == "gt", F.when(empty, F.lit(False)).otherwise(fv > i["num"]))
            .when(i["op"] == "ge", F.when(empty, F.lit(False)).otherwise(fv >= i["num"]))
            .when(i["op"] == "lt", F.when(empty, F.lit(False)).otherwise(fv < i["num"]))
            .when(i["op"] == "le", F.when(empty, F.lit(False)).otherwise(fv <= i["num"]))
            .otherwise(F.lit(None).cast("boolean")))


def eval_condition(prog: Column, field: Callable[[Column], Column]) -> Column:
    """Evaluate a postfix condition program per row; ``field(key)`` gives text ('' if missing).

    A composite without all its operands never matches.

    The commonest shapes - one leaf, and AND/OR of leaves - are evaluated
    directly; other programs fold a boolean stack with ``aggregate``.  All
    paths share C5's ordered error rule.
    """
    def step(st, i):
        leaf = _eval_leaf(i, field)
        n = F.coalesce(i["n"], F.lit(0))
        tail = F.slice(st, F.greatest(F.size(st) - n + 1, F.lit(1)), n)
        head = F.slice(st, F.lit(1), F.greatest(F.size(st) - n, F.lit(0)))
        folded = F.when((n < 1) | (F.size(st) < n), F.lit(None).cast("boolean")) \
            .when(i["op"] == "or", _fold_or(tail)).otherwise(_fold_and(tail))
        return F.when(i["op"].isin("and", "or"), F.concat(head, F.array(folded))) \
            .otherwise(F.concat(st, F.array(leaf)))
    general = F.try_element_at(F.aggregate(prog, F.array().cast("array<boolean>"), step), F.lit(-1))

    size = F.size(prog)
    first, second, third = (F.try_element_at(prog, F.lit(k)) for k in (1, 2, 3))
    composite = ("and", "or")
    one_leaf = (size == 1) & ~first["op"].isin(*composite)
    two_leaves = ((size == 3) & third["op"].isin(*composite) & (F.coalesce(third["n"], F.lit(0)) == 2)
                  & ~first["op"].isin(*composite) & ~second["op"].isin(*composite))
    x, y = _eval_leaf(first, field), _eval_leaf(second, field)
    pair = (F.when(x.isNull(), F.lit(None).cast("boolean"))
            .when(third["op"] == "or", F.when(x, F.lit(True)).otherwise(y))
            .otherwise(F.when(x, y).otherwise(F.lit(False))))
    last = F.try_element_at(prog, F.lit(-1))
    leaves = F.slice(prog, F.lit(1), F.greatest(size - 1, F.lit(0)))
    flat = ((size > 3) & last["op"].isin(*composite) & (F.coalesce(last["n"], F.lit(0)) == size - 1)
            & ~F.exists(leaves, lambda i: i["op"].isin(*composite)))
    is_or = last["op"] == "or"
    many = F.aggregate(leaves, ~is_or, lambda acc, i: F.when(acc.isNull(), F.lit(None).cast("boolean"))
                       .when(acc == is_or, acc).otherwise(_eval_leaf(i, field)))
    out = (F.when(one_leaf, _eval_leaf(first, field)).when(two_leaves, pair).when(flat, many).otherwise(general))
    return F.coalesce(out, F.lit(False))


def eval_rule_condition(prog: Column, seen: Column, seq_ok: Column) -> Column:
    """Evaluate a rule-condition program over the set of block indices seen in
    a rule window; ``seq_ok`` maps program position -> sequence result."""
    indexed = F.transform(prog, lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def step(st, e):
        x = e["x"]
        leaf = (F.when(x["op"] == "all", F.forall(x["idx"], lambda b: F.array_contains(seen, b)))
                .when(x["op"] == "any", F.exists(x["idx"], lambda b: F.array_contains(seen, b)))
                .when(x["op"] == "seq", F.coalesce(F.try_element_at(seq_ok, e["i"]), F.lit(False)))
                .otherwise(F.lit(False)))
        n = F.coalesce(x["n"], F.lit(0))
        tail = F.slice(st, F.greatest(F.size(st) - n + 1, F.lit(1)), n)
        head = F.slice(st, F.lit(1), F.greatest(F.size(st) - n, F.lit(0)))
        folded = F.when((n < 1) | (F.size(st) < n), F.lit(False)) \
            .when(x["op"] == "or", F.exists(tail, lambda b: b)).otherwise(F.forall(tail, lambda b: b))
        return F.when(x["op"].isin("and", "or"), F.concat(head, F.array(folded))) \
            .otherwise(F.concat(st, F.array(F.coalesce(leaf, F.lit(False)))))
    out = F.aggregate(indexed, F.array().cast("array<boolean>"), step)
    return F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(False))


# ---------------------------------------------------------------------------
# Compilation to plain Columns (rules known when the plan is built)
# ---------------------------------------------------------------------------

class _Node:
    __slots__ = ("col", "nullable")

    def __init__(self, col: Column, nullable: bool):
        self.col, self.nullable = col, nullable


def compile_condition(program: Sequence, field: Callable[[str], Column], errors: bool = False) -> Column:
    """Compile a collected postfix program (list of Rows/dicts) to one Column;
    with ``errors`` it is NULL where the condition cannot be evaluated.

    ``field(name)`` returns the raw (nullable) text of a field.  Sub-trees
    that cannot produce an error compile to plain AND/OR so Catalyst can
    simplify and push them down; the ordered NULL fold is kept only where a
    comparison (unparsable number) or a bad pattern may raise.
    """
    stack: list[_Node] = []
    for ins in program:
        g = ins.asDict() if hasattr(ins, "asDict") else dict(ins)
        op, key = g["op"], g.get("key")
        if op == "eq":
            raw = field(key)
            val = g.get("val")
            if val is None:
                stack.append(_Node(F.lit(False), False))
            elif val == "":
                stack.append(_Node(F.coalesce(raw, F.lit("")) == F.lit(""), False))
            else:
                stack.append(_Node(raw.eqNullSafe(F.lit(val)), False))
        elif op == "regex":
            stack.append(_Node(F.coalesce(field(key), F.lit("")).rlike(g["val"]), False))
        elif op in ("gt", "ge", "lt", "le"):
            raw = F.coalesce(field(key), F.lit(""))
            fv = float_value(raw)
            num = F.lit(float(g["num"])).cast("double")
            cmp = {"gt": fv > num, "ge": fv >= num, "lt": fv < num, "le": fv <= num}[op]
            stack.append(_Node(F.when(raw == F.lit(""), F.lit(False)).otherwise(cmp), True))
        elif op in ("and", "or"):
            n = int(g.get("n") or 0)
            if not 1 <= n <= len(stack):  # operands are missing: never matches
                stack.append(_Node(F.lit(None).cast("boolean"), True))
                continue
            kids = stack[len(stack) - n:]
            del stack[len(stack) - n:]
            stack.append(_fold_nodes(op, kids))
        else:  # err / bad: never matches
            stack.append(_Node(F.lit(None).cast("boolean"), True))
    if not stack:
        return F.lit(False)
    top = stack[-1]
    if errors:
        return top.col
    return F.coalesce(top.col, F.lit(False)) if top.nullable else top.col


def _fold_nodes(op: str, kids: list[_Node]) -> _Node:
    if not any(k.nullable for k in kids):
        col = kids[0].col
        for k in kids[1:]:
            col = (col & k.col) if op == "and" else (col | k.col)
        return _Node(col, False)
    # ordered fold with error propagation, built right to left
    acc = kids[-1].col
    for k in reversed(kids[:-1]):
        if op == "or":
            acc = F.when(k.col.isNull(), F.lit(None).cast("boolean")).when(k.col, F.lit(True)).otherwise(acc)
        else:
            acc = F.when(k.col.isNull(), F.lit(None).cast("boolean")).when(k.col, acc).otherwise(F.lit(False))
    return _Node(acc, True)


def program_keys(program: Sequence) -> list[str]:
    """Field names a compiled program reads."""
    out = []
    for ins in program:
        g = ins.asDict() if hasattr(ins, "asDict") else dict(ins)
        if g.get("key") and g["op"] in ("eq", "regex", "gt", "ge", "lt", "le") and g["key"] not in out:
            out.append(g["key"])
    return out
