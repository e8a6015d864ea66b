"""Rule matching (J1-J6): every event against every block of every active rule.

Physical forms with identical results:

* ``match_compiled`` - the rule set is known when the plan is built (batch
  runs, streams with a fixed rule set).  Each block condition is compiled
  into a Column; an event yields the array of blocks it matches, which is
  exploded.  No join at all: one codegen'd projection, and the OR of all
  conditions is a plain filter Catalyst pushes below the JSON/projection
  work (and to the parquet scan where the leaves are plain columns).
* ``match_dynamic`` - rules are data (rules that change while a stream runs,
  or rule sets too large to compile).  A guard index derived from the rules
  (``operators.guards``) turns the theta join into an equi-join on (field,
  value); the postfix program is evaluated with higher-order functions on
  the pairs that meet.  The index is counted before it is broadcast; larger
  ones are joined without a broadcast.

Output ("matched" frame), one row per (event, rule, block) match:
customer, rule_id, rule_version, base_severity, rule_type, rule_window_size,
rule_window_slide, block_index, block_type, window_size, window_slide,
threshold, unique_field, anomaly_threshold, group_by, agg_key, unique_value,
event_ms, arrival_seq, content.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.functions.conditions import compile_condition, eval_condition
from rulestream.operators.guards import guard_index, with_double_pairs, with_pairs
from rulestream.operators.rules import rule_blocks
from rulestream.session import ensure_checkpoint_dir

MATCHED_COLUMNS = [
    "customer", "rule_id", "rule_version", "base_severity", "rule_type", "rule_window_size",
    "rule_window_slide", "block_index", "block_type", "window_size", "window_slide", "threshold",
    "unique_field", "anomaly_threshold", "group_by", "agg_key", "unique_value", "event_ms",
    "arrival_seq", "content",
]

# Bounds that keep the rule side small enough to inline or broadcast.
MAX_COMPILED_BLOCKS = 2000
MAX_BROADCAST_BLOCKS = 20000
# Up to this many blocks the conditions are generated into one projection;
# beyond it generated code outgrows what the JVM compiles, and a collected
# rule set is matched through the guard index instead (``match_indexed``).
MAX_INLINE_BLOCKS = 32
# Up to this many guard fields are named in the plan, so that other fields make no pairs.
MAX_GUARD_FIELDS = 200
# Up to this many pairs of guard fields are met by both fields; an event makes a row for each whose values it has.
MAX_GUARD_PAIRS = 32
# Tasks over which one (field, value) pair is dealt where rules are not broadcast.
SALTS = 16


def _fv(fields: Column, key) -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return F.coalesce(fields[k], F.lit(""))


def _group_by(fields: Column, gbf) -> Column:
    """P6: 'field=value' key of the rule's group-by field (NULL without one)."""
    if isinstance(gbf, str) or gbf is None:
        if not gbf:
            return F.lit(None).cast("string")
        return F.concat(F.lit(gbf + "="), _fv(fields, gbf))
    return F.when(gbf.isNull() | (gbf == ""), F.lit(None).cast("string")) \
        .otherwise(F.concat(gbf, F.lit("="), _fv(fields, gbf)))


def _agg_key(fields: Column, agg_fields) -> Column:
    """P6: 'f1=v1,f2=v2' in declared order (NULL without aggregation fields)."""
    if agg_fields is None:
        return F.lit(None).cast("string")
    if isinstance(agg_fields, (list, tuple)):
        if not agg_fields:
            return F.lit("")
        return F.concat_ws(",", *[F.concat(F.lit(f"{f}="), _fv(fields, f)) for f in agg_fields])
    return F.array_join(F.transform(agg_fields, lambda f: F.concat(f, F.lit("="), _fv(fields, f))), ",")


def _group_ok(fields: Column, gbf) -> Column:
    """A rule with a group-by field needs a non-empty value for it."""
    if isinstance(gbf, str) or gbf is None:
        return F.lit(True) if not gbf else (_fv(fields, gbf) != F.lit(""))
    return gbf.isNull() | (gbf == "") | (_fv(fields, gbf) != F.lit(""))


def _validity(ev_ms: Column, r: dict) -> Column | None:
    preds = []
    if r.get("valid_from_ms") is not None:
        preds.append(ev_ms >= F.lit(int(r["valid_from_ms"])))
    if r.get("valid_to_ms") is not None:
        preds.append(ev_ms < F.lit(int(r["valid_to_ms"])))
    return reduce(lambda a, b: a & b, preds) if preds else None


def event_takes_part(block: dict) -> Column:
    """J2 and validity: whether an event is put to the block's condition at all."""
    ok = _group_ok(F.col("fields"), block["group_by_field"])
    valid = _validity(F.col("event_ms"), block)
    return ok if valid is None else ok & valid


def collect_rule_blocks(rules: DataFrame, limit: int = MAX_COMPILED_BLOCKS) -> list[dict] | None:
    """Bring the (small) rule side to the driver for compilation.

    Rules are configuration, but their count is still checked: None is
    returned when there are more than ``limit`` blocks, and callers then use
    the join form.
    """
    cols = ["rule_id", "rule_version", "base_severity", "group_by_field", "rule_window_size",
            "rule_window_slide", "n_blocks", "rule_type", "blocks"]
    extra = [c for c in ("valid_from_ms", "valid_to_ms") if c in rules.columns]
    rows = rules.select(*cols, *extra).limit(limit + 1).collect()
    blocks = []
    for r in rows:
        d = r.asDict(recursive=True)
        for b in d.pop("blocks") or []:
            blocks.append({**d, **b})
    if len(blocks) > limit:
        return None
    return blocks


def match_compiled(events: DataFrame, blocks: list[dict]) -> DataFrame:
    """J1-J4 with the rule set compiled into the plan."""
    fields = F.col("fields")
    ev_ms = F.col("event_ms")

    def field(k):
        return fields[F.lit(k)]

    entries, conds = [], []
    for b in blocks:
        cond = compile_condition(b["cond"] or [], field)
        cond = cond & _group_ok(fields, b["group_by_field"])
        v = _validity(ev_ms, b)
        if v is not None:
            cond = cond & v
        conds.append(cond)
        uf = b.get("unique_field")
        entries.append(F.array_repeat(F.struct(
            F.lit(b["rule_id"]).cast("string").alias("rule_id"),
            F.lit(b["rule_version"]).cast("int").alias("rule_version"),
            F.lit(b["base_severity"]).cast("int").alias("base_severity"),
            F.lit(b["rule_type"]).cast("string").alias("rule_type"),
            F.lit(b["rule_window_size"]).cast("bigint").alias("rule_window_size"),
            F.lit(b["rule_window_slide"]).cast("bigint").alias("rule_window_slide"),
            F.lit(b["block_index"]).cast("int").alias("block_index"),
            F.lit(b["block_type"]).cast("string").alias("block_type"),
            F.lit(b["window_size"]).cast("bigint").alias("window_size"),
            F.lit(b["window_slide"]).cast("bigint").alias("window_slide"),
            F.lit(b["threshold"]).cast("int").alias("threshold"),
            F.lit(uf).cast("string").alias("unique_field"),
            F.lit(b["anomaly_threshold"]).cast("int").alias("anomaly_threshold"),
            _group_by(fields, b["group_by_field"]).alias("group_by"),
            _agg_key(fields, b["agg_fields"]).alias("agg_key"),
            (_fv(fields, uf) if uf else F.lit(None).cast("string")).alias("unique_value"),
        ), F.when(cond, F.lit(1)).otherwise(F.lit(0))))
    if not entries:
        return events.sparkSession.createDataFrame([], _matched_schema(events))
    any_match = reduce(lambda a, c: a | c, conds)
    keep = ["customer", "event_ms", "arrival_seq", "content"] + _passthrough(events)
    # one 0/1-element array per block, concatenated: plain expressions that
    # stay inside whole-stage codegen (no lambda over the array)
    matches = F.flatten(F.array(*entries))
    if events.isStreaming:
        # On a stream every event must reach the watermark: non-matching
        # events still advance event time.  Any filter here would be pushed
        # below the watermark node, so explode_outer keeps all rows and the
        # non-matches are dropped above the generator.
        m = (events.select(*keep, matches.alias("ms"))
             .select(*keep, F.explode_outer("ms").alias("m")).where(F.col("m").isNotNull()))
    else:
        # The matches array is built in a projection (not inside the
        # generator) so Catalyst folds fields[...] lookups into the source
        # columns and the scan reads only the columns the rules touch; the
        # OR of all conditions filters first and reaches the parquet scan.
        m = (events.where(any_match).select(*keep, matches.alias("ms"))
             .select(*keep, F.explode("ms").alias("m")))
    return m.select("m.*", *keep).select(*MATCHED_COLUMNS, *_passthrough(events))


def _passthrough(events: DataFrame) -> list[str]:
    """Columns carried through matching (the event-time column of a stream
    keeps its watermark)."""
    return [c for c in ("event_ts",) if c in events.columns]


def _matched_schema(events: DataFrame) -> str:
    return ("customer string, rule_id string, rule_version int, base_severity int, rule_type string, "
            "rule_window_size bigint, rule_window_slide bigint, block_index int, block_type string, "
            "window_size bigint, window_slide bigint, threshold int, unique_field string, "
            "anomaly_threshold int, group_by string, agg_key string, unique_value string, "
            "event_ms bigint, arrival_seq bigint, content string")


def match_joined(events: DataFrame, rules: DataFrame) -> DataFrame:
    """J1-J4 with rules as data (see ``match_dynamic``)."""
    return match_dynamic(events, GuardIndex(rule_blocks(rules)))


class GuardIndex:
    """A rule side's guard index, written once (configuration, shared checkpoint folder) and counted."""

    def __init__(self, rb: DataFrame):
        ensure_checkpoint_dir(rb.sparkSession)
        self.frame = guard_index(rb, second=True).checkpoint(eager=True)
        counts = self.frame.groupBy("gk", "hk").agg(F.count("*").alias("n"))
        # the guard fields in use are named in the plan unless they are too many
        total = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("gk") == "", F.col("n"))).alias("free")).first()
        self.n_free = total["free"] or 0
        self.n_guarded = (total["n"] or 0) - self.n_free
        fields = self._few(counts, MAX_GUARD_PAIRS, "gk", "hk")
        self.fields = fields and [(r["gk"], r["hk"]) for r in fields]
        keys = fields if fields is not None else self._few(counts, MAX_GUARD_FIELDS, "gk")
        self.keys = keys if keys is None else sorted({r["gk"] for r in keys})

    @staticmethod
    def _few(counts: DataFrame, most: int, *cols: str) -> list | None:
        rows = counts.where(F.col("gk") != "").select(*cols).distinct().limit(most + 1).collect()
        return sorted(rows) if len(rows) <= most else None

    def met_by(self, events: DataFrame, free: bool) -> DataFrame:
        """Events by the guards in use: by two fields, or by one where the pairs of fields are too many to name."""
        return with_pairs(events, free, self.keys) if self.fields is None else with_double_pairs(events, free, self.fields)


def match_dynamic(events: DataFrame, index: GuardIndex, limit: int = MAX_BROADCAST_BLOCKS) -> DataFrame:
    """J1-J4 with a rule side of any size, through a guard index made as data.

    Up to ``limit`` index rows are broadcast and one hash join on (field,
    value) meets every block.  Beyond that nothing of unknown size is
    broadcast: guarded blocks meet the events in an equi-join that AQE plans
    from measured sizes (splitting skewed pairs), and blocks without a guard,
    which meet every event, are broadcast in counted chunks of at most
    ``limit`` rows.
    """
    n_free, n_guarded, idx = index.n_free, index.n_guarded, index.frame
    if n_free + n_guarded <= limit:
        return _join_chunk(index.met_by(events, n_free > 0), idx, guard=True, double=index.fields is not None)
    parts = []
    if n_guarded:
        parts.append(_join_chunk(index.met_by(events, False), idx.where(F.col("gk") != ""),
                                 guard=True, small=n_guarded <= limit, double=index.fields is not None))
    n_chunks = -(-n_free // limit)
    for c in range(n_chunks):
        part = idx.where((F.col("gk") == "") & (F.pmod(F.xxhash64("rule_id", "block_index"), F.lit(n_chunks)) == c))
        parts.append(_join_chunk(with_pairs(events, True, []), part, guard=True))
    return reduce(lambda x, y: x.unionByName(y), parts)


def match_streamed(events: DataFrame, index: DataFrame, broadcast: bool = True) -> DataFrame:
    """J1-J4 for a stream whose rules change: ``index`` is a guard index re-read at every micro-batch.

    One stream-static join on (field, value).  Whoever writes the index checks
    its rows against the broadcast bound.  Without ``broadcast`` both sides are
    shuffled, for rule sets of any size: a pair that many events carry is dealt
    over ``SALTS`` tasks, and the index, which is configuration, once to each.
    """
    pairs = with_pairs(events)
    if broadcast:
        return _join_chunk(pairs, index, guard=True)
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("content", "arrival_seq"), F.lit(SALTS)))
    salts = index.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    return _join_chunk(pairs, salts.hint("merge"), guard=True, small=False)


def _guards(program) -> list[tuple[str, frozenset]]:
    """Necessary equalities of a condition program: alternatives
    ``(field, values)`` such that the condition can only be true when the
    field's text is one of the values.  AND keeps every child's
    alternatives; OR keeps a field all children constrain, with the union
    of their values; other leaves give none."""
    stack: list[list[tuple[str, frozenset]]] = []
    for ins in program:
        g = ins.asDict() if hasattr(ins, "asDict") else dict(ins)
        op = g["op"]
        if op == "eq" and g.get("key"):
            v = g.get("val")
            stack.append([(g["key"], frozenset() if v is None else frozenset([v]))])
        elif op in ("and", "or"):
            n = int(g.get("n") or 0)
            kids = stack[len(stack) - n:] if n else []
            del stack[len(stack) - n:]
            if op == "and":
                stack.append([a for k in kids for a in k])
            elif kids:
                common = set.intersection(*[{a[0] for a in k} for k in kids])
                stack.append([(key, frozenset().union(*[min((a[1] for a in k if a[0] == key), key=len)
                                                         for k in kids])) for key in sorted(common)])
            else:
                stack.append([])
        else:
            stack.append([])
    return stack[-1] if stack else []


def match_indexed(events: DataFrame, rules: DataFrame, blocks: list[dict]) -> DataFrame:
    """J1-J4 for a collected rule set of any size, through a guard index.

    Each block gets one necessary equality ``field in values`` from its
    condition (the field with the most distinct guard values in the rule set
    wins: it splits the rules finest).  Events are exploded over the few
    guard fields and equi-joined with the broadcast (field, value) -> block
    index, so an event meets only the blocks its values can satisfy; the
    full condition is evaluated on those candidate pairs.  Blocks without a
    guard go through the nested-loop broadcast join.  The index holds one
    row per (block, guard value): configuration, checked before broadcast.
    """
    alts = [_guards(b.get("cond") or []) for b in blocks]
    values = defaultdict(set)
    for al in alts:
        for k, vs in al:
            values[k] |= vs
    rb = rule_blocks(rules).withColumn("block_no", F.lit(None).cast("int"))
    spark = events.sparkSession
    rows, free, index = [], [], []
    for i, (b, al) in enumerate(zip(blocks, alts)):
        rows.append({**{c: b.get(c) for c in rb.columns}, "block_no": i})
        if al:
            k, vs = max(al, key=lambda a: (len(values[a[0]]), -len(a[1])))
            index.extend((i, k, v) for v in sorted(vs))
        else:
            free.append(i)
    if len(index) > MAX_BROADCAST_BLOCKS:
        return match_joined(events, rules)
    side = spark.createDataFrame(rows, rb.schema)
    parts = []
    if index:
        idx = spark.createDataFrame(index, "block_no int, gk string, gv string")
        keys = sorted({k for _, k, _ in index})
        ev = events.select("*", F.explode(F.array(*[
            F.struct(F.lit(k).alias("gk"), _fv(F.col("fields"), k).alias("gv")) for k in keys])).alias("g"))
        parts.append(_join_chunk(ev, idx.join(side, "block_no"), guard=True))
    if free:
        parts.append(_join_chunk(events, side.where(F.col("block_no").isin(free))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _join_chunk(events: DataFrame, rb: DataFrame, guard: bool = False, small: bool = True, double: bool = False) -> DataFrame:
    """``small``: the rule side's rows were counted and may be broadcast; ``double``: guards are pairs of fields."""
    e = events.alias("e")
    r = (F.broadcast(rb) if small else rb).alias("r")
    fields = F.col("e.fields")
    cond = eval_condition(F.col("r.cond"), lambda k: _fv(fields, k))
    if guard:
        pair = (F.col("e.g.gk") == F.col("r.gk")) & (F.col("e.g.gv") == F.col("r.gv"))
        if double:
            pair = pair & (F.col("e.g.hk") == F.col("r.hk")) & (F.col("e.g.hv") == F.col("r.hv"))
        cond = pair & (F.col("e.salt") == F.col("r.salt")) & cond if "salt" in rb.columns else pair & cond
    cond = cond & _group_ok(fields, F.col("r.group_by_field"))
    if "valid_from_ms" in rb.columns:
        cond = cond & (F.col("r.valid_from_ms").isNull() | (F.col("e.event_ms") >= F.col("r.valid_from_ms")))
        cond = cond & (F.col("r.valid_to_ms").isNull() | (F.col("e.event_ms") < F.col("r.valid_to_ms")))
    j = e.join(r, cond, "inner")
    uf = F.col("r.unique_field")
    return j.select(
        F.col("e.customer").alias("customer"), "r.rule_id", "r.rule_version", "r.base_severity",
        "r.rule_type", "r.rule_window_size", "r.rule_window_slide", "r.block_index", "r.block_type",
        "r.window_size", "r.window_slide", "r.threshold", "r.unique_field", "r.anomaly_threshold",
        _group_by(fields, F.col("r.group_by_field")).alias("group_by"),
        F.when(F.col("r.agg_fields").isNull(), F.lit(None).cast("string"))
         .otherwise(_agg_key(fields, F.col("r.agg_fields"))).alias("agg_key"),
        F.when(uf.isNull(), F.lit(None).cast("string")).otherwise(_fv(fields, uf)).alias("unique_value"),
        F.col("e.event_ms").alias("event_ms"), F.col("e.arrival_seq").alias("arrival_seq"),
        F.col("e.content").alias("content"), *[F.col(f"e.{c}") for c in _passthrough(events)],
        *(["r.program"] if "program" in rb.columns else []))


def match(events: DataFrame, rules: DataFrame, mode: str = "auto") -> DataFrame:
    """Match events against rules; ``mode`` = auto | compiled | joined.  Rule sets too large to compile are joined."""
    if mode in ("auto", "compiled"):
        blocks = collect_rule_blocks(rules)
        if blocks is not None:
            if len(blocks) > MAX_INLINE_BLOCKS and mode == "auto" and not events.isStreaming:
                return match_indexed(events, rules, blocks)
            return match_compiled(events, blocks)
    return match_joined(events, rules)
