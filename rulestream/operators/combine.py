"""Rule combination (R1-R7): block results of multi-block rules -> rule windows.

Key (customer, rule, group); each block result is assigned to the sliding
rule windows (rule size / slide) that contain its emit time; a window whose
block results satisfy the rule condition produces one alert.

Nothing here gathers a whole window into one row.  Per (window, block
index) only the last output and the first / last position survive (the
alert keeps one output per index), so a window row holds one entry per
block index of the rule - a bound set by the rule, not by the data.

Sequences (R7) walk their entries greedily over the window's block results
in time order.  Most steps only need the per-index span:

* a first wanted entry lands on the earliest result of its index;
* the last entry only has to exist at or after the current position (the
  latest result of its index decides);
* a ``notPresent`` entry is the same existence test, negated.

These are evaluated in one projection over the window row.  Only a middle
entry of a sequence of three or more, whose index has results both before
and after the current position, needs the exact next position: those
(window, sequence) pairs, and only those, go through an as-of step - an
equi-join on (window, block index) with a range condition, then a ``min``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulestream.functions.conditions import eval_rule_condition
from rulestream.functions.frames import join_ns
from rulestream.functions.windows import next_start, pane_ms, sec_to_ms, sliding_starts, start_bounds, tumbling_start
from rulestream.session import ensure_checkpoint_dir

GKEY = ["customer", "rule_id", "group_by", "rws", "rwe"]

ORD_T = "struct<match_ms:bigint,emit_ms:bigint,windowed:int,order_tb:bigint,block_index:int>"
SUMMARIES_T = "array<struct<key:string,sample:string,count:bigint>>"


def order_col() -> Column:
    """Order of block results inside a rule window: match time, emit time, arrival
    (a window's result arrives after the events of its last instant), block index."""
    windowed = (F.col("block_type") != "SINGLE_EVENT").cast("int")
    return F.struct("match_ms", "emit_ms", windowed.alias("windowed"), "order_tb", "block_index")


def rule_windows(blocks: DataFrame) -> DataFrame:
    """Assign complex block results to the rule's sliding windows."""
    c = blocks.where(F.col("rule_type") == "COMPLEX")
    size, slide = sec_to_ms("rule_window_size"), sec_to_ms("rule_window_slide")
    c = c.where((size > 0) & (slide > 0))
    c = c.select("*", F.explode(sliding_starts(F.col("emit_ms"), size, slide)).alias("rws"))
    return c.withColumn("rwe", F.col("rws") + size).withColumn("ord", order_col().cast(ORD_T))


def _outputs(w: DataFrame) -> DataFrame:
    """O2 pieces per window: header from the first block, last output per
    index, max match time, indices seen, and each index's (first, last)
    position for the sequence walk."""
    out = F.struct("match_ms", "match_message", F.coalesce(
        "matching_events", F.array().cast(SUMMARIES_T)).alias("matching_events"))
    per_idx = w.groupBy(*GKEY, "block_index").agg(
        F.max_by(out, "ord").alias("out"),
        F.min_by(F.struct("rule_version", "base_severity"), "ord").alias("head"),
        F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"),
        F.max("match_ms").alias("match_ms"))
    return per_idx.groupBy(*GKEY).agg(
        F.min_by("head", "first_ord").alias("head"),
        F.max("match_ms").alias("match_ms"),
        F.sort_array(F.collect_list("block_index")).alias("seen"),
        F.map_from_entries(F.collect_list(F.struct(F.col("block_index").cast("string"), "out"))).alias("outputs"),
        F.map_from_entries(F.collect_list(F.struct(
            "block_index", F.struct(F.col("first_ord").alias("lo"), F.col("last_ord").alias("hi"))))).alias("span"))


# Above this many sliding windows per block result, results are folded into panes before windows.
PANE_LIMIT_FAN = 4
RKEY = ["customer", "rule_id", "group_by", "size", "slide"]
PKEY = RKEY + ["block_index"]


def _pane_outputs(blocks: DataFrame) -> DataFrame:
    """Block results folded per (pane, block index): the last output, and what a window needs of the others.

    Panes tile rule windows exactly, so a window's last output of an index is
    the last one of its panes' last outputs.
    """
    size, slide = sec_to_ms("rule_window_size"), sec_to_ms("rule_window_slide")
    c = blocks.where((F.col("rule_type") == "COMPLEX") & (size > 0) & (slide > 0))
    c = c.withColumn("size", size).withColumn("slide", slide).withColumn("ord", order_col().cast(ORD_T))
    c = c.withColumn("pane", tumbling_start(F.col("emit_ms"), pane_ms(F.col("size"), F.col("slide"))))
    out = F.struct("match_ms", "match_message", F.coalesce(
        "matching_events", F.array().cast(SUMMARIES_T)).alias("matching_events"))
    return c.groupBy(*PKEY, "pane").agg(
        F.max_by(out, "ord").alias("out"), F.min_by(F.struct("rule_version", "base_severity"), "ord").alias("head"),
        F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"), F.max("match_ms").alias("match_ms"))


def _runs(panes: DataFrame) -> DataFrame:
    """Runs of windows that hold the same panes: first and last start, and the chunk they start in.

    Along the starts of a group the panes in a window change only where one
    enters and where one leaves.  Runs end at chunks (multiples of the size)
    too, so a chunk's runs are found without the rest of its group.
    """
    first, last = start_bounds(F.col("pane"), F.col("size"), F.col("slide"))
    e = panes.select(*RKEY, first.alias("first"), last.alias("last")).where(F.col("last").isNotNull())
    cut = next_start(tumbling_start(F.col("last"), F.col("size")), F.col("slide"))
    e = e.select(*RKEY, F.explode(F.array("first", F.greatest("first", F.least(cut, "last")), F.col("last") + F.col("slide"))).alias("rws"))
    e = e.withColumn("chunk", tumbling_start(F.col("rws"), F.col("size"))).repartition(*RKEY, "chunk").distinct()
    following = F.lead("rws").over(Window.partitionBy(*RKEY, "chunk").orderBy("rws"))
    ends = F.coalesce(following, next_start(F.col("chunk") + F.col("size"), F.col("slide")))
    return e.withColumn("last_rws", ends - F.col("slide"))


def _run_rows(panes: DataFrame) -> DataFrame:
    """What a run of windows holds per block index, as one or two rows.

    A window reaches from its start to the end of its chunk, and from there
    into the next chunk up to its own end.  Running values over a chunk's
    panes, from its end back and from its start on, give both parts, so no
    pane is copied into the windows that hold it.
    """
    runs = _runs(panes)
    end = F.col("rws") + F.col("size")
    asked = runs.select(*RKEY, "rws", "last_rws", F.explode(F.array(
        F.struct("chunk", F.col("rws").alias("at"), F.lit("from").alias("part")),
        F.struct((F.col("chunk") + F.col("size")).alias("chunk"), end.alias("at"), F.lit("upto").alias("part")))).alias("a"))
    asked = asked.select(*RKEY, "rws", "last_rws", "a.*")
    held = panes.select(*PKEY, tumbling_start(F.col("pane"), F.col("size")).alias("chunk"), F.col("pane").alias("at"),
                        F.struct("first_ord", "head").alias("first"), "last_ord", "match_ms")
    asked = join_ns(asked, held.select(*PKEY, "chunk").distinct(), RKEY + ["chunk"], "inner")
    rows = held.unionByName(asked, allowMissingColumns=True).withColumn("held", F.col("part").isNull())
    per = Window.partitionBy(*PKEY, "chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = per.orderBy(F.desc("at"), F.desc("held"))  # a pane that begins where the window does is inside
    on = per.orderBy("at", "held")  # one that begins where the window ends is not
    values = [F.when(F.col("part") == "from", agg.over(back)).otherwise(agg.over(on)).alias(name) for name, agg in (
        ("first", F.min("first")), ("last_ord", F.max("last_ord")), ("match_ms", F.max("match_ms")))]
    got = rows.select(*PKEY, "rws", "last_rws", "part", *values).where(F.col("part").isNotNull() & F.col("last_ord").isNotNull())
    return got.select(*PKEY, F.col("first.head").alias("head"), F.col("first.first_ord").alias("first_ord"), "last_ord", "match_ms",
                      "rws", "last_rws", F.col("slide").alias("step"))


def _pane_windows(panes: DataFrame) -> DataFrame:
    """Windows from panes, as ``_outputs`` but without the outputs: ``last`` names the place of each index's last one.

    A row stands for the windows that start at ``rws``, then every ``step`` up
    to ``last_rws``, and hold the same.  Where versions of a rule have one
    size but several slides their windows meet, and a row stands for one.
    """
    grids = panes.select("rule_id", "size", "slide").distinct().groupBy("rule_id", "size").agg(F.count("*").alias("n"))
    several = grids.where(F.col("n") > 1).select("rule_id", "size")
    if several.isEmpty():
        w = _run_rows(panes)
    else:
        met = join_ns(panes, several, ["rule_id", "size"], "left_semi")
        met = met.select(*PKEY, "head", "first_ord", "last_ord", "match_ms",
                         F.explode(sliding_starts(F.col("pane"), F.col("size"), F.col("slide"))).alias("rws"))
        met = met.select("*", F.col("rws").alias("last_rws"), F.lit(1).cast("bigint").alias("step"))
        w = _run_rows(join_ns(panes, several, ["rule_id", "size"], "left_anti")).unionByName(met)
    w = w.withColumn("rwe", F.col("rws") + F.col("size")).repartition("customer", "rule_id", "group_by", "rws")
    per_idx = w.groupBy(*GKEY, "last_rws", "step", "block_index").agg(
        F.min_by("head", "first_ord").alias("head"), F.min("first_ord").alias("first_ord"),
        F.max(F.struct("last_ord", "size", "slide")).alias("at"), F.max("match_ms").alias("match_ms"))
    return per_idx.groupBy(*GKEY, "last_rws", "step").agg(
        F.min_by("head", "first_ord").alias("head"), F.max("match_ms").alias("match_ms"),
        F.sort_array(F.collect_list("block_index")).alias("seen"),
        F.collect_list(F.struct("block_index", "at.*")).alias("last"),
        F.map_from_entries(F.collect_list(F.struct(
            "block_index", F.struct(F.col("first_ord").alias("lo"), F.col("at.last_ord").alias("hi"))))).alias("span"))


def _with_outputs(hit: DataFrame, panes: DataFrame) -> DataFrame:
    """The outputs of the windows that matched, fetched by their places; one row per window again."""
    facts = F.struct("head", "match_ms", "seen", "last_rws", "step")
    wanted = hit.select(*GKEY, facts.alias("facts"), F.explode("last").alias("l")).select(*GKEY, "facts", "l.*")
    got = join_ns(wanted, panes.select(*PKEY, "last_ord", "out"), PKEY + ["last_ord"], "inner")
    got = got.groupBy(*GKEY).agg(
        F.first("facts").alias("facts"),
        F.map_from_entries(F.collect_list(F.struct(F.col("block_index").cast("string"), "out"))).alias("outputs")).select(*GKEY, "facts.*", "outputs")
    starts = F.explode(F.sequence("rws", "last_rws", "step")).alias("start")
    return got.select("*", starts).withColumn("rwe", F.col("rwe") - F.col("rws") + F.col("start")).withColumn("rws", F.col("start"))


def _advance(pos: Column, ok: Column, want: Column, absent: Column, sp: Column, is_last: Column,
             found: Column | None = None) -> tuple[Column, Column, Column]:
    """One greedy sequence step on (position, ok).

    ``sp`` is the (lo, hi) position span of the wanted index in the window
    (NULL when absent), ``pos`` the position matched so far (NULL before the
    first positive entry; matches are inclusive of it).  Returns the new
    position, the new ok flag and ``need``: the step needs the exact next
    position of the index at or after ``pos``, which the span cannot give.
    ``found`` is that position when the caller has computed it.
    """
    lo, hi = sp["lo"], sp["hi"]
    at_or_after = F.coalesce(hi >= pos, F.lit(False))
    present = F.when(pos.isNull(), sp.isNotNull()).otherwise(at_or_after)
    need = (~absent & pos.isNotNull() & ~is_last
            & F.coalesce((lo < pos) & (hi >= pos), F.lit(False)))
    skip = ~ok | want.isNull()
    new_pos = (F.when(skip | absent, pos)
               .when(pos.isNull(), lo)
               .when(need, found if found is not None else pos)
               .when(~is_last & F.coalesce(lo >= pos, F.lit(False)), lo)
               .otherwise(pos))
    new_ok = (F.when(skip, ok)
              .when(absent, ~present)
              .when(pos.isNull(), lo.isNotNull())
              .otherwise(at_or_after))
    return new_pos, new_ok, (~skip & need)


def _seq_walk(x: Column, span: Column) -> Column:
    """Walk one sequence node over the window's spans: struct(pos, ok, pend),
    ``pend`` = first 1-based entry that needs an as-of step (else NULL)."""
    n = F.size(x["idx"])
    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    init = F.struct(F.lit(None).cast(ORD_T).alias("pos"), F.lit(True).alias("ok"),
                    F.lit(None).cast("int").alias("pend"))

    def step(st, j):
        want = F.try_element_at(x["idx"], j)
        absent = F.coalesce(F.try_element_at(x["neg"], j), F.lit(False))
        sp = F.try_element_at(span, want)
        pos, ok, need = _advance(st["pos"], st["ok"], want, absent, sp, j == n)
        moved = F.struct(pos.alias("pos"), ok.alias("ok"), F.when(need, j).alias("pend"))
        return F.when(st["pend"].isNotNull(), st).otherwise(moved)
    return F.aggregate(steps, init, step)


def _walk_all(g: DataFrame) -> DataFrame:
    """Attach ``walks``: one entry per sequence node of the rule program."""
    walks = F.filter(F.transform("rule_program", lambda x, i: F.when(
        x["op"] == "seq", F.struct(i.alias("node"), _seq_walk(x, F.col("span")).alias("w")))),
        lambda e: e.isNotNull())
    return g.withColumn("walks", walks)


def _resolved(walks: Column) -> Column:
    """node -> ok for sequence nodes the span walk decided."""
    done = F.filter(walks, lambda e: e["w"]["pend"].isNull())
    return F.map_from_entries(F.transform(done, lambda e: F.struct(e["node"], e["w"]["ok"])))


def _as_of_walks(w: DataFrame, g: DataFrame, max_len: int) -> DataFrame:
    """Finish the walks the span could not decide: (GKEY, map node -> ok).

    Only pending (window, node) pairs take part.  At step j each pending
    pair needing an exact position joins the window's block results with
    that index on (window, index), keeps those at or after its position and
    takes the ``min`` - distributed, with map-side partial aggregation.
    """
    pend = g.select(*GKEY, "span", "rule_program", F.explode(F.filter(
        "walks", lambda e: e["w"]["pend"].isNotNull())).alias("e"))
    x = F.element_at(F.col("rule_program"), F.col("e.node") + 1)
    state = pend.select(*GKEY, F.col("e.node").alias("node"), x["idx"].alias("idx"), x["neg"].alias("neg"),
                        "span", F.col("e.w.pos").alias("pos"), F.lit(True).alias("ok"),
                        F.col("e.w.pend").alias("start"))
    b = w.select(*GKEY, F.col("block_index").alias("bi"), "ord")
    keep = GKEY + ["node", "idx", "neg", "span", "start"]
    # entry j (1-based) can need an as-of step only when it has a positive
    # entry before it and an entry after it: 2 <= j <= max_len - 1
    for j in range(2, max_len + 1):
        want = F.try_element_at("idx", F.lit(j))
        cur = state.select(*keep, "pos", "ok", want.alias("want"),
                           F.coalesce(F.try_element_at("neg", F.lit(j)), F.lit(False)).alias("absent"),
                           (F.size("idx") == j).alias("is_last"))
        cur = cur.withColumn("sp", F.try_element_at("span", F.col("want")))
        in_range = F.col("start") <= F.lit(j)
        _, _, need = _advance(F.col("pos"), F.col("ok") & in_range, F.col("want"), F.col("absent"),
                              F.col("sp"), F.col("is_last"))
        if j < max_len:
            cur = cur.withColumn("need", need)
            active = cur.where("need").select(*GKEY, "node", "want", "pos")
            cand = join_ns(active, b, GKEY, "inner").where(
                (F.col("bi") == F.col("want")) & (F.col("ord") >= F.col("pos")))
            found = cand.groupBy(*GKEY, "node").agg(F.min("ord").alias("found"))
            cur = join_ns(cur, found, GKEY + ["node"], "left")
        else:
            cur = cur.withColumn("found", F.lit(None).cast(ORD_T))
        pos, ok, _ = _advance(F.col("pos"), F.col("ok") & in_range, F.col("want"), F.col("absent"),
                              F.col("sp"), F.col("is_last"), F.col("found"))
        state = cur.select(*keep, F.when(in_range, pos).otherwise(F.col("pos")).alias("pos"),
                           F.when(in_range, ok).otherwise(F.col("ok")).alias("ok"))
        # each step reads the previous state twice: keep it instead of
        # re-deriving the chain (the plan would double per step)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
    return state.groupBy(*GKEY).agg(
        F.map_from_entries(F.collect_list(F.struct("node", "ok"))).alias("seq_late"))


def combine(blocks: DataFrame, rules: DataFrame, max_seq_len: int, small_rules: bool = False,
            max_fan: int | None = None) -> DataFrame:
    """R1-R7 + O2: complex block results -> alert rows (rule windows that match).

    ``rules`` supplies the rule condition of the version carried by each
    window's first block; it is configuration, broadcast only where the
    caller has checked its size (``small_rules``), else joined by shuffle.  ``max_seq_len`` is the longest sequence condition
    in the rule set; as-of steps are planned only when it is three or more.
    ``max_fan``: the largest number of rule windows per block result (None:
    unknown); above ``PANE_LIMIT_FAN`` windows are made from panes, and only
    windows that match fetch their outputs.
    """
    as_of = max_seq_len >= 3
    by_panes = max_fan is None or max_fan > PANE_LIMIT_FAN
    w = rule_windows(blocks)
    if by_panes:
        w = w.select(*GKEY, "block_index", "ord")
    if as_of:
        # the rule-window frame feeds the summary and the as-of steps
        w = w.persist(StorageLevel.MEMORY_AND_DISK)
    if by_panes:
        ensure_checkpoint_dir(blocks.sparkSession)
        panes = _pane_outputs(blocks).checkpoint(eager=True)  # read for the windows, and again for the outputs
    g = _pane_windows(panes) if by_panes else _outputs(w)
    conds = rules.select("rule_id", "rule_version", "rule_program").dropDuplicates(["rule_id", "rule_version"])
    conds = F.broadcast(conds) if small_rules else conds
    g = g.join(conds, (g["rule_id"] == conds["rule_id"]) & (g["head"]["rule_version"] == conds["rule_version"]),
               "inner").drop(conds["rule_id"]).drop(conds["rule_version"])
    if max_seq_len > 0:
        g = _walk_all(g)
        seq_ok = _resolved(F.col("walks"))
        if as_of:
            g = g.persist(StorageLevel.MEMORY_AND_DISK)
            late = _as_of_walks(w, g, max_seq_len)
            g = join_ns(g, late, GKEY, "left")
            seq_ok = F.map_concat(seq_ok, F.coalesce("seq_late", F.create_map().cast("map<int,boolean>")))
    else:
        seq_ok = F.lit(None).cast("map<int,boolean>")
    hit = g.where(eval_rule_condition(F.col("rule_program"), F.col("seen"), seq_ok))
    if by_panes:
        hit = _with_outputs(hit, panes)
    return hit.select(
        "customer", "rule_id", F.col("head.rule_version").alias("rule_version"),
        F.col("head.base_severity").alias("base_severity"), "group_by", "match_ms",
        F.col("rws").alias("window_start_ms"), F.col("rwe").alias("window_end_ms"),
        "seen", "outputs")
