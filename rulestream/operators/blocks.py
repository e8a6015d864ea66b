"""Block operators (B1-B14), batch form.

Input: the "matched" frame of ``operators.match`` (one row per event x
block match).  Output: block results ("matched blocks"), one row per block
firing:

    customer, rule_id, rule_version, base_severity, rule_type,
    rule_window_size, rule_window_slide, block_index, block_type, group_by,
    match_ms, emit_ms, match_message, matching_events ARRAY<SUMMARY>,
    phase, window_start_ms, window_end_ms, event_count, order_tb

``emit_ms`` is the element time the result carries into the rule window
(window end - 1 ms for windowed blocks, the event time for single events);
``phase`` tells initial / final firings apart.

Scale notes.  Every windowed block keys on (customer, rule, group, block
index); a hot key must not land whole in one task:

* counts and summaries are hash aggregates with map-side partial
  aggregation, and events are first folded into slide-sized panes so the
  sliding-window explosion multiplies panes, not events;
* "first N events of a window" uses ``row_number() <= K`` with a literal K,
  which Spark turns into a per-partition group limit *before* the shuffle;
* anomaly / drop-to-zero frames run over per-sub-window counts, whose
  number per key is bounded by time span / window size, not by events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulestream.functions.frames import join_ns
from rulestream.functions.windows import pane_ms, sec_to_ms, sliding_starts, tumbling_start
from rulestream.schemas import (MSG_ANOMALY, MSG_DROP, MSG_SINGLE_EVENT, MSG_THRESHOLD, MSG_UNIQUE,
                                COMPARISON_WINDOW_COUNT)

KEY = ["customer", "rule_id", "group_by", "block_index"]

BLOCK_COLUMNS = [
    "customer", "rule_id", "rule_version", "base_severity", "rule_type", "rule_window_size",
    "rule_window_slide", "block_index", "block_type", "group_by", "match_ms", "emit_ms",
    "match_message", "matching_events", "phase", "window_start_ms", "window_end_ms", "event_count",
    "order_tb",
]

SUMMARY_T = "array<struct<key:string,sample:string,count:bigint>>"


def _meta() -> Column:
    """Per-event configuration a block result inherits from its sample event."""
    return F.struct("rule_version", "base_severity", "rule_type", "rule_window_size",
                    "rule_window_slide", "window_size", "threshold", "anomaly_threshold", "content")


def _arrival() -> Column:
    return F.struct("event_ms", "arrival_seq")


def _result(df: DataFrame, meta: Column, **cols) -> DataFrame:
    base = {
        "customer": F.col("customer"), "rule_id": F.col("rule_id"),
        "rule_version": meta["rule_version"], "base_severity": meta["base_severity"],
        "rule_type": meta["rule_type"], "rule_window_size": meta["rule_window_size"],
        "rule_window_slide": meta["rule_window_slide"], "block_index": F.col("block_index"),
        "group_by": F.col("group_by"),
    }
    base.update(cols)
    carried = [c for c in ("program",) if c in df.columns]
    return df.select(*[base[c].alias(c) for c in BLOCK_COLUMNS], *carried)


# ---------------------------------------------------------------------------
# B1 SINGLE_EVENT
# ---------------------------------------------------------------------------

def single_event(matched: DataFrame) -> DataFrame:
    m = matched.where(F.col("block_type") == "SINGLE_EVENT")
    return _result(
        m, _meta(), block_type=F.lit("SINGLE_EVENT"), match_ms=F.col("event_ms"),
        emit_ms=F.col("event_ms"), match_message=F.lit(MSG_SINGLE_EVENT),
        matching_events=F.array(F.struct(F.lit(None).cast("string").alias("key"),
                                          F.col("content").alias("sample"),
                                          F.lit(1).cast("bigint").alias("count"))),
        phase=F.lit("event"), window_start_ms=F.lit(None).cast("bigint"),
        window_end_ms=F.lit(None).cast("bigint"), event_count=F.lit(1).cast("bigint"),
        order_tb=F.col("arrival_seq"))


# ---------------------------------------------------------------------------
# B8/B9 summaries
# ---------------------------------------------------------------------------

def _near(keys: list[str]) -> Column:
    """A hash of ``keys``, put before them: rows are then sorted by one number instead of by several texts."""
    return F.xxhash64(*keys).alias("near")


def _panes_of_events(d: DataFrame, keys: list[str]) -> DataFrame:
    """Events folded per ``keys`` + agg_key: their number, the first one (arrival and configuration) and the latest time."""
    one = F.struct("event_ms", "arrival_seq", _meta().alias("meta"))
    return d.groupBy(_near([*keys, "agg_key"]), *keys, "agg_key").agg(
        F.count(F.lit(1)).alias("n"), F.min(one).alias("first"), F.max("event_ms").alias("latest")).drop("near")


def _firings(final: DataFrame, initial: DataFrame, block_type: str, message: Column) -> DataFrame:
    """B8+B9: both firings of each window that fired initially.

    ``final``: rows of WKEY + agg_key with the number of events, the first one
    and the latest time; ``initial``: of those events, the ones up to the
    firing one (WKEY, agg_key, n0, latest0), none for a window that did not
    fire, where they are not told by ``n0`` and ``latest0`` of ``final``.  A key that takes part in the initial firing has the same sample in
    both, since the initial events are the first of their window; so both
    firings are read from one list of summaries, and all rows of a window meet
    in one shuffle.  (A window of p panes shares each with p windows, so that
    its rows are as even over the tasks as the windows are.)
    """
    cols = [*WKEY, "agg_key", "n", "first", "latest", "n0", "latest0"]
    rows = final.select(*[c for c in cols if c in final.columns]).unionByName(initial, allowMissingColumns=True)
    rows = rows.select(_near(WKEY), *cols).repartition("near")
    per_key = rows.groupBy("near", *WKEY, "agg_key").agg(
        F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.min("first").alias("first"), F.max("latest").alias("latest"), F.max("latest0").alias("latest0"))
    per_win = per_key.groupBy("near", *WKEY).agg(
        F.sort_array(F.collect_list(F.struct(F.col("agg_key").alias("key"), F.col("first.meta").alias("meta"), "n", "n0"))).alias("s"),
        F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.max("latest").alias("latest"), F.max("latest0").alias("latest0"))
    fired = per_win.where(F.col("n0") > 0).withColumn("s0", F.filter("s", lambda x: x["n0"] > 0))

    def firing(phase, s, n, latest):
        summaries = F.transform(s, lambda x: F.struct(x["key"].alias("key"), x["meta"]["content"].alias("sample"), x[n].alias("count")))
        return F.struct(F.lit(phase).alias("phase"), F.col(n).alias("total"), F.col(latest).alias("latest"),
                        F.col(s)[0]["meta"].alias("meta"), summaries.alias("summaries"))
    both = F.array(firing("initial", "s0", "n0", "latest0"), firing("final", "s", "n", "latest"))
    out = fired.select(*WKEY, F.explode(both).alias("r")).select(*WKEY, "r.*")
    return _result(
        out, F.col("meta"), block_type=F.lit(block_type), match_ms=F.col("latest"),
        emit_ms=F.col("we") - 1, match_message=message, matching_events=F.col("summaries"),
        phase=F.col("phase"), window_start_ms=F.col("ws"), window_end_ms=F.col("we"),
        event_count=F.col("total"), order_tb=F.col("ws"))


def _pane_windows(df: DataFrame) -> DataFrame:
    """Fold events into panes per (key, agg_key), then assign panes to the
    sliding windows that contain them (pane-level explosion)."""
    return _to_windows(_panes_of_events(_with_panes(df), KEY + ["size_ms", "slide_ms", "pane"]))


def _exploded_events(df: DataFrame) -> DataFrame:
    size, slide = sec_to_ms("window_size"), sec_to_ms("window_slide")
    d = df.withColumn("size_ms", size).withColumn("slide_ms", slide)
    d = d.select("*", F.explode(sliding_starts(F.col("event_ms"), F.col("size_ms"), F.col("slide_ms"))).alias("ws"))
    return d.withColumn("we", F.col("ws") + F.col("size_ms"))


WKEY = KEY + ["ws", "we"]


def _threshold_msg() -> Column:
    return F.format_string(MSG_THRESHOLD, F.col("total"),
                           (F.col("meta")["rule_window_size"] / 60).cast("int"))


# ---------------------------------------------------------------------------
# B2-B4 THRESHOLD
# ---------------------------------------------------------------------------

# Above this many sliding windows per event, first-N selection is done per
# pane before the explosion (one more shuffle, of at most N rows per pane).
PANE_LIMIT_FAN = 4


def _pane_heads(t: DataFrame, k: int) -> DataFrame:
    """Each pane's first ``k`` events, assigned to the sliding windows that
    contain the pane.  Panes tile windows exactly, so a window's first k
    events are among its panes' first k: the explosion multiplies at most k
    rows per pane instead of every event."""
    size, slide = sec_to_ms("window_size"), sec_to_ms("window_slide")
    d = t.withColumn("size_ms", size).withColumn("slide_ms", slide)
    d = d.withColumn("pane", tumbling_start(F.col("event_ms"), pane_ms(F.col("size_ms"), F.col("slide_ms"))))
    prn = F.row_number().over(Window.partitionBy(*KEY, "size_ms", "slide_ms", "pane")
                              .orderBy("event_ms", "arrival_seq"))
    heads = d.withColumn("prn", prn).where(F.col("prn") <= F.lit(k)).drop("prn")
    w = heads.select("*", F.explode(sliding_starts(F.col("pane"), F.col("size_ms"), F.col("slide_ms"))).alias("ws"))
    return w.withColumn("we", F.col("ws") + F.col("size_ms"))


# row_number() <= K is limited before the shuffle up to this K; a larger
# THRESHOLD finds its Nth event by counts instead.
HEAD_LIMIT = 1000
# Time buckets that a pane's events are counted in to find the Nth.
BUCKETS = 64


def threshold(matched: DataFrame, max_threshold: int, max_fan: int | None = None) -> DataFrame:
    """Initial firing when the running count of a window reaches THRESHOLD
    (content: the first N events in arrival order) and a final firing at
    window end with every event of the window.  ``max_threshold`` is the
    largest THRESHOLD of the rule set (a plan literal for the group limit);
    ``max_fan`` the largest number of sliding windows per event (None:
    unknown, treated as large).  Blocks with a THRESHOLD above ``HEAD_LIMIT``
    are fired by counts, without touching the limit of the others."""
    t = matched.where((F.col("block_type") == "THRESHOLD") & (F.col("threshold") > 0))
    k = int(max(1, max_threshold))
    if k > HEAD_LIMIT:
        few = threshold(t.where(F.col("threshold") <= HEAD_LIMIT), HEAD_LIMIT, max_fan)
        return few.unionByName(_threshold_by_counts(t.where(F.col("threshold") > HEAD_LIMIT)))
    # the first N are found on the columns that decide; the event text goes with the panes alone
    slim = t.select(*KEY, "agg_key", "window_size", "window_slide", "threshold", "event_ms", "arrival_seq")
    ev = _exploded_events(slim) if max_fan is not None and max_fan <= PANE_LIMIT_FAN else _pane_heads(slim, k)
    ev = ev.select(_near(WKEY), *WKEY, "agg_key", "threshold", "event_ms", "arrival_seq")
    win = Window.partitionBy("near", *WKEY)
    top = ev.withColumn("rn", F.row_number().over(win.orderBy("event_ms", "arrival_seq"))).where(F.col("rn") <= F.lit(k))
    fire_rn = F.min(F.when(F.col("rn") == F.col("threshold"), F.col("rn"))).over(win)
    first_n = top.withColumn("fire_rn", fire_rn).where(F.col("rn") <= F.col("fire_rn"))
    initial = first_n.select(*WKEY, "agg_key", F.lit(1).cast("bigint").alias("n0"), F.col("event_ms").alias("latest0"))
    return _firings(_pane_windows(t), initial, "THRESHOLD", _threshold_msg())


def _with_panes(df: DataFrame) -> DataFrame:
    """Window sizes in ms, and the pane that holds each event."""
    d = df.withColumn("size_ms", sec_to_ms("window_size")).withColumn("slide_ms", sec_to_ms("window_slide"))
    d = d.withColumn("width", pane_ms(F.col("size_ms"), F.col("slide_ms")))
    return d.withColumn("pane", tumbling_start(F.col("event_ms"), F.col("width")))


def _to_windows(panes: DataFrame) -> DataFrame:
    """Rows of panes -> rows of the sliding windows that contain the pane."""
    w = panes.select("*", F.explode(sliding_starts(F.col("pane"), F.col("size_ms"), F.col("slide_ms"))).alias("ws"))
    return w.withColumn("we", F.col("ws") + F.col("size_ms"))


def _fired(panes_in_windows: DataFrame, fire: DataFrame, events: DataFrame, block_type: str, message: Column) -> DataFrame:
    """Both firings of windows whose place of firing is known.

    ``fire``: per window, the pane it fired in (``fire_pane``) and the arrival
    (``fire_at``) of the event that fired it.  The initial content is the
    summaries of the panes before that one, and its own events up to the
    firing one, read once per distinct place of firing; every other event is
    met only as part of its pane.
    """
    points = fire.select(*KEY, "size_ms", "slide_ms", F.col("fire_pane").alias("pane"), "fire_at").distinct()
    pane_key = KEY + ["size_ms", "slide_ms", "pane"]
    part = join_ns(events, points, pane_key, "inner").where(_arrival() <= F.col("fire_at"))
    part = part.groupBy(*pane_key, "fire_at", "agg_key").agg(F.count(F.lit(1)).alias("n0"), F.max("event_ms").alias("latest0"))
    at = join_ns(fire.select(*WKEY, "size_ms", "slide_ms", F.col("fire_pane").alias("pane"), "fire_at"), part,
                 pane_key + ["fire_at"], "inner")
    inside = join_ns(panes_in_windows, fire.select(*WKEY, "fire_pane"), WKEY, "inner")
    before = F.col("pane") < F.col("fire_pane")
    inside = inside.withColumn("n0", F.when(before, F.col("n"))).withColumn("latest0", F.when(before, F.col("latest")))
    return _firings(inside, at.select(*WKEY, "agg_key", "n0", "latest0"), block_type, message)


def _threshold_by_counts(t: DataFrame) -> DataFrame:
    """THRESHOLD firing for any N: counts lead to the Nth event.

    Events are counted per pane and time bucket (map-side first); running
    counts of a window name the pane, then the bucket, in which the Nth event
    falls.  Only that bucket's events are ranked, so a key that holds a third
    of all events is never sorted, or shipped, whole.
    """
    d = _with_panes(t)
    d = d.withColumn("bucket", F.floor((F.col("event_ms") - F.col("pane")) * BUCKETS / F.col("width")).cast("int"))
    pane_key = KEY + ["size_ms", "slide_ms", "pane"]
    counts = d.groupBy(*pane_key, "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("threshold").alias("threshold"))
    per_pane = counts.groupBy(*pane_key).agg(F.sum("n").alias("n"), F.max("threshold").alias("threshold"))
    w = Window.partitionBy(*WKEY).orderBy("pane")
    run = _to_windows(per_pane).withColumn("upto", F.sum("n").over(w))
    hit = run.where((F.col("upto") >= F.col("threshold")) & (F.col("upto") - F.col("n") < F.col("threshold")))
    hit = hit.select(*WKEY, "size_ms", "slide_ms", "pane", (F.col("threshold") - F.col("upto") + F.col("n")).alias("need"))
    wanted = hit.select(*pane_key, "need").distinct()
    b = Window.partitionBy(*pane_key, "need").orderBy("bucket")
    in_pane = join_ns(counts.drop("threshold"), wanted, pane_key, "inner").withColumn("upto", F.sum("n").over(b))
    in_pane = in_pane.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    place = in_pane.select(*pane_key, "bucket", "need", (F.col("need") - F.col("upto") + F.col("n")).alias("nth"))
    slim = d.select(*pane_key, "bucket", "event_ms", "arrival_seq")
    ranked = join_ns(slim, place.select(*pane_key, "bucket").distinct(), pane_key + ["bucket"], "left_semi").withColumn(
        "rn", F.row_number().over(Window.partitionBy(*pane_key, "bucket").orderBy("event_ms", "arrival_seq")))
    nth = ranked.withColumnRenamed("rn", "nth").withColumn("fire_at", _arrival()).drop("event_ms", "arrival_seq")
    points = join_ns(place, nth, pane_key + ["bucket", "nth"], "inner").select(*pane_key, "need", "fire_at")
    fire = join_ns(hit, points, pane_key + ["need"], "inner").withColumnRenamed("pane", "fire_pane")
    return _fired(_pane_windows(t), fire, d, "THRESHOLD", _threshold_msg())


# ---------------------------------------------------------------------------
# B5-B7 UNIQUE_THRESHOLD
# ---------------------------------------------------------------------------

def unique_threshold(matched: DataFrame, max_threshold: int) -> DataFrame:
    """Initial firing when the number of distinct UNIQUE_FIELD values of a
    window first reaches THRESHOLD (content: all events up to that one),
    final firing at window end.  Events without the field are ignored.

    Panes are the unit: a pane keeps the first arrival of each of its first
    K values.  A window's first N <= K values are among those of its panes
    (a value that is new to the window is new to its pane, and the values
    before it in the pane are before it in the window), so windows are fired
    from pane rows, and no event is exploded into windows.
    """
    u = matched.where((F.col("block_type") == "UNIQUE_THRESHOLD") & (F.col("threshold") > 0)
                      & (F.col("unique_value") != ""))
    k = int(max(1, max_threshold))
    d = _with_panes(u)
    pane_key = KEY + ["size_ms", "slide_ms", "pane"]
    values = d.groupBy(*pane_key, "unique_value").agg(F.min(_arrival()).alias("first_at"), F.max("threshold").alias("threshold"))
    if k <= HEAD_LIMIT:
        vn = F.row_number().over(Window.partitionBy(*pane_key).orderBy("first_at"))
        values = values.withColumn("vn", vn).where(F.col("vn") <= F.lit(k)).drop("vn")
    firsts = _to_windows(values).groupBy(*WKEY, "size_ms", "slide_ms", "unique_value").agg(
        F.min(F.struct("first_at", "pane")).alias("at"), F.max("threshold").alias("threshold"))
    rn = F.row_number().over(Window.partitionBy(*WKEY, "size_ms", "slide_ms").orderBy("at"))
    fire = firsts.withColumn("rn", rn).where((F.col("rn") <= F.lit(k)) & (F.col("rn") == F.col("threshold")))
    fire = fire.select(*WKEY, "size_ms", "slide_ms", F.col("at.pane").alias("fire_pane"), F.col("at.first_at").alias("fire_at"))
    return _fired(_pane_windows(u), fire, d, "UNIQUE_THRESHOLD", F.lit(MSG_UNIQUE))


# ---------------------------------------------------------------------------
# B10-B12 count windows, SIMPLE_ANOMALY, DROP_TO_ZERO
# ---------------------------------------------------------------------------

def window_counts(matched: DataFrame, block_type: str) -> DataFrame:
    """Count per (key, tumbling sub-window); the sample is the last event."""
    m = matched.where((F.col("block_type") == block_type) & (F.col("window_size") > 0))
    m = m.withColumn("size_ms", sec_to_ms("window_size"))
    m = m.withColumn("p", tumbling_start(F.col("event_ms"), F.col("size_ms")))
    return m.groupBy(*KEY, "size_ms", "p").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(_meta(), _arrival()).alias("meta")
    ).withColumn("o", (F.col("p") / F.col("size_ms")).cast("bigint"))


def simple_anomaly(matched: DataFrame) -> DataFrame:
    """The latest sub-window count against the average of the previous
    nine (integer division by nine, even with one missing)."""
    c = window_counts(matched, "SIMPLE_ANOMALY")
    frame = Window.partitionBy(*KEY, "size_ms").orderBy("o").rangeBetween(-(COMPARISON_WINDOW_COUNT - 1), 0)
    c = (c.withColumn("k", F.count(F.lit(1)).over(frame))
          .withColumn("prev", F.sum("n").over(frame) - F.col("n"))
          .withColumn("meta", F.first("meta").over(frame)))
    avg = F.floor(F.col("prev") / F.lit(COMPARISON_WINDOW_COUNT - 1)).cast("bigint")
    hit = c.where((F.col("k") >= COMPARISON_WINDOW_COUNT - 1)
                  & (F.col("n") >= avg * F.col("meta")["anomaly_threshold"])).withColumn("avg", avg)
    end = F.col("p") + F.col("size_ms")
    msg = F.format_string(MSG_ANOMALY, F.col("n"), (F.col("meta")["window_size"] / 60).cast("int"), F.col("avg"))
    return _result(hit, F.col("meta"), block_type=F.lit("SIMPLE_ANOMALY"), match_ms=end, emit_ms=end - 1,
                   match_message=msg, matching_events=F.lit(None).cast(SUMMARY_T), phase=F.lit("close"),
                   window_start_ms=end - F.col("size_ms") * COMPARISON_WINDOW_COUNT, window_end_ms=end,
                   event_count=F.col("n"), order_tb=F.col("p"))


def drop_to_zero(matched: DataFrame) -> DataFrame:
    """Nine consecutive busy sub-windows followed by an empty one."""
    c = window_counts(matched, "DROP_TO_ZERO")
    frame = Window.partitionBy(*KEY, "size_ms").orderBy("o").rangeBetween(-(COMPARISON_WINDOW_COUNT - 2), 0)
    nxt = F.lead("o").over(Window.partitionBy(*KEY, "size_ms").orderBy("o"))
    c = (c.withColumn("k", F.count(F.lit(1)).over(frame)).withColumn("nxt", nxt)
          .withColumn("meta", F.first("meta").over(frame)))
    hit = c.where((F.col("k") == COMPARISON_WINDOW_COUNT - 1)
                  & (F.col("nxt").isNull() | (F.col("nxt") != F.col("o") + 1)))
    end = F.col("p") + 2 * F.col("size_ms")
    msg = F.format_string(MSG_DROP, F.col("meta")["window_size"])
    return _result(hit, F.col("meta"), block_type=F.lit("DROP_TO_ZERO"), match_ms=end, emit_ms=end - 1,
                   match_message=msg, matching_events=F.lit(None).cast(SUMMARY_T), phase=F.lit("close"),
                   window_start_ms=end - F.col("size_ms") * COMPARISON_WINDOW_COUNT, window_end_ms=end,
                   event_count=F.lit(0).cast("bigint"), order_tb=F.col("p"))


# ---------------------------------------------------------------------------
# B13 processor registry
# ---------------------------------------------------------------------------

def processors(max_threshold: int = 1, max_fan: int | None = None) -> dict:
    """block type -> function(matched) -> block results.  Extend by adding
    entries (the reference's plug-in surface)."""
    return {
        "SINGLE_EVENT": single_event,
        "THRESHOLD": lambda m: threshold(m, max_threshold, max_fan),
        "UNIQUE_THRESHOLD": lambda m: unique_threshold(m, max_threshold),
        "SIMPLE_ANOMALY": simple_anomaly,
        "DROP_TO_ZERO": drop_to_zero,
    }
