"""Stateful processors for Structured Streaming (``transformWithState``).

``BlockStateProcessor`` - keyed by (customer, rule_id, group_by,
block_index), one per matched-event stream:

* THRESHOLD / UNIQUE_THRESHOLD: map state per sliding window (window end and
  start, so that versions of a rule with other sizes keep apart -> count, fired flag, distinct values, per-aggregation-key summaries).  The
  initial result is emitted the moment the count (or distinct count) reaches
  THRESHOLD; an event-time timer at the window end emits the final result if
  the initial one fired, then deletes the window's state.
* SIMPLE_ANOMALY / DROP_TO_ZERO: map state of tumbling sub-window counts.
  A timer at the end of a sub-window tests the anomaly against the nine
  before it; a timer one sub-window later tests for silence (a timer fires
  with no input, which drop-to-zero needs).  Counts older than the
  comparison window are evicted.

``RuleWindowProcessor`` - keyed by (customer, rule_id, group_by), combines
block results of multi-block rules per sliding rule window and evaluates the
rule condition when the window closes.

State lives in the RocksDB state store (spills to disk, checkpointed);
per-event Python work is a few dictionary updates.
"""

from __future__ import annotations

import json
from typing import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rulestream.schemas import (COMPARISON_WINDOW_COUNT, MSG_ANOMALY, MSG_DROP, MSG_THRESHOLD, MSG_UNIQUE)

BLOCK_OUT_SCHEMA = (
    "customer string, rule_id string, rule_version int, base_severity int, rule_type string, "
    "rule_window_size bigint, rule_window_slide bigint, block_index int, block_type string, group_by string, "
    "match_ms bigint, emit_ms bigint, match_message string, "
    "matching_events array<struct<key:string,sample:string,count:bigint>>, phase string, "
    "window_start_ms bigint, window_end_ms bigint, event_count bigint, order_tb bigint, program string, emit_ts timestamp")

# State values are kept as JSON text: one string column per entry.
_JSON_VALUE = "data string"


def _get(state, key):
    return json.loads(state.getValue(key)[0])


def _put(state, key, value) -> None:
    state.updateValue(key, (json.dumps(value),))


def _starts(ms: int, size: int, slide: int) -> list[int]:
    last = ms - (ms % slide)
    out, s = [], last
    while s > ms - size:
        out.append(s)
        s -= slide
    return out


def _meta(r) -> tuple:
    return (r.rule_version, r.base_severity, r.rule_type, r.rule_window_size, r.rule_window_slide,
            r.window_size, r.threshold, r.anomaly_threshold, r.block_type, r.program)


def _ts(ms):
    import datetime as dt
    return dt.datetime.fromtimestamp(ms / 1000.0, dt.timezone.utc).replace(tzinfo=None)


def _block_row(key, meta, **kw) -> Row:
    customer, rule_id, group_by, block_index = key
    base = dict(customer=customer, rule_id=rule_id, rule_version=meta[0], base_severity=meta[1],
                rule_type=meta[2], rule_window_size=meta[3], rule_window_slide=meta[4],
                block_index=block_index, block_type=meta[8], group_by=group_by, program=meta[9])
    base.update(kw)
    base["emit_ts"] = _ts(base["emit_ms"])
    names = ["customer", "rule_id", "rule_version", "base_severity", "rule_type", "rule_window_size",
             "rule_window_slide", "block_index", "block_type", "group_by", "match_ms", "emit_ms",
             "match_message", "matching_events", "phase", "window_start_ms", "window_end_ms", "event_count",
             "order_tb", "program", "emit_ts"]
    return Row(**{n: base.get(n) for n in names})


class BlockStateProcessor(StatefulProcessor):
    """Windowed block operators B2-B12 over a matched-event stream."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.wins = handle.getMapState("wins", "we long", _JSON_VALUE)
        self.cnts = handle.getMapState("cnts", "p long, size long", _JSON_VALUE)

    # -- helpers -------------------------------------------------------
    def _summaries(self, sums):
        return [(s[0], s[1], s[2]) for s in sorted(sums, key=lambda s: (s[0] is not None, s[0] or ""))]

    def _window_result(self, key, we, v, phase):
        ws, count, _fired, vals, sums, meta = v
        latest = max(s[3] for s in sums) if sums else we - 1
        btype = meta[8]
        if btype == "THRESHOLD":
            msg = MSG_THRESHOLD % (count, int((meta[3] or 0) / 60))
        else:
            msg = MSG_UNIQUE
        first_meta = meta
        return _block_row(key, first_meta, match_ms=latest, emit_ms=we - 1, match_message=msg,
                          matching_events=self._summaries(sums), phase=phase, window_start_ms=ws,
                          window_end_ms=we, event_count=count, order_tb=ws)

    # -- input ---------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        for r in sorted(rows, key=lambda r: (r.event_ms, r.arrival_seq)):
            t = r.block_type
            if t in ("THRESHOLD", "UNIQUE_THRESHOLD"):
                out.extend(self._windowed(key, r))
            elif t in ("SIMPLE_ANOMALY", "DROP_TO_ZERO"):
                self._count(r)
        return iter(out)

    def _windowed(self, key, r):
        size, slide = r.window_size * 1000, r.window_slide * 1000
        if size <= 0 or slide <= 0 or not r.threshold or r.threshold <= 0:
            return []
        unique = r.block_type == "UNIQUE_THRESHOLD"
        if unique and not r.unique_value:
            return []
        out = []
        for ws in _starts(r.event_ms, size, slide):
            we = ws + size
            same_end = _get(self.wins, (we,)) if self.wins.containsKey((we,)) else {}
            v = same_end.get(str(ws))
            if v is None:
                v = [ws, 0, False, [], [], list(_meta(r))]
                self.handle.registerTimer(we - 1)
            v[1] += 1
            sums = [list(s) for s in (v[4] or [])]
            for s in sums:
                if s[0] == r.agg_key:
                    s[2] += 1
                    s[3] = max(s[3], r.event_ms)
                    break
            else:
                sums.append([r.agg_key, r.content, 1, r.event_ms, r.event_ms, r.arrival_seq])
            v[4] = sums
            fire = False
            if unique:
                vals = list(v[3] or [])
                if r.unique_value not in vals:
                    vals.append(r.unique_value)
                    fire = len(vals) == r.threshold
                v[3] = vals
            else:
                fire = v[1] == r.threshold
            if fire and not v[2]:
                v[2] = True
                out.append(self._window_result(key, we, v, "initial"))
            same_end[str(ws)] = v
            _put(self.wins, (we,), same_end)
        return out

    def _count(self, r):
        size = r.window_size * 1000
        if size <= 0:
            return
        p = r.event_ms - (r.event_ms % size)
        if self.cnts.containsKey((p, size)):
            n, _ = _get(self.cnts, (p, size))
            _put(self.cnts, (p, size), [n + 1, list(_meta(r))])  # sample: the last event
        else:
            _put(self.cnts, (p, size), [1, list(_meta(r))])
            self.handle.registerTimer(p + size - 1)          # sub-window closes: anomaly test
            self.handle.registerTimer(p + 2 * size - 1)      # next one empty: drop test

    # -- timers --------------------------------------------------------
    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        we = t + 1
        if self.wins.containsKey((we,)):
            for _, v in sorted(_get(self.wins, (we,)).items(), key=lambda x: int(x[0])):
                if v[2]:
                    out.append(self._window_result(key, we, v, "final"))
            self.wins.removeKey((we,))
        out.extend(self._count_timer(key, t + 1))
        return iter(out)

    def _count_timer(self, key, end):
        by_size = {}
        for (p, size), (data,) in self.cnts.iterator():
            by_size.setdefault(size, {})[p] = json.loads(data)
        out = []
        for size, counts in sorted(by_size.items()):
            out.extend(self._size_timer(key, end, size, counts))
        return out

    def _size_timer(self, key, end, size, counts):
        """Tests and eviction among the sub-windows of one size."""
        out = []
        for p, (n, meta) in sorted(counts.items()):
            btype = meta[8]
            if btype == "SIMPLE_ANOMALY" and p + size == end:
                frame = [q for q in counts if p - (COMPARISON_WINDOW_COUNT - 1) * size <= q <= p]
                if len(frame) >= COMPARISON_WINDOW_COUNT - 1:
                    prev = sum(counts[q][0] for q in frame) - n
                    avg = prev // (COMPARISON_WINDOW_COUNT - 1)
                    first = counts[min(frame)][1]
                    if n >= avg * (first[7] or 0):
                        msg = MSG_ANOMALY % (n, int((first[5] or 0) / 60), avg)
                        out.append(_block_row(key, first, match_ms=end, emit_ms=end - 1, match_message=msg,
                                              matching_events=None, phase="close",
                                              window_start_ms=end - COMPARISON_WINDOW_COUNT * size,
                                              window_end_ms=end, event_count=n, order_tb=p))
            if btype == "DROP_TO_ZERO" and p + 2 * size == end and (p + size) not in counts:
                frame = [q for q in counts if p - (COMPARISON_WINDOW_COUNT - 2) * size <= q <= p]
                if len(frame) == COMPARISON_WINDOW_COUNT - 1:
                    first = counts[min(frame)][1]
                    out.append(_block_row(key, first, match_ms=end, emit_ms=end - 1,
                                          match_message=MSG_DROP % (first[5] or 0), matching_events=None,
                                          phase="close", window_start_ms=end - COMPARISON_WINDOW_COUNT * size,
                                          window_end_ms=end, event_count=0, order_tb=p))
        # evict sub-windows that can no longer enter a comparison window
        for p in counts:
            if p + (COMPARISON_WINDOW_COUNT + 1) * size <= end:
                self.cnts.removeKey((p, size))
        return out

    def close(self) -> None:
        pass


def eval_rule_program(prog, seq_blocks: list[int]) -> bool:
    """Rule condition over the block indices of a window, in time order."""
    seen = set(seq_blocks)
    st: list[bool] = []
    for x in prog or []:
        x = {"idx": None, "neg": None, "n": None, **(x if isinstance(x, dict) else x.asDict())}
        op = x["op"]
        if op == "all":
            st.append(all(i in seen for i in (x["idx"] or [])))
        elif op == "any":
            st.append(any(i in seen for i in (x["idx"] or [])))
        elif op == "seq":
            pos, ok = 0, True
            for b, neg in zip(x["idx"] or [], x["neg"] or []):
                try:
                    j = seq_blocks.index(b, pos)
                    found = True
                except ValueError:
                    found = False
                if found:
                    pos = j
                if found == bool(neg):
                    ok = False
                    break
            st.append(ok)
        elif op in ("and", "or"):
            n = int(x["n"] or 0)
            kids = st[len(st) - n:] if n else []
            del st[len(st) - n:]
            st.append(all(kids) if op == "and" else any(kids))
        else:
            st.append(False)
    return bool(st[-1]) if st else False


ALERT_OUT_SCHEMA = (
    "customer string, rule_id string, rule_version int, base_severity int, group_by string, match_ms bigint, "
    "window_start_ms bigint, window_end_ms bigint, seen array<int>, "
    "outputs map<string,struct<match_ms:bigint,match_message:string,"
    "matching_events:array<struct<key:string,sample:string,count:bigint>>>>")

class RuleWindowProcessor(StatefulProcessor):
    """R3-R7 + O2 in streaming: block results -> rule windows -> alerts.

    Block results carry their rule's condition as JSON text; where they do not
    (fixed rule sets), ``programs`` maps (rule_id, rule_version) to it.
    """

    def __init__(self, programs: dict):
        self.programs = programs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.wins = handle.getMapState("rwins", "rws long, rwe long", _JSON_VALUE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            size, slide = (r.rule_window_size or 0) * 1000, (r.rule_window_slide or 0) * 1000
            if size <= 0 or slide <= 0:
                continue
            item = (r.match_ms, r.emit_ms, int(r.block_type != "SINGLE_EVENT"), r.order_tb, r.block_index,
                    r.rule_version, r.base_severity, r.match_message, [[e["key"], e["sample"], e["count"]] for e in (r.matching_events or [])])
            for ws in _starts(r.emit_ms, size, slide):
                win = (ws, ws + size)
                if self.wins.containsKey(win):
                    programs, items = _get(self.wins, win)
                else:
                    programs, items = {}, []
                    self.handle.registerTimer(ws + size - 1)
                programs[str(r.rule_version)] = r.program
                _put(self.wins, win, [programs, [*items, item]])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs() + 1
        out = []
        for (ws, rwe), (data,) in list(self.wins.iterator()):
            if rwe != end:
                continue
            programs, items = json.loads(data)
            self.wins.removeKey((ws, rwe))
            items = sorted(items, key=lambda it: tuple(it[:5]))
            head = items[0]
            text = programs.get(str(head[5]))
            prog = json.loads(text) if text else self.programs.get((key[1], head[5]))
            if prog is None or not eval_rule_program(prog, [it[4] for it in items]):
                continue
            outputs = {}
            for it in items:
                outputs[str(it[4])] = (it[0], it[7], [tuple(e) for e in (it[8] or [])])
            out.append(Row(customer=key[0], rule_id=key[1], rule_version=head[5], base_severity=head[6],
                           group_by=key[2], match_ms=max(it[0] for it in items), window_start_ms=ws,
                           window_end_ms=rwe, seen=sorted({it[4] for it in items}), outputs=outputs))
        return iter(out)

    def close(self) -> None:
        pass
