"""Line dedup by pairwise alignment (operator 1).

A document is cut into short lines by its content alone: a line ends at a line break, at a sentence end, or after a
word whose hash is smaller than those of the two words on either side, or around a word that is repeated at once, so a passage that stands in two documents has the same lines in both,
wherever it stands in them; where none of these comes for ``LINE_WORDS`` words, the line ends after them.  A line is
made rare by its context: its hash covers the following lines until ``BLOCK_WORDS`` words are reached.  Every such hash
is kept, so what two documents share of it is just long enough to be deleted, and no shared block is without one.

Every document is paired with the first holder (smallest id) of each rare line it shares, so a line of any number of
documents makes as many pairs as it has holders, and never all of them; aligned with it, the later document loses the
lines of that hash, so no other holder need be met.  Each pair is aligned by patience diff (lines
that are unique in both, longest increasing run, recursion between them); stretches that it leaves, as of passages that
stand in another order or more than once, are looked up in the whole first document by a suffix automaton of its lines.
Runs of ``BLOCK_WORDS`` words or more are deleted from the later document; the first holder keeps them.

Null ids and null texts are left as they are.  Rows that share an id are not compared with each other; each is
compared with earlier ids.  Words are compared without regard to the case of A-Z and to white space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rulestream.llm.common import cut, mix64
from rulestream.llm.words import Words, words_of

LINE_WORDS = 8
BLOCK_WORDS = 32
SALT_ROWS = 512
_STEP = np.uint64(0xA24BAED4963EE407)
_POWER = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))


class Lines:
    """Lines of consecutive rows: hash, words, byte range, and the first line of every row."""

    def __init__(self, w: Words):
        n = len(w.hash)
        row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        stop = np.zeros(n, bool)
        if n:
            same = row[:-1] == row[1:]
            rank = mix64(w.hash)
            stop[2:-2] = (row[:-4] == row[2:-2]) & (rank[2:-2] < np.minimum(rank[3:-1], rank[4:])) & (rank[2:-2] <= np.minimum(rank[1:-3], rank[:-4])) & (row[4:] == row[2:-2])
            again = (rank[1:] == rank[:-1]) & same
            stop[1:-1] |= again[:-1] & ~again[1:]  # the last of a repeated word
            stop[:-2] |= again[1:] & ~again[:-1]  # the word before a repeated one
            stop |= np.isin(w.data[w.end - 1], np.frombuffer(b".!?", np.uint8))
            breaks = np.flatnonzero(w.data == 10)
            stop[:-1] |= np.searchsorted(breaks, w.end[:-1]) < np.searchsorted(breaks, w.start[1:])
            stop[:-1] |= ~same
            stop[-1] = True
            last = np.flatnonzero(stop)
            head = np.concatenate([[0], last[:-1] + 1])
            since = np.arange(n) - np.repeat(head, last - head + 1)
            stop |= since % LINE_WORDS == LINE_WORDS - 1
        last = np.flatnonzero(stop)
        head = np.concatenate([[0], last[:-1] + 1]) if n else last
        self.words = (last - head + 1).astype(np.int64)
        self.first = np.searchsorted(head, w.first) if n else np.zeros(len(w.first), np.int64)
        if not n:
            self.hash, self.start = np.zeros(0, np.uint64), last
            return
        place = np.cumprod(np.full(int(self.words.max()), _STEP, np.uint64))
        self.hash = mix64(np.add.reduceat(w.hash * place[np.arange(n) - np.repeat(head, self.words)], head))
        self.start = w.start[head]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of lines that just reaches ``BLOCK_WORDS`` words, once a row."""
        n = len(self.hash)
        upto = np.concatenate([[0], np.cumsum(self.words)])
        end = np.searchsorted(upto, upto[:-1] + BLOCK_WORDS)
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero(end <= self.first[row + 1])
        power = np.cumprod(np.full(n + 1, _POWER, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hash * power[:n], dtype=np.uint64)])
        back = np.cumprod(np.full(n + 1, _INVERSE, np.uint64))
        h, row = mix64(mix64((total[end[at]] - total[at]) * back[at]) + (end[at] - at).astype(np.uint64)).view(np.int64), row[at]
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        return row[new], h[new]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions (i, j), increasing in both: equal ends, then lines unique on both sides, then between them."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a: dict = {}
        for i in range(a0, a1):
            once_a[a[i]] = -1 if a[i] in once_a else i
        once_b: dict = {}
        for j in range(b0, b1):
            once_b[b[j]] = -1 if b[j] in once_b else j
        run = _increasing([(once_a[v], j) for v, j in once_b.items() if j >= 0 and once_a.get(v, -1) >= 0])
        if run:
            edges = [(a0 - 1, b0 - 1), *run, (a1, b1)]
            out += run
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:]) if q > p + 1 and s > r + 1]
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (ordered by j) whose i increases: patience sorting with back links."""
    from bisect import bisect_left

    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        if pile == len(tops):
            tops.append(i)
            at.append(k)
        else:
            tops[pile], at[pile] = i, k
        back[k] = at[pile - 1] if pile else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _longest(a: list, b: list) -> list[int]:
    """For each line of ``b`` the length of the longest run of lines that ends there and stands in ``a``: a suffix automaton of ``a``."""
    go: list[dict] = [{}]
    link, size, last = [-1], [0], 0
    for v in a:
        now, p = len(go), last
        go.append({})
        size.append(size[last] + 1)
        link.append(0)
        while p >= 0 and v not in go[p]:
            go[p][v] = now
            p = link[p]
        if p >= 0:
            q = go[p][v]
            if size[q] == size[p] + 1:
                link[now] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(v) == q:
                    go[p][v] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    out, at, n = [], 0, 0
    for v in b:
        while at and v not in go[at]:
            at = link[at]
            n = size[at]
        if v in go[at]:
            at, n = go[at][v], n + 1
        out.append(n)
    return out


def _stretches(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of each stretch of true values."""
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def common_blocks(a: np.ndarray, b: np.ndarray, words: np.ndarray, least: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """Line ranges of ``b`` that stand in ``a`` as runs of ``least`` words or more: all of them, in whatever order and however often.

    Patience diff aligns what it can; stretches of lines of ``a`` that it leaves are looked up in the whole of ``a``.
    """
    if len(a) == len(b) and np.array_equal(a, b):
        return [(0, len(b))] if words.sum() >= least else []
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    low, high = _stretches(np.isin(b, a))
    wide = upto[high] - upto[low] >= least
    low, high = low[wide], high[wide]
    if not len(low):
        return []
    gone = np.zeros(len(b), bool)
    pairs = np.array(patience(a.tolist(), b.tolist()), np.int64).reshape(-1, 2)
    cuts = np.flatnonzero((np.diff(pairs, axis=0) != 1).any(axis=1)) + 1
    for run in np.split(pairs[:, 1], cuts):
        if len(run) and upto[run[-1] + 1] - upto[run[0]] >= least:
            gone[run[0]:run[-1] + 1] = True
    left = [(p, q) for p, q in zip(low.tolist(), high.tolist()) if not gone[p:q].all()]
    if left:
        stretches = [b[p:q] for p, q in left]
        held = np.isin(a, np.concatenate(stretches))
        known, y = np.where(held, a.astype(np.int64), -1)[held | np.append(True, held[:-1])].tolist(), []
        for v in stretches:
            y += [*v.tolist(), -2]
        longest, k = _longest(known, y), 0
        for p, q in left:
            end = np.arange(p, q) + 1
            start = end - longest[k:k + q - p]
            far = upto[end] - upto[start] >= least
            step = np.zeros(len(b) + 1, np.int64)
            np.add.at(step, start[far], 1)
            np.add.at(step, end[far], -1)
            gone |= np.cumsum(step[:-1]) > 0
            k += q - p + 1
    return [(int(p), int(q)) for p, q in zip(*_stretches(gone))]


def _anchor_rows(it):
    for batch in it:
        for a, _, w in words_of(batch.column(1)):
            row, h = Lines(w).anchors()
            yield pa.record_batch([batch.column(0).take(pa.array(row + a)), pa.array(h)], names=["id", "h"])


def _meet_first(it):
    """Rows by (h, id): each later holder of a hash with its first one."""
    now, holder = None, None
    for batch in it:
        if not batch.num_rows:
            continue
        ids, h = (c.to_numpy() for c in batch.columns)
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        new[0] = now is None or h[0] != now
        first = np.append(ids[new], holder if holder is not None else 0)[np.cumsum(new) - 1]
        now, holder = h[-1], first[-1]
        later = ids > first
        yield pa.record_batch([pa.array(ids[later]), pa.array(first[later])], names=["id", "first"])


def _line_rows(it, text_at: int):
    """Per row: (first, salt) of every alignment it takes part in, its side there, and its lines.

    Column ``text_at`` is the text; the last four are its id and hash, the row's first holders and its number of salts.
    """
    for batch in it:
        ids, fps, firsts, spread = (c.to_pylist() for c in batch.columns[-4:])
        for a, b, w in words_of(batch.column(text_at)):
            lines = Lines(w)
            out = []
            for r in range(a, b):
                p, q = lines.first[r - a], lines.first[r - a + 1]
                h, n = lines.hash[p:q].astype("<u4").tobytes(), np.minimum(lines.words[p:q], 65535).astype("<u2").tobytes()
                out += [(ids[r], salt, 0, ids[r], fps[r], h, b"") for salt in range(spread[r] or 0)]
                out += [(f["first"], f["salt"], 1, ids[r], fps[r], h, n) for f in firsts[r] or ()]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["first", "salt", "side", "id", "fp", "h", "n"])


def _align(it):
    """Rows by (first, salt, side): keep the first document's lines, align each later document with them."""
    now, base = None, []
    for batch in it:
        rows = []
        for first, salt, side, doc, fp, h, n in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (first, salt):
                now, base = (first, salt), []
            lines = np.frombuffer(h, "<u4")
            if side == 0:
                base.append(lines)
                continue
            blocks = sorted({x for a in base for x in common_blocks(a, lines, np.frombuffer(n, "<u2"))})
            if blocks:
                rows.append((doc, fp, [x for x, _ in blocks], [y for _, y in blocks], first))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()))], names=["id", "fp", "low", "high", "first"])


def _without(text: str, lines: Lines, row: int, at: int, low: list[int], high: list[int]) -> tuple[str, int, int]:
    """The text without the line ranges; the number of its lines that go, and of their words.  ``at``: the row's first byte."""
    p, q = int(lines.first[row]), int(lines.first[row + 1])
    gone = np.zeros(q - p, bool)
    for a, b in zip(low, high):
        gone[a:b] = True
    raw = text.encode("utf-8", "surrogatepass")
    start = np.append(lines.start[p:q] - at, len(raw))
    keep = b"".join([raw[:start[0]]] + [raw[start[k]:start[k + 1]] for k in np.flatnonzero(~gone)])
    return keep.decode("utf-8", "surrogatepass"), int(gone.sum()), int(lines.words[p:q][gone].sum())


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns with the text as a string, and _d_id, _d_fp: the id and the hash of the row's text."""
    rows = documents if documents.schema[text_col].dataType == StringType() else documents.withColumn(text_col, F.col(text_col).cast("string"))
    return rows.select("*", F.col(id_col).cast("bigint").alias("_d_id"), F.xxhash64(text_col).alias("_d_fp"))


def _duplicates(known: DataFrame, text_col: str) -> DataFrame:
    """``line_duplicates`` of keyed rows.

    The texts are joined with their roles by (id, fp) with all their columns, which is how ``dedup_lines`` joins them
    with the result: the two joins read one exchange of the texts.
    """
    docs = known.select(F.col("_d_id").alias("id"), F.col(text_col).alias("text"))
    # A document counts once for each of its many hashes, so no hash's rows outweigh a task's share of all hashes.
    holders = docs.mapInArrow(_anchor_rows, "id bigint, h bigint").repartition("h").sortWithinPartitions("h", "id")
    pairs = cut(holders.mapInArrow(_meet_first, "id bigint, first bigint").distinct())
    spread = pairs.groupBy("first").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("spread"))
    later = pairs.join(spread, "first").select("id", F.struct("first", F.pmod(F.xxhash64("id"), F.col("spread")).cast("int").alias("salt")).alias("f"))
    roles = later.groupBy("id").agg(F.collect_list("f").alias("firsts")).join(spread.select(F.col("first").alias("id"), "spread"), "id", "full")
    texts = known.select(F.col("_d_id").alias("id"), F.col("_d_fp").alias("fp")).distinct()
    roles = roles.join(texts, "id").select(F.col("id").alias("_d_rid"), F.col("fp").alias("_d_rfp"), "firsts", "spread")
    rows = known.join(roles, (F.col("_d_id") == F.col("_d_rid")) & (F.col("_d_fp") == F.col("_d_rfp"))).drop("_d_rid", "_d_rfp")
    text_at = known.columns.index(text_col)
    dealt = rows.mapInArrow(lambda it: _line_rows(it, text_at), "first bigint, salt int, side int, id bigint, fp bigint, h binary, n binary")
    dealt = dealt.repartition("first", "salt").sortWithinPartitions("first", "salt", "side")
    found = dealt.mapInArrow(_align, "id bigint, fp bigint, low array<int>, high array<int>, first bigint")
    return found.groupBy("id", "fp").agg(F.flatten(F.collect_list("low")).alias("low"), F.flatten(F.collect_list("high")).alias("high"), F.array_sort(F.collect_set("first")).alias("firsts"))


def line_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, low, high, firsts): for each document that loses lines, their ranges and the earlier documents that hold them.

    ``fp`` is the hash of the row's text; it tells rows of one id apart.
    """
    keyed = _keyed(documents.select(id_col, text_col), id_col, text_col)
    return _duplicates(keyed.where(keyed["_d_id"].isNotNull() & keyed[text_col].isNotNull()), text_col)


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, with duplicated blocks deleted from the text, and lines_deleted, words_deleted, deleted_for (earlier ids).

    Names of the input that clash with the added columns, or begin with ``_d_``, are not supported as extra columns: the
    input's columns of the three added names are replaced.  Rows without id or text pass as they are; an empty table
    gives an empty one.
    """
    base = documents.drop("lines_deleted", "words_deleted", "deleted_for")
    keyed = _keyed(base, id_col, text_col)
    compared = keyed["_d_id"].isNotNull() & keyed[text_col].isNotNull()
    known = keyed.where(compared)
    found = _duplicates(known, text_col).select(F.col("id").alias("_d_cid"), F.col("fp").alias("_d_cfp"), F.struct("low", "high", "firsts").alias("_d_cut"))
    rows = known.join(found, (F.col("_d_id") == F.col("_d_cid")) & (F.col("_d_fp") == F.col("_d_cfp")), "left").drop("_d_cid", "_d_cfp")
    rest = keyed.where(~compared).withColumn("_d_cut", F.lit(None).cast(found.schema["_d_cut"].dataType))
    rows = rows.unionByName(rest)
    rows = rows.select(*base.columns, F.col("_d_cut.low").alias("_d_low"), F.col("_d_cut.high").alias("_d_high"), F.coalesce("_d_cut.firsts", F.array().cast("array<bigint>")).alias("deleted_for"))
    names = rows.columns
    schema = rows.drop("_d_low", "_d_high").schema.add("lines_deleted", "long").add("words_deleted", "long")

    def run(it):
        for batch in it:
            col = batch.column(names.index(text_col))
            low, high = (batch.column(names.index(c)) for c in ("_d_low", "_d_high"))
            hit = np.flatnonzero(low.is_valid().to_numpy(zero_copy_only=False))
            lines, words = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            if len(hit):
                some, new = col.take(pa.array(hit)), col.to_pylist()
                for a, b, w in words_of(some):
                    cut_lines = Lines(w)
                    for r in range(a, b):
                        k = int(hit[r])
                        new[k], lines[k], words[k] = _without(new[k], cut_lines, r - a, int(w.offsets[r - a]), low[k].as_py(), high[k].as_py())
                col = pa.array(new, col.type)
            keep = [c for c in names if c not in ("_d_low", "_d_high")]
            yield pa.record_batch([col if c == text_col else batch.column(names.index(c)) for c in keep] + [pa.array(lines), pa.array(words)], names=[*keep, "lines_deleted", "words_deleted"])

    return rows.mapInArrow(run, schema)
