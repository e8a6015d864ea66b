"""Hard-negative mining with STR-packed R-trees (operator 12).

Vectors are quantised to whole numbers, floor(scale * x).  Anchors are matched with their positives (the best other rows
of their own label) and each pair with its negatives: the best rows of other labels whose score lies in the pair's
window, ``low`` to ``high`` per cent of the positive's score.

Sort-tile-recursive packing is done twice.  Over the whole table, rows are sorted into slabs along the most widely spread
coordinate and into tiles along the next one, by quantiles of all rows; a tile of more than ``SHARD_ROWS`` rows (copies
of one vector) is split evenly, so a shard is bounded whatever the data.  Within a shard, the tree packs ``LEAF_ROWS``
rows to a leaf and ``FANOUT`` boxes to a box.  A minimum bounding box gives, coordinate by coordinate, the interval of
the inner products its rows can have with an anchor.  Each anchor's queue yields the box of the highest possible score
first; boxes whose interval misses the window, or whose upper end is strictly below the kth score so far, are pruned.

An anchor first searches its own shard.  The kth scores found there go with it to the table of shard boxes, in blocks of
``BOXES`` shards, where the same interval test decides which other shards it visits at all.  Shards stream their anchors
in batches after building the tree, so a task holds one shard and one batch; nothing is broadcast but the quantiles.

Rows whose id, label or vector is null, or whose vector is empty or holds null or non-finite components, take no part.
Where ``flip`` holds, labels are changed first.  Only vectors of the anchor's own dimension are candidates.  Other rows
are rows of another id; repeated rows are anchors, positives and negatives of their own.  Ties go to the smaller id, then
in no set order between repeated rows, which give equal output.  Components beyond the range of a long are cut to it, and
so are scores; numbers too large for exact doubles are scored in whole-number arithmetic.  An empty table gives no rows.
Other columns are not carried, whatever their names.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rulestream.llm.common import cut

SHARD_ROWS = 16384
LEAF_ROWS = 128
FANOUT = 8
AXES = 3
BOXES = 1024
ANCHORS = 256
_EXACT = 2.0**53


def pack(points: np.ndarray, rows: np.ndarray, axes: list[int]) -> np.ndarray:
    """Sort-tile-recursive order of ``rows``: slabs of whole pages along one coordinate, each packed along the next."""
    rows = rows[np.argsort(points[rows, axes[0]], kind="stable")]
    pages = -(-len(rows) // LEAF_ROWS)
    if len(axes) == 1 or pages <= 1:
        return rows
    slabs = math.ceil(pages ** (1 / len(axes)))
    size = LEAF_ROWS * -(-pages // slabs)
    return np.concatenate([pack(points, rows[a:a + size], axes[1:]) for a in range(0, len(rows), size)])


class RTree:
    """Boxes of all levels: the leaves (row ranges) first, the root last."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        spread = points.max(0) - points.min(0)
        order = pack(points, np.arange(len(points)), list(np.argsort(-spread, kind="stable")[:AXES]))
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        level = [(a, min(a + LEAF_ROWS, len(order))) for a in range(0, len(order), LEAF_ROWS)]
        low = [self.points[a:b].min(0) for a, b in level]
        high = [self.points[a:b].max(0) for a, b in level]
        self.leaves, self.span, begin = len(level), list(level), 0
        while len(self.span) - begin > 1:  # ranges of children, level by level
            end = len(self.span)
            for a in range(begin, end, FANOUT):
                b = min(a + FANOUT, end)
                self.span.append((a, b))
                low.append(np.min(low[a:b], axis=0))
                high.append(np.max(high[a:b], axis=0))
            begin = end
        self.low, self.high = np.array(low), np.array(high)

    def search(self, anchors, anchor_ids, anchor_labels, who, low, high, kth, k: int, same: bool):
        """(query, row of the tree, score): the best ``k`` rows of every query with a score in [low, high], not below kth.

        A query is an anchor (number ``who``) with a window; ``same`` asks for rows of its label, else for others.
        """
        lower, upper = intervals(anchors, self.low, self.high)
        queues = [[(-upper[w, -1], len(self.span) - 1)] for w in who]
        kth = np.maximum(kth, low)
        q, r, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        alive = list(range(len(who)))
        while alive:
            asks, leaf = [], []
            for n in alive:
                queue, w = queues[n], who[n]
                while queue:
                    up, node = heapq.heappop(queue)
                    if -up < kth[n]:
                        queue.clear()  # every box left is strictly below the kth score or the window
                    elif node < self.leaves:
                        asks.append(n)
                        leaf.append(node)
                        break
                    else:
                        for child in range(*self.span[node]):
                            if upper[w, child] >= kth[n] and lower[w, child] <= high[n]:
                                heapq.heappush(queue, (-upper[w, child], child))
            if not asks:
                break
            alive = asks
            asks, leaf = np.array(asks), np.array(leaf)
            found = [(q, r, s)]
            for node in np.unique(leaf):
                n = asks[leaf == node]
                a, b = self.span[node]
                own, at = np.unique(who[n], return_inverse=True)
                score = (anchors[own] @ self.points[a:b].T)[at]
                w = who[n]
                ok = (score >= kth[n, None]) & (score <= high[n, None]) & (self.ids[a:b] != anchor_ids[w, None]) & ((self.labels[a:b] == anchor_labels[w, None]) == same)
                hit, col = np.nonzero(ok)
                found.append((n[hit], a + col, score[hit, col]))
            q, r, s = (np.concatenate(x) for x in zip(*found))
            by = np.lexsort((self.ids[r], -s, q))
            q, r, s = q[by], r[by], s[by]
            first = np.searchsorted(q, np.arange(len(who) + 1))
            keep = np.arange(len(q)) - first[q] < k
            q, r, s = q[keep], r[keep], s[keep]
            first = np.searchsorted(q, np.arange(len(who) + 1))
            full = np.flatnonzero(np.diff(first) >= k)
            kth[full] = np.maximum(kth[full], s[first[full] + k - 1])
        return q, r, s


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest inner product of each anchor with a point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    return max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * a.shape[1] * 100 < _EXACT


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores n with low * positive <= 100 * n <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def _whole_search(tree: RTree, anchors, ids, labels, who, low, high, kth, k, same):
    """The same in whole-number arithmetic, for numbers too large for exact doubles."""
    out = []
    rows = [[int(x) for x in p] for p in tree.points]
    for n, w in enumerate(who):
        a = [int(x) for x in anchors[w]]
        scored = []
        for r, p in enumerate(rows):
            if tree.ids[r] != ids[w] and (tree.labels[r] == labels[w]) == same:
                s = max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, p))))
                if (low[n] is None or low[n] <= s <= high[n]) and (kth[n] is None or s >= kth[n]):
                    scored.append((-s, int(tree.ids[r]), r))
        out += [(n, r, -s) for s, _, r in heapq.nsmallest(k, scored)]
    return [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


# rows that meet in a shard: its vectors first, then the anchors that search it
_ROW = "shard int, dim int, asks int, row bigint, vec_id bigint, label bigint, q array<double>, positives array<bigint>, kths array<bigint>"


def _runs(it):
    """(shard, dim, asks, batch) of consecutive rows that agree in them."""
    for batch in it:
        keys = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(3)]
        change = np.flatnonzero(np.any([np.diff(x) != 0 for x in keys], axis=0)) + 1 if batch.num_rows else []
        for a, b in zip([0, *change], [*change, batch.num_rows]):
            if b > a:
                yield *(int(x[a]) for x in keys), batch.slice(a, b - a)


def _windows(batch, low, high):
    """Per query: its anchor's number in the batch, its positive's score (None: no window), bounds and kth score."""
    who, positives, lows, highs, kths = [], [], [], [], []
    for n, (ps, ks) in enumerate(zip(batch.column(7).to_pylist(), batch.column(8).to_pylist())):
        for p, kth in zip(ps, ks):
            a, b = (None, None) if p is None else window_of(p, low, high)
            if a is None or a <= b:
                who.append(n)
                positives.append(p)
                lows.append(a)
                highs.append(b)
                kths.append(kth)
    return np.array(who, np.int64), positives, lows, highs, kths


def _floats(xs, none):
    return np.array([none if x is None else x for x in xs], float)


def _searcher(k: int, same: bool, low: int, high: int):
    schema = pa.schema([("row", pa.int64()), ("anchor_id", pa.int64()), ("positive", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])

    def run(it):
        now, held, tree = None, [], None
        for shard, dim, asks, batch in _runs(it):
            if now != (shard, dim):
                now, held, tree = (shard, dim), [], None
            if not asks:
                held.append((_matrix(batch.column(6), dim), batch.column(4).to_numpy(), batch.column(5).to_numpy()))
                continue
            if tree is None:
                if not held:
                    continue
                tree, held = RTree(*(np.concatenate(x) for x in zip(*held))), []
            for x in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(x, ANCHORS)
                who, positives, lows, highs, kths = _windows(part, low, high)
                if not len(who):
                    continue
                anchors, row, ids, labels = _matrix(part.column(6), dim), part.column(3).to_numpy(), part.column(4).to_numpy(), part.column(5).to_numpy()
                if _exact(tree.points, anchors):
                    q, r, s = tree.search(anchors, ids, labels, who, _floats(lows, -np.inf), _floats(highs, np.inf), _floats(kths, -np.inf), k, same)
                else:
                    q, r, s = _whole_search(tree, anchors, ids, labels, who, lows, highs, kths, k, same)
                if len(q):
                    at = who[np.asarray(q, np.int64)]
                    yield pa.record_batch([pa.array(row[at]), pa.array(ids[at]), pa.array([positives[n] for n in q], pa.int64()),
                                           pa.array(tree.ids[np.asarray(r, np.int64)]), pa.array([int(v) for v in s], pa.int64())], schema=schema)

    return run


def _router(low: int, high: int, home: bool):
    """Anchors over blocks of shard boxes: one row per anchor and shard that its queues cannot rule out."""

    def run(it):
        now, boxes = None, []
        for block, dim, asks, batch in _runs(it):
            if now != (block, dim):
                now, boxes = (block, dim), []
            if not asks:  # row: the shard; q: the low ends, then the high ends of its box
                m = _matrix(batch.column(6), 2 * dim)
                boxes += zip(batch.column(3).to_pylist(), m[:, :dim], m[:, dim:])
                continue
            if not boxes:
                continue
            shards, box_low, box_high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])
            for x in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(x, ANCHORS)
                who, _, lows, highs, kths = _windows(part, low, high)
                if not len(who):
                    continue
                anchors = _matrix(part.column(6), dim)
                least, most = intervals(anchors, box_low, box_high)
                if not (_exact(box_low, anchors) and _exact(box_high, anchors)):
                    slack = 1e-9 * np.maximum(np.abs(least), np.abs(most)) + 1
                    least, most = least - slack, most + slack
                need = np.maximum(_floats(lows, -np.inf), _floats(kths, -np.inf))
                open_ = (most[who] >= need[:, None]) & (least[who] <= _floats(highs, np.inf)[:, None])
                visits = np.zeros((part.num_rows, len(shards)), bool)
                np.logical_or.at(visits, who, open_)
                own = part.column(9).to_numpy()
                visits &= shards[None, :] != own[:, None]
                n, b = np.nonzero(visits)
                if len(n):
                    cols = [part.column(c).take(pa.array(n)) for c in range(2, 9)]
                    yield pa.record_batch([pa.array(shards[b].astype(np.int32)), pa.array(np.full(len(n), dim, np.int32)), *cols], schema=_arrow_schema())

    return run


def _arrow_schema():
    big = pa.list_(pa.int64())
    return pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("asks", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.float64())), ("positives", big), ("kths", big)])


def _boxes(it):
    """(shard, dim, low ends and high ends) of the rows of a shard in a partition."""
    ends = {}
    for shard, dim, _, batch in _runs(it):
        m = _matrix(batch.column(6), dim)
        low, high = m.min(0), m.max(0)
        if (shard, dim) in ends:
            low, high = np.minimum(low, ends[shard, dim][0]), np.maximum(high, ends[shard, dim][1])
        ends[shard, dim] = (low, high)
    for (shard, dim), (low, high) in ends.items():
        yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([dim], pa.int32()), pa.array([np.concatenate([low, high]).tolist()], pa.list_(pa.float64()))], names=["shard", "dim", "box"])


def _sharded(v: DataFrame, shard_rows: int) -> tuple[DataFrame, int]:
    """Every row with its shard: tiles of the two most widely spread coordinates, split where copies overfill them."""
    total = v.count()
    tiles = max(1, math.ceil(total / (shard_rows // 2)))
    slabs = math.ceil(math.sqrt(tiles))
    spread = v.select(F.posexplode("q").alias("pos", "x")).groupBy("pos").agg(F.stddev_pop("x").alias("s")).orderBy(F.desc("s"), "pos").limit(2).collect()
    if slabs == 1 or not spread:
        return v.withColumn("shard", F.lit(0)), 1
    axes = [r.pos for r in spread]
    cuts = F.array(*[F.lit(k / slabs) for k in range(1, slabs)])
    a, b = (F.coalesce(F.try_element_at("q", F.lit(x + 1)), F.lit(0.0)) for x in (axes[0], axes[-1]))
    v = v.withColumn("_a", a).withColumn("_b", b)
    first = v.agg(F.percentile_approx("_a", cuts, 10000).alias("_c")).first()["_c"]
    v = v.withColumn("_slab", F.size(F.filter(F.array(*[F.lit(float(c)) for c in first]), lambda c: c <= F.col("_a"))))
    second = v.groupBy("_slab").agg(F.percentile_approx("_b", cuts, 10000).alias("_d"))
    v = v.join(second, "_slab").withColumn("_tile", F.col("_slab") * slabs + F.size(F.filter("_d", lambda c: c <= F.col("_b"))))
    counts = v.groupBy("_tile").count().select("_tile", F.ceil(F.col("count") / shard_rows).cast("int").alias("_parts"))
    counts = counts.withColumn("_first", F.sum("_parts").over(Window.orderBy("_tile")) - F.col("_parts"))  # one row per tile
    shards = counts.agg(F.sum("_parts")).first()[0]
    placed = v.join(counts, "_tile").withColumn("shard", (F.col("_first") + F.pmod(F.xxhash64("row"), F.col("_parts"))).cast("int"))
    return placed.drop("_a", "_b", "_c", "_d", "_slab", "_tile", "_parts", "_first"), int(shards)


class Miner:
    """Vectors in shards with their boxes; searches them for blocks of anchors."""

    def __init__(self, v: DataFrame, shard_rows: int):
        placed, self.shards = _sharded(v, shard_rows)
        none = F.lit(None).cast("array<bigint>")
        points = placed.select("shard", "dim", F.lit(0).alias("asks"), "row", "vec_id", "label", "q", none.alias("positives"), none.alias("kths"))
        self.points = cut(points.repartitionById(self.shards, F.col("shard")).sortWithinPartitions("shard", "dim"))
        box = self.points.mapInArrow(_boxes, "shard int, dim int, box array<double>")
        block = (F.col("shard") / BOXES).cast("int")
        self.blocks = -(-self.shards // BOXES)
        self.boxes = cut(box.select(block.alias("shard"), "dim", F.lit(0).alias("asks"), F.col("shard").cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("vec_id"),
                                    F.lit(0).cast("bigint").alias("label"), F.col("box").alias("q"), none.alias("positives"), none.alias("kths"), F.lit(-1).alias("home")))

    def _meet(self, rows: DataFrame, asked: DataFrame, parts: int) -> DataFrame:
        return rows.unionByName(asked).repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "dim", "asks")

    def search(self, anchors: DataFrame, k: int, same: bool, low: int = 0, high: int = 0) -> DataFrame:
        """row, anchor_id, positive, found_id, score of the best ``k`` rows of every anchor and window.

        ``anchors``: rows of ``points`` with one entry of ``positives`` per window (null: no window).
        """
        out = "row bigint, anchor_id bigint, positive bigint, found_id bigint, score bigint"
        run = _searcher(k, same, low, high)
        anchors = anchors.withColumn("asks", F.lit(1)).withColumn("kths", F.transform("positives", lambda p: F.lit(None).cast("bigint")))
        home = cut(self._meet(self.points, anchors, self.shards).mapInArrow(run, out))
        if self.shards == 1:
            return _best(home, k)
        reached = _best(home, k).where(F.col("rank") == k).groupBy("row").agg(F.collect_list(F.struct("positive", "score")).alias("reached"))
        kth = F.transform("positives", lambda p: F.get(F.filter("reached", lambda r: r["positive"].eqNullSafe(p)), F.lit(0))["score"])
        asked = anchors.join(reached, "row", "left").withColumn("kths", F.coalesce(kth, "kths")).withColumnRenamed("shard", "home")
        asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("shard"), "dim", "asks", "row", "vec_id", "label", "q", "positives", "kths", "home")
        visits = self._meet(self.boxes, asked, self.blocks).mapInArrow(_router(low, high, True), _ROW)
        others = self._meet(self.points, visits, self.shards).mapInArrow(run, out)
        return _best(home.unionByName(others), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row", "positive").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, flip: Column | None = None, flipped: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` and ``flip`` are conditions over ``vec_id``; where ``flip`` holds, ``flipped`` (over ``label``) is the label.
    """
    x = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    sound = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = vectors.where(sound & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.size(vec_col).alias("dim"), x.alias("q"))
    if flip is not None:
        v = v.withColumn("label", F.when(flip, flipped).otherwise(F.col("label")).cast("bigint"))
    miner = Miner(cut(v.withColumn("row", F.monotonically_increasing_id())), shard_rows)
    anchors = miner.points.where(anchor)
    first = cut(miner.search(anchors.withColumn("positives", F.array(F.lit(None).cast("bigint"))), positives, True).select("row", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("positive_rank")))
    windows = first.groupBy("row").agg(F.array_sort(F.collect_set("positive_score")).alias("windows"))
    asked = anchors.join(windows, "row").withColumn("positives", F.col("windows")).select(anchors.columns)
    found = miner.search(asked, negatives, False, low, high)
    return first.join(found, (first["row"] == found["row"]) & (first["positive_score"] == found["positive"])).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
