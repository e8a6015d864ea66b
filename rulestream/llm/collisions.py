"""Near-duplicate links between embeddings by collision-counting projections (operator 6).

Unit vectors are projected on many random lines.  A pair at cosine ``threshold`` differs on a line by a normal number
of known spread, so the chance that one falls into the window centred at the other is known too; a pair's collisions
over all lines are binomial.  The count that a pair must reach is the largest one which a pair exactly at the threshold
still reaches with probability ``recall``; pairs that pass are verified by their cosine in double precision.

Distribution: vectors that are equal in label and components are one point with a weight.  Points are dealt to the
cells of a grid over the first ``LEAD`` lines, whose cells are wide enough (``LEAD_SPREADS`` spreads) that a pair's
points lie in the same or in neighbouring cells.  Cells of more than ``BLOCK_ROWS`` points are split into blocks, and
a task compares one block with itself or with one other block: sort the second block on every line, count window
collisions for every point of the first, verify.  A task returns each point's number of links and the smallest point
of its local component, never the pairs themselves.

Null labels, null ids, and vectors that are null, zero or hold null or non-finite components link with nothing; they keep
their rows, with no links and their own id as component.  Repeated rows are vectors of their own with one id.
Vectors of different dimensions link with nothing.  Other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import cut
from rulestream.llm.graph import components

LINES = 32
LEAD = 2
LEAD_SPREADS = 3.5
WINDOW_SPREADS = 1.5
BLOCK_ROWS = 2048
RECALL = 0.999
SEED = 60601


def _normal_within(spreads: float) -> float:
    return math.erf(spreads / math.sqrt(2))


def needed_collisions(lines: int, spreads: float, recall: float) -> int:
    """Largest count that a pair at the threshold reaches on ``lines`` lines with probability ``recall`` or more."""
    p, tail = _normal_within(spreads), 0.0
    for k in range(lines, -1, -1):
        tail += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if tail >= recall:
            return k
    return 0


def lines_for(dim: int, n: int) -> np.ndarray:
    """``n`` Gaussian directions, the same in every task."""
    return np.random.default_rng(SEED + dim).standard_normal((dim, n))


def _counts(a: np.ndarray, b: np.ndarray, window: float) -> np.ndarray:
    """Collisions of every row of ``a`` with every row of ``b``: per line, sort ``b`` and mark the window around each ``a``."""
    out = np.zeros((len(a), len(b)), np.int16)
    rows = np.arange(len(a))
    for k in range(a.shape[1]):
        order = np.argsort(b[:, k], kind="stable")
        line = b[order, k]
        mark = np.zeros((len(a), len(b) + 1), np.int16)
        mark[rows, np.searchsorted(line, a[:, k] - window, "left")] += 1
        mark[rows, np.searchsorted(line, a[:, k] + window, "right")] -= 1
        out[:, order] += np.cumsum(mark[:, :-1], axis=1, dtype=np.int16)
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float, recall: float = RECALL, rows: int = 256):
    """(i, j) of linked rows of x and y (y None: i < j within x), block of rows by block."""
    spread = math.sqrt(2 - 2 * threshold)
    need, window = needed_collisions(LINES, WINDOW_SPREADS, recall), WINDOW_SPREADS * spread
    lines = lines_for(x.shape[1], LEAD + LINES)[:, LEAD:]
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    px, other = unit(x) @ lines, x if y is None else y
    py = px if y is None else unit(y) @ lines
    norms = np.sqrt(np.einsum("ij,ij->i", other, other))
    for a in range(0, len(x), rows):
        first = a if y is None else 0
        i, j = np.nonzero(_counts(px[a:a + rows], py[first:], window) >= need)
        i, j = i + a, j + first
        if y is None:
            i, j = i[i < j], j[i < j]
        cos = np.einsum("ij,ij->i", x[i], other[j]) / (np.sqrt(np.einsum("ij,ij->i", x[i], x[i])) * norms[j])
        hit = cos >= threshold
        yield i[hit], j[hit]


def _local(n: int, pairs) -> np.ndarray:
    """Smallest row of each row's component, with rows numbered by id."""
    label = np.arange(n)
    if not len(pairs[0]):
        return label
    i, j = pairs
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compare(threshold: float, recall: float):
    schema = pa.schema([("id", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def task(dim: int, parts) -> pa.RecordBatch | None:
        """parts: of each side, lists of (ids, weights, vectors)."""
        if not parts[0] or (not parts[1] and not parts[2]):
            return None
        both = [[np.concatenate(c) for c in zip(*p)] if p else None for p in (parts[0], parts[1])]
        (ids, weight, x), other = both[0], both[1]
        if other is None:  # a block with itself
            y, all_ids, all_weights, shift = None, ids, weight, 0
        else:
            y, shift = other[2], len(ids)
            all_ids, all_weights = np.concatenate([ids, other[0]]), np.concatenate([weight, other[1]])
        order = np.argsort(all_ids, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        links, label = np.zeros(len(order), np.int64), np.arange(len(order))
        for i, j in linked_pairs(x, y, threshold, recall):
            j = j + shift
            np.add.at(links, place[i], all_weights[j])
            np.add.at(links, place[j], all_weights[i])
            label = _local(len(order), (np.concatenate([place[i], np.arange(len(order))]), np.concatenate([place[j], label])))
        has = np.flatnonzero(links)
        if not len(has):
            return None
        ids = all_ids[order]
        return pa.record_batch([pa.array(ids[has]), pa.array(ids[label[has]]), pa.array(links[has])], schema=schema)

    def run(it):
        now, dim, parts = None, 0, ([], [], [])
        for batch in it:
            key, side, d = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1, 2))
            change = np.flatnonzero((np.diff(key) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *change], [*change, len(key)]):
                if key[a] != now:
                    if now is not None and (out := task(dim, parts)) is not None:
                        yield out
                    now, dim, parts = key[a], int(d[a]), ([], [], [])
                part = batch.slice(a, b - a)
                if side[a] == 2:  # marks a block's comparison with itself
                    parts[2].append(1)
                else:
                    m = np.asarray(part.column(5).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
                    parts[side[a]].append((part.column(3).to_numpy(), part.column(4).to_numpy(), m))
        if now is not None and (out := task(dim, parts)) is not None:
            yield out

    return run


def _grid(points: DataFrame, spread: float) -> DataFrame:
    """Add the point's cell on the lead lines."""

    def run(it):
        for batch in it:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            cell = np.zeros((len(dims), LEAD), np.int32)
            vectors = batch.column(1)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                m = np.asarray(vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)
                m = m / np.linalg.norm(m, axis=1, keepdims=True)
                cell[at] = np.floor(m @ lines_for(int(d), LEAD + LINES)[:, :LEAD] / (LEAD_SPREADS * spread))
            yield pa.record_batch([batch.column(n) for n in range(5)] + [pa.array(cell[:, n]) for n in range(LEAD)], names=["dim", "v", "label", "id", "weight", "c0", "c1"])

    return points.select("dim", "v", "label", "id", "weight").mapInArrow(run, "dim int, v array<double>, label bigint, id bigint, weight bigint, c0 int, c1 int")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias(label_col), vec_col, v.alias("v"))
    rows = rows.select("vec_id", F.col(label_col).alias("label"), "v", F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.withColumn("k1", F.when(F.col("sound"), F.xxhash64("label", "v"))).withColumn("k2", F.when(F.col("sound"), F.xxhash64("v", "label", F.lit(1))))
    groups = rows.where("sound").groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("v").alias("v"))
    points = cut(_grid(groups.withColumn("dim", F.size("v")), math.sqrt(2 - 2 * threshold)))
    cell = ["label", "dim", "c0", "c1"]
    cells = cut(points.groupBy(cell).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))
    steps = F.array(*[F.struct(F.lit(a).alias("s0"), F.lit(b).alias("s1")) for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    ahead = cells.withColumn("s", F.explode(steps)).select("label", "dim", "c0", "c1", F.col("blocks").alias("n"), (F.col("c0") + F.col("s.s0")).alias("d0"), (F.col("c1") + F.col("s.s1")).alias("d1"))
    to = cells.select("label", "dim", F.col("c0").alias("d0"), F.col("c1").alias("d1"), F.col("blocks").alias("m"))
    number = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    tasks = ahead.join(to, ["label", "dim", "d0", "d1"]).withColumn("b", number(F.col("n"))).withColumn("e", number(F.col("m"))).where("c0 != d0 or c1 != d1 or b <= e")
    same = (F.col("c0") == F.col("d0")) & (F.col("c1") == F.col("d1")) & (F.col("b") == F.col("e"))
    tasks = tasks.withColumn("task", F.xxhash64("label", "dim", "c0", "c1", "d0", "d1", "b", "e")).withColumn("same", same)
    blocks = points.join(cells, cell).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    left = blocks.join(tasks.select(*cell, "b", "task"), [*cell, "b"]).select("task", F.lit(0).alias("side"), "dim", "id", "weight", "v")
    right = blocks.join(tasks.where("not same").select("label", "dim", F.col("d0").alias("c0"), F.col("d1").alias("c1"), F.col("e").alias("b"), "task"), [*cell, "b"]).select("task", F.lit(1).alias("side"), "dim", "id", "weight", "v")
    alone = tasks.where("same").select("task", F.lit(2).alias("side"), "dim", F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("weight"), F.array().cast("array<double>").alias("v"))
    dealt = left.unionByName(right).unionByName(alone).repartition("task").sortWithinPartitions("task", "side")
    found = cut(dealt.mapInArrow(_compare(threshold, recall), "id bigint, root bigint, links bigint"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    own = components(found, "id", "root")
    members = groups.select("k1", "k2", "id", "weight").join(links, "id", "left").join(own, "id", "left")
    members = members.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select("vec_id", "k1", "k2").join(members, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
