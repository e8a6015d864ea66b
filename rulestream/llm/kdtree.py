"""Exact top-k search by inner product with KD-trees per shard (operator 10).

Vectors are quantised to whole numbers, floor(scale * x), and dealt to shards of bounded size.  Each shard builds a
KD-tree: median splits of the widest coordinate down to leaves, with the tight bounding box of each leaf.  A query
visits the leaves in the order of their boxes' bounds (the largest inner product any point of the box can have) and
stops when the next bound is below its kth score.  Queries first search one shard, and the kth score found there
starts the search in all other shards, so that a shard returns only rows that can still enter the result.

Queries meet shards in blocks; nothing is broadcast, and no task holds more than one shard and one block.

Vectors that are null or empty, or hold null or non-finite components, take no part; only vectors of a query's own
dimension are its candidates.  Rows without an id take no part.  Ties go to the smaller id.  Repeated rows are separate
candidates; a row with the query's own id is not one.  Scores beyond the range of a long are cut to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rulestream.llm.common import cut

SHARD_ROWS = 16384
LEAF_ROWS = 256
QUERY_BLOCK = 1024
_EXACT = 2.0**53


class Tree:
    """Median-split KD-tree over integer-valued rows; only its leaves, their rows and tight boxes are kept."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order, todo, leaves = np.arange(len(points)), [(0, len(points))], []
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF_ROWS:
                leaves.append((a, b))
                continue
            rows = points[order[a:b]]
            axis = int(np.argmax(rows.max(0) - rows.min(0)))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, axis], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.points, self.ids, self.leaves = points[order], ids[order], sorted(leaves)
        self.low = np.array([self.points[a:b].min(0) for a, b in self.leaves])
        self.high = np.array([self.points[a:b].max(0) for a, b in self.leaves])

    def search(self, queries: np.ndarray, query_ids: np.ndarray, kth: np.ndarray, k: int):
        """(query row, id, score) of the best ``k`` rows of each query whose score is ``kth`` or more."""
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        kth = kth.copy()
        q, s, i = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        alive = np.arange(len(queries))
        for step in range(len(self.leaves)):
            leaf = order[alive, step]
            open_ = bounds[alive, leaf] >= kth[alive]  # later bounds are no larger: a closed query is done
            alive, leaf = alive[open_], leaf[open_]
            if not len(alive):
                break
            found = []
            by = np.argsort(leaf, kind="stable")
            for part in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                a, b = self.leaves[leaf[part[0]]]
                rows = alive[part]
                score = queries[rows] @ self.points[a:b].T
                hit, col = np.nonzero((score >= kth[rows, None]) & (self.ids[a:b][None, :] != query_ids[rows, None]))
                found.append((rows[hit], score[hit, col], self.ids[a + col]))
            q, s, i = (np.concatenate([x, *(f[n] for f in found)]) for n, x in enumerate((q, s, i)))
            by = np.lexsort((i, -s, q))
            q, s, i = q[by], s[by], i[by]
            first = np.searchsorted(q, np.arange(len(queries) + 1))
            keep = np.arange(len(q)) - first[q] < k
            q, s, i = q[keep], s[keep], i[keep]
            first = np.searchsorted(q, np.arange(len(queries) + 1))
            full = np.flatnonzero(np.diff(first) >= k)
            kth[full] = np.maximum(kth[full], s[first[full] + k - 1])
        return q, i, s


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _exact_scores(points: np.ndarray, queries: np.ndarray) -> bool:
    top = max(1.0, np.abs(points).max(initial=0)) * max(1.0, np.abs(queries).max(initial=0)) * max(1, points.shape[1])
    return top < _EXACT


def _search_all(tree: Tree, queries, ids, kth, k):
    if _exact_scores(tree.points, queries):
        return tree.search(queries, ids, kth, k)
    out_q, out_i, out_s = [], [], []  # numbers too large for exact doubles: whole-number arithmetic, row by row
    whole = [[int(x) for x in row] for row in tree.points]
    for n, row in enumerate(queries):
        row = [int(x) for x in row]
        scores = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(row, p)))), int(i)) for p, i in zip(whole, tree.ids) if i != ids[n])[:k]
        out_q += [n] * len(scores)
        out_i += [i for _, i in scores]
        out_s += [-s for s, _ in scores]
    return out_q, out_i, out_s


def _searcher(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(it):
        """Rows by (shard, dim), its points before its queries: build the tree, then search block by block."""
        now, ids, points, tree = None, [], [], None
        for batch in it:
            shard, dim, is_query = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1, 2))
            change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(dim) != 0) | (np.diff(is_query) != 0)) + 1
            for a, b in zip([0, *change], [*change, len(shard)]):
                part = batch.slice(a, b - a)
                if now != (shard[a], dim[a]):
                    now, ids, points, tree = (shard[a], dim[a]), [], [], None
                m = _matrix(part.column(5), int(dim[a]))
                if not is_query[a]:
                    ids.append(part.column(3).to_numpy())
                    points.append(m)
                    continue
                if tree is None and points:
                    tree, points, ids = Tree(np.concatenate(points), np.concatenate(ids)), [], []
                if tree is None:
                    continue
                qid, row, kth = part.column(3).to_numpy(), part.column(4).to_numpy(), part.column(6).to_numpy(zero_copy_only=False).astype(np.float64)
                for x in range(0, len(qid), QUERY_BLOCK):
                    y = slice(x, x + QUERY_BLOCK)
                    q, i, s = _search_all(tree, m[y], qid[y], np.nan_to_num(kth[y], nan=-np.inf), k)
                    q = np.asarray(q, np.int64)
                    if len(q):
                        yield pa.record_batch([pa.array(qid[y][q]), pa.array(row[y][q]), pa.array(np.asarray(i, np.int64)), pa.array(np.asarray(s if isinstance(s, list) else s, np.int64))], schema=schema)

    return run


def _best(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, query_filter, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of every row for which ``query_filter`` (a Column over ``vec_id``) holds."""
    x = F.transform(F.col(vec_col), lambda v: F.floor(v.cast("double") * scale).cast("double"))
    sound = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    v = vectors.where(sound & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), F.size(vec_col).alias("dim"), x.alias("q"), F.xxhash64(F.col(id_col), F.col(vec_col), F.spark_partition_id()).alias("h"))
    v = cut(v.withColumn("row", F.monotonically_increasing_id()))
    shards = max(1, -(-v.count() // shard_rows))
    points = v.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(0).alias("is_query"), "vec_id", "row", "q", F.lit(None).cast("bigint").alias("kth"))
    queries = v.where(query_filter)
    run = _searcher(k)

    def search(asked: DataFrame) -> DataFrame:
        rows = points.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "dim", "is_query")
        return rows.mapInArrow(run, "query_id bigint, row bigint, vec_id bigint, score bigint")

    home = F.pmod("h", F.lit(shards)).cast("int")
    first = cut(search(queries.select(home.alias("shard"), "dim", F.lit(1).alias("is_query"), "vec_id", "row", "q", F.lit(None).cast("bigint").alias("kth"))))
    found = first
    if shards > 1:
        kth = first.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home))
        asked = queries.join(kth, "row", "left").select(others.alias("shard"), "dim", F.lit(1).alias("is_query"), "vec_id", "row", "q", "kth")
        found = first.unionByName(search(asked))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
