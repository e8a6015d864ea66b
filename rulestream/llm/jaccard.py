"""Exact n-gram Jaccard join by count vectors and R-trees (operator 3).

A document is its set of distinct 5-word shingles (64-bit hashes).  Shingles are hashed into ``GROUPS`` groups, and a
document's group counts are a point.  The overlap of two sets is at most the sum over groups of the smaller count, and
over a box of points at most that sum against the box's upper corner: an R-tree over the points finds all documents
whose bound reaches the overlap that the threshold needs.  Larger sets have more groups; the tree holds the vectors folded to
``GROUPS``, its results are bounded once more by the unfolded ones, and verified on the sets themselves.

Distribution without loss: linked sets share one of the first ``n - ceil(t n) + 1`` shingles of any fixed order, so each
of these is a bucket.  The order puts frequent shingles last (frequencies from a sketch of 2**16 counters over all
documents), so passages and lines that very many documents share make no buckets.  Equal sets are one point.

Large buckets never make all pairs.  First every set of a bucket meets the bucket's smallest set only; pairs that pass
the count bound are verified, and components are formed.  Buckets whose other members then lie in one component need no more;
the rest, of which buckets with the same members count once, meets one more member each, drawn by a hash so that
buckets of one group try different ones, in the same way.  What still lies in several components is dealt to tasks as
pairs of blocks of ``BLOCK_ROWS`` points.  A task builds the R-tree of one block, searches it for the points of the other, and returns surviving pairs
of different components, which are verified too.  So no link between different components is lost.  A pair that meets in
several buckets is returned by the smallest one: each point knows its ``OTHERS`` smallest buckets, and a bucket leaves a pair
to a smaller one that both points know (pairs whose common buckets lie beyond those come several times, and count once).

Only documents of pairs that pass the bounds are read again, by a bitmap of fixed size over their ids and an exact
join behind it.  A set travels to verification once per partner; the partner's set is sent once per ``SALT_ROWS`` of them.

Null or wordless texts are empty sets and linked with nothing; null ids are kept and linked with nothing; rows that
share an id are one document for linking, each with its own set size (``keep_one`` takes them one by one).  Texts are
read whole, however long; an empty table gives no rows.  Other columns are not carried, whatever their names;
``keep_one`` keeps them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rulestream.llm.common import cut, mix64
from rulestream.llm.graph import components
from rulestream.llm.words import shingles, words_of

GROUPS = 64
SKETCH_BITS = 16
BLOCK_ROWS = 2048
SALT_ROWS = 256
LEAF = 32
OTHERS = 64
FILTER_BITS = 20
PERCENT = 80


def _sketch(documents: DataFrame) -> np.ndarray:
    """Documents' shingles by the top bits of their hash: 2**SKETCH_BITS counters, whatever the input's size."""

    def run(it):
        n = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in it:
            for _, _, w in words_of(batch.column(0)):
                n += np.bincount((np.concatenate(shingles(w)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        at = np.flatnonzero(n)
        for a in range(0, len(at), 8192):
            yield pa.record_batch([pa.array(at[a:a + 8192]), pa.array(n[at[a:a + 8192]])], names=["b", "n"])

    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in documents.select("text").mapInArrow(run, "b bigint, n bigint").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r.b] = r.n
    return out


def _levels(counts: np.ndarray) -> np.ndarray:
    """How far each counter stands out: 0 up to about the usual count, then one level per doubling."""
    usual = max(1.0, float(np.median(counts))) + 4 * np.sqrt(max(1.0, float(np.median(counts))))
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / usual)), 0, 62).astype(np.uint64)


def set_id(s: np.ndarray) -> int:
    """Order-free fingerprint of a set of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = mix64(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64) + np.uint64(len(s)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix64(np.array([x], np.uint64)).view(np.int64)[0])


def _groups(n: int) -> int:
    """Groups of a set of n shingles: ``GROUPS``, or the power of two over n, so that about one falls into each."""
    return max(GROUPS, 1 << n.bit_length())


def count_vector(s: np.ndarray) -> np.ndarray:
    """Counts by group, in the narrowest type that holds them."""
    v = np.bincount((s & np.uint64(_groups(len(s)) - 1)).astype(np.int64), minlength=_groups(len(s)))
    return v.astype("u1" if v.max() < 1 << 8 else "<u2" if v.max() < 1 << 16 else "<u4")


def _vector(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // _groups(n)}")


def fold(v: np.ndarray, groups: int) -> np.ndarray:
    """The coarser vector: groups that are equal modulo ``groups`` are one."""
    return v.reshape(-1, groups).sum(0, dtype=np.int64)


def may_link(v: np.ndarray, n: int, w: np.ndarray, m: int, percent: int = PERCENT) -> bool:
    """Whether the sum of coordinate minima reaches the overlap that sets of sizes n and m need."""
    if n * 100 < m * percent or m * 100 < n * percent:
        return False
    groups = min(len(v), len(w))
    bound = int(np.minimum(v if len(v) == groups else fold(v, groups), w if len(w) == groups else fold(w, groups)).sum())
    return bound * (100 + percent) >= percent * (n + m)


def minima(vs: list[np.ndarray], q: np.ndarray, ws: list[np.ndarray], p: np.ndarray) -> np.ndarray:
    """The sum of coordinate minima of vs[q] and ws[p] for pairs (q, p), each at the coarser one's groups."""
    groups = np.minimum(np.array([len(v) for v in vs])[q], np.array([len(w) for w in ws])[p]) if len(q) else q
    out = np.zeros(len(q), np.int64)
    for g in np.unique(groups).tolist():
        at = np.flatnonzero(groups == g)
        step = max(1, (1 << 20) // g)
        for k in range(0, len(at), step):
            some = at[k:k + step]
            x, xi = np.unique(q[some], return_inverse=True)
            y, yi = np.unique(p[some], return_inverse=True)
            a, b = np.array([fold(vs[i], g) for i in x]), np.array([fold(ws[j], g) for j in y])
            out[some] = np.minimum(a[xi], b[yi]).sum(1)
    return out


def prefix(s: np.ndarray, levels: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles in the order (level, hash)."""
    n = len(s)
    size = n - -(-n * percent // 100) + 1
    order = (levels[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] << np.uint64(58)) | (s * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(6))
    return s[np.argpartition(order, size - 1)[:size]] if size < n else s


def _features(levels: np.ndarray, percent: int):
    def run(it):
        for batch in it:
            n, sid, keys, counts = [], [], [], []
            for _, _, w in words_of(batch.column(1)):
                for s in shingles(w):
                    n.append(len(s))
                    sid.append(set_id(s) if len(s) else None)
                    keys.append(prefix(s, levels, percent).view(np.int64) if len(s) else None)
                    counts.append(count_vector(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(counts, pa.binary())], names=["id", "n", "sid", "keys", "counts"])

    return run


class RTree:
    """Bulk-loaded binary R-tree over count vectors: boxes' upper corners and the range of set sizes, level by level."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order, parts = np.arange(len(points)), [(0, len(points))]
        while any(b - a > LEAF for a, b in parts):
            new = []
            for a, b in parts:
                if b - a <= LEAF:
                    new.append((a, b))
                    continue
                rows = order[a:b]
                spread = points[rows].max(0) - points[rows].min(0)
                axis = sizes[rows] if sizes[rows].max() - sizes[rows].min() > spread.max() else points[rows, int(np.argmax(spread))]
                order[a:b] = rows[np.argsort(axis, kind="stable")]
                new += [(a, (a + b) // 2), ((a + b) // 2, b)]
            parts = new
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        level = [(a, b, self.points[a:b].max(0), self.sizes[a:b].min(), self.sizes[a:b].max()) for a, b in parts]
        self.levels = [level]
        while len(level) > 1:
            level = [(x[0][0], x[-1][1], np.maximum.reduce([y[2] for y in x]), min(y[3] for y in x), max(y[4] for y in x)) for x in (level[k:k + 2] for k in range(0, len(level), 2))]
            self.levels.append(level)

    def search(self, queries: np.ndarray, sizes: np.ndarray, percent: int = PERCENT):
        """(query, point) of all pairs whose summed coordinate minima reach the needed overlap."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            high, low_n, high_n = np.array([x[2] for x in level]), np.array([x[3] for x in level]), np.array([x[4] for x in level])
            keep = self._fits(queries, sizes, q, high, low_n, node, percent)
            keep &= (high_n[node] * 100 >= sizes[q] * percent) & (low_n[node] * percent <= sizes[q] * 100)
            q, node = q[keep], node[keep]
            if depth:
                both = len(self.levels[depth - 1])
                q, node = np.repeat(q, 2), (np.repeat(node * 2, 2) + np.tile([0, 1], len(node)))
                real = node < both
                q, node = q[real], node[real]
        leaf = self.levels[0]
        first, last = np.array([x[0] for x in leaf]), np.array([x[1] for x in leaf])
        count = last[node] - first[node]
        q, p = np.repeat(q, count), np.repeat(first[node] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        keep = (self.sizes[p] * 100 >= sizes[q] * percent) & (self.sizes[p] * percent <= sizes[q] * 100)
        q, p = q[keep], p[keep]
        keep = self._fits(queries, sizes, q, self.points, self.sizes, p, percent)
        return q[keep], self.order[p[keep]]

    @staticmethod
    def _fits(queries, sizes, q, corner, smallest, node, percent) -> np.ndarray:
        out = np.zeros(len(q), bool)
        for a in range(0, len(q), 1 << 14):
            x, y = q[a:a + (1 << 14)], node[a:a + (1 << 14)]
            bound = np.minimum(queries[x], corner[y]).sum(1)
            out[a:a + (1 << 14)] = bound * (100 + percent) >= percent * (sizes[x] + smallest[y])
        return out


def _search_blocks(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(key, home, other):
        if not home:
            return
        before = [{k for k in r[4] if k < key} for r in home]
        ybefore = [{k for k in r[4] if k < key} for r in other] if other else before
        sid, comp, n = (np.array(c) for c in list(zip(*home))[:3])
        fine = [_vector(r[3], r[2]) for r in home]
        points = np.array([fold(v, GROUPS) for v in fine])
        ysid, ycomp, yn, yfine, ypoints = sid, comp, n, fine, points
        if other:
            ysid, ycomp, yn = (np.array(c) for c in list(zip(*other))[:3])
            yfine = [_vector(r[3], r[2]) for r in other]
            ypoints = np.array([fold(v, GROUPS) for v in yfine])
        tree = RTree(ypoints, yn)
        for lo in range(0, len(sid), 256):
            q, p = tree.search(points[lo:lo + 256], n[lo:lo + 256], percent)
            q = q + lo
            keep = comp[q] != ycomp[p]
            if not other:
                keep &= sid[q] < ysid[p]
            q, p = q[keep], p[keep]
            here = np.fromiter((before[x].isdisjoint(ybefore[y]) for x, y in zip(q.tolist(), p.tolist())), bool, len(q))
            q, p = q[here], p[here]
            fits = minima(fine, q, yfine, p) * (100 + percent) >= percent * (n[q] + yn[p])
            if fits.any():
                x, y = sid[q[fits]], ysid[p[fits]]
                yield pa.record_batch([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], schema=schema)

    def run(it):
        now, home, other = None, [], []
        for batch in it:
            for key, i, j, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (key, i, j):
                    if now is not None:
                        yield from task(now[0], home, other)
                    now, home, other = (key, i, j), [], []
                (other if side else home).append(row)
        if now is not None:
            yield from task(now[0], home, other)

    return run


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (2**FILTER_BITS bits) in which every id's bit is set; others' are set by chance."""

    def run(it):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in it:
            bits[_bit(batch.column(0).to_numpy())] = True
        yield pa.record_batch([pa.array([np.packbits(bits).tobytes()])], names=["bits"])

    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for r in ids.repartition(8).mapInArrow(run, "bits binary").collect():
        out |= np.frombuffer(r.bits, np.uint8)
    return out


def _sets(bitmap: np.ndarray):
    """(sid, set) of the documents whose id may be wanted."""

    def run(it):
        wanted = np.unpackbits(bitmap).astype(bool)
        for batch in it:
            some = pc.fill_null(batch.column(1).filter(pa.array(wanted[_bit(batch.column(0).to_numpy())])), "")
            for _, _, w in words_of(some):
                sets = [s for s in shingles(w) if len(s)]
                for k in range(0, len(sets), 512):
                    part = sets[k:k + 512]
                    yield pa.record_batch([pa.array([set_id(s) for s in part], pa.int64()), pa.array([s.tobytes() for s in part], pa.binary())], names=["sid", "s"])

    return run


def _verify(percent: int):
    def run(it):
        now, base, done = None, None, set()
        for batch in it:
            out = []
            for b, salt, side, a, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (b, salt):
                    now, base, done = (b, salt), None, set()
                if side == 0:
                    base = np.frombuffer(raw, np.uint64)
                elif base is not None and a not in done:
                    done.add(a)
                    s = np.frombuffer(raw, np.uint64)
                    at = np.minimum(np.searchsorted(base, s), len(base) - 1)
                    common = int((base[at] == s).sum())
                    if 100 * common >= percent * (len(s) + len(base) - common):
                        out.append((a, b))
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose sets are similar.  Equal sets under several ids are sent once per id at most."""
    spread = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("spread"))
    to = pairs.join(spread, "b").select(F.col("a").alias("sid"), "b", F.pmod(F.xxhash64("a"), F.col("spread")).cast("int").alias("salt"), F.lit(1).alias("side"))
    own = spread.select(F.col("b").alias("sid"), "b", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("salt"), F.lit(0).alias("side"))
    roles = to.unionByName(own)
    ids = roles.select("sid").distinct().join(sets.select("sid", "id"), "sid").select("id")
    found = docs.where("id is not null").mapInArrow(_sets(_id_filter(ids)), "sid bigint, s binary")
    dealt = found.join(roles, "sid").select("b", "salt", "side", F.col("sid").alias("a"), "s").repartition("b", "salt").sortWithinPartitions("b", "salt", "side")
    return dealt.mapInArrow(_verify(percent), "a bigint, b bigint")


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and summed coordinate minima allow the threshold."""

    def run(it):
        for batch in it:
            a, b, n, m, v, w = (c.to_pylist() for c in batch.columns)
            keep = [may_link(_vector(x, i), i, _vector(y, j), j, percent) for i, j, x, y in zip(n, m, v, w)]
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    p = pairs.join(sets.select(F.col("sid").alias("a"), F.col("n").alias("na")), "a").join(sets.select(F.col("sid").alias("b"), F.col("n").alias("nb")), "b")
    p = p.where((F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent))
    p = p.join(sets.select(F.col("sid").alias("a"), F.col("counts").alias("ca")), "a").join(sets.select(F.col("sid").alias("b"), F.col("counts").alias("cb")), "b")
    return p.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a bigint, b bigint")


def _stars(comp: DataFrame) -> DataFrame:
    """Components as links (a, b) again, each member with its smallest."""
    return comp.where("id != component_id").select(F.col("id").alias("a"), F.col("component_id").alias("b"))


def _open(shared: DataFrame, comp: DataFrame, block_rows: int) -> DataFrame:
    """Members (key, sid, comp, block, blocks) of buckets over several components; of equal buckets, one."""
    member = shared.select("key", "sid").join(comp.withColumnRenamed("id", "sid"), "sid", "left").select("key", "sid", F.coalesce("component_id", "sid").alias("comp"))
    open_ = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("sig")).where("lo != hi")
    open_ = open_.groupBy("m", "sig", "lo", "hi").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("m") / block_rows).cast("int").alias("blocks"))
    return member.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))


def _joined(docs: DataFrame, percent: int, block_rows: int, link_ids: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features of the rows, distinct sets, components of sets); with ``link_ids`` the sets of one id are linked too."""
    levels = _levels(_sketch(docs))
    feats = cut(docs.mapInArrow(_features(levels, percent), "id bigint, n bigint, sid bigint, keys array<bigint>, counts binary"))
    own = feats.where("id is not null and sid is not null")
    sets = cut(own.groupBy("sid").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("counts").alias("counts")))
    keys = own.select("sid", F.explode("keys").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("sid").alias("hub"), F.max("sid").alias("top")).where("hub < top").select("key", "hub")
    shared = cut(keys.join(hubs, "key").where("sid != hub").select("key", "sid", "hub").distinct())
    first = cut(_bounded(shared.select(F.col("sid").alias("a"), F.col("hub").alias("b")).distinct(), sets, percent))
    links = cut(_verified(first, sets, docs, percent))
    same_id = own.groupBy("id").agg(F.min("sid").alias("a"), F.max("sid").alias("b"), F.collect_set("sid").alias("all")).where("a < b").select(F.explode("all").alias("a"), "b").where("a != b")
    comp = cut(components(links.unionByName(same_id) if link_ids else links))
    rest = cut(_open(shared, comp, block_rows))
    if not rest.isEmpty():
        second = rest.groupBy("key").agg(F.min_by(F.struct("sid", "comp"), F.xxhash64("sid", "key")).alias("h")).select("key", F.col("h.sid").alias("hub"), F.col("h.comp").alias("hub_comp"))
        met = cut(rest.select("key", "sid", "comp").join(second, "key").where("sid != hub"))
        again = cut(_bounded(met.where("comp != hub_comp").select(F.col("sid").alias("a"), F.col("hub").alias("b")).distinct(), sets, percent))
        comp = cut(components(_stars(comp).unionByName(_verified(again, sets, docs, percent))))
        rest = cut(_open(met, comp, block_rows))
    if not rest.isEmpty():
        others = rest.groupBy("sid").agg(F.slice(F.sort_array(F.collect_list("key")), 1, OTHERS).alias("others"))
        points = rest.join(sets.select("sid", "n", "counts"), "sid").join(others, "sid")
        ahead = points.withColumn("j", F.explode(F.sequence("block", F.col("blocks") - 1))).select("key", F.col("block").alias("i"), "j", F.lit(0).alias("side"), "sid", "comp", "n", "counts", "others")
        behind = points.where("block > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("block") - 1))).select("key", "i", F.col("block").alias("j"), F.lit(1).alias("side"), "sid", "comp", "n", "counts", "others")
        tasks = ahead.unionByName(behind).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
        more = cut(tasks.mapInArrow(_search_blocks(percent), "a bigint, b bigint").distinct())
        comp = cut(components(_stars(comp).unionByName(_verified(more, sets, docs, percent))))
    return feats, sets, comp


def similar_documents(documents: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_shingles, component_id), one row per input row."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    feats, sets, comp = _joined(docs, percent, block_rows, True)
    least = comp.join(sets.select(F.col("sid").alias("id"), F.col("id").alias("doc")), "id").groupBy("component_id").agg(F.min("doc").alias("doc"))
    of_set = sets.select("sid", "id").join(comp.select(F.col("id").alias("sid"), "component_id"), "sid", "left").join(least, "component_id", "left").select("sid", F.coalesce("doc", "id").alias("component_id"))
    out = feats.select("id", "n", "sid").join(of_set, "sid", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _fresh(names: list[str], stem: str) -> str:
    """A column name that is not taken, in any case."""
    while stem in {n.lower() for n in names}:
        stem += "_"
    return stem


def _with_set_ids(documents: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """All columns, and the id of the row's shingle set (null: empty)."""
    at = documents.columns.index(text_col)

    def run(it):
        for batch in it:
            sid = [set_id(s) if len(s) else None for _, _, w in words_of(batch.column(at)) for s in shingles(w)]
            yield pa.record_batch([*batch.columns, pa.array(sid, pa.int64())], names=[*batch.schema.names, name])

    return documents.mapInArrow(run, documents.select("*", F.lit(None).cast("bigint").alias(name)).schema)


def keep_one(documents: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of similar rows the row of the smallest id (of that id's rows the longest text), with its columns.

    Only similarity makes groups: rows that share an id but hold different texts are kept or dropped each by its own
    text.  Rows without words go only if their id has another such row; null ids stay.
    """
    names = documents.columns
    sid, comp_, first_, n_, id_ = (_fresh(names, x) for x in ("sid", "comp", "first", "number", "own_id"))
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    feats, sets, comp = _joined(docs, percent, BLOCK_ROWS, False)
    of_set = sets.select("sid").join(comp.withColumnRenamed("id", "sid"), "sid", "left").select("sid", F.coalesce("component_id", "sid").alias("comp"))
    rows = feats.where("id is not null").select("id", "sid")
    placed = rows.where("sid is not null").distinct().join(of_set, "sid")
    gone = placed.join(placed.groupBy("comp").agg(F.min("id").alias("least")), "comp").where("id != least")
    gone = cut(gone.select(F.col("id").alias(id_), F.col("sid").alias(sid)))
    repeated = cut(rows.groupBy("id").count().where("count > 1").select(F.col("id").alias(id_)))
    own = F.col(id_col).cast("bigint") == F.col(id_)
    if repeated.isEmpty():
        return documents.join(gone.select(id_).distinct(), own, "left_anti")
    single = documents.join(repeated, own, "left_anti").join(gone.select(id_).distinct(), own, "left_anti")
    several = _with_set_ids(documents.join(repeated, own, "left_semi"), id_col, text_col, sid)
    left = several.join(gone.withColumnRenamed(sid, first_), own & (F.col(sid) == F.col(first_)), "left_anti")
    left = left.join(of_set.select(F.col("sid").alias(first_), F.col("comp").alias(comp_)), F.col(sid) == F.col(first_), "left")
    number = F.row_number().over(Window.partitionBy(F.col(id_col).cast("bigint"), comp_).orderBy(F.length(text_col).desc_nulls_last(), text_col))
    return single.unionByName(left.withColumn(n_, number).where(F.col(n_) == 1).select(names))
