"""Ranked lexical search by hashed max-sketches (operator 13).

Every document's impacts (the whole-number share of each of its terms in a score) fold into a sketch of ``WIDTH`` cells:
a term hashes to a cell, and a cell keeps the largest impact of its terms.  A query looks its terms' cells up, for a
batch of documents at a time: the sum is at least the document's score.  Documents are then scored exactly in the order
of falling bounds, until the bound is below the score that a document needs: the kth so far, or the kth score that
another pass has shown to be reached.

The work on Spark: one pass over the documents counts N, L and the document frequency of each term that a query asks
for (partial counts per task, then a shuffle of term counts).  A second pass searches the documents whose ids hash into
the first of ``PARTS`` parts, and the kth score of each query there is a lower limit for the whole table; a third pass
searches the others with that limit, so that the rows that leave a task are those that can still enter the result, and
their number grows with the queries and not with the tasks.  Documents are read where they lie; no text is shuffled.

Queries are taken in blocks of at most ``BLOCK_TERMS`` distinct (query, term) rows, cut along the query table's row
order; a block's terms and frequencies are the only data that pass through the driver and to the tasks.  A query of
more terms than that is a block of its own (a term is at most once in a query).

Terms are the maximal stretches of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case.  Null
and empty texts have no terms: they do not count in N and are never returned; an item without terms returns nothing, and
so do empty tables.  Texts are read whole, however long.  Equal scores go by ascending id, null ids last.  Repeated rows
are documents (or items) of their own; items of one id and text give the same rows each.  Other columns are not carried,
whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rulestream.llm.common import cut, slices, string_buffer

K = 50
WIDTH = 1024
PARTS = 16
CHUNK_DOCS = 512
CHUNK_BYTES = 4 << 20
SLICE = 1 << 20
BLOCK_TERMS = 1 << 16
STEP = 64
OUT_ROWS = 1 << 16

_TERM_BYTES = bytearray(b" " * 128) + bytearray(range(128, 256))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TERM_BYTES[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TERM_BYTES[_c] = _c + 32
_TERM_BYTES = bytes(_TERM_BYTES)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(w, tf, m):
    """A term's share of a score; works on whole numbers and on int64 arrays."""
    return w * ((1000000000 * tf) // (1000 * tf + 20 * m))


def length_factor(n, n_docs: int, total: int):
    return 100 - 50 + (50 * n * n_docs) // total


def _slices(text: bytes):
    """The translated text in slices of about ``SLICE`` bytes, cut between terms."""
    text = text.translate(_TERM_BYTES)
    at = 0
    while len(text) - at > SLICE:
        end = text.find(b" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def count_terms(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """(terms of the text with repeats, occurrences of those in the vocabulary); memory is bound by slices of the text."""
    n, found = 0, Counter()
    for part in _slices(text):
        terms = part.split()
        n += len(terms)
        found.update(filter(vocabulary.__contains__, terms))
    return n, found


def _texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every row, null as empty."""
    data, offsets = string_buffer(col)
    return [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query row, item id, term): the distinct terms of every query."""
    rows = queries.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())

    def run(it):
        for batch in it:
            out = [(row, item, t) for row, item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2)))
                   for t in sorted({x for part in _slices(text) for x in part.split()})]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], names=["row", "item_id", "term"])

    return cut(rows.select("row", "item_id", "text").mapInArrow(run, "row bigint, item_id bigint, term binary"))


def _ranges(it):
    """Ranges of consecutive query rows of at most ``BLOCK_TERMS`` terms, from (row, terms) in order."""
    first, last, held = None, None, 0
    out = []
    for batch in it:
        for row, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if first is not None and held + n > BLOCK_TERMS:
                out.append((first, last))
                first, held = None, 0
            first, last, held = (row if first is None else first), row, held + n
    if first is not None:
        out.append((first, last))
    yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["first", "last"])


def _blocks(terms: DataFrame) -> list[tuple[int, int]]:
    """Ranges of query rows, one per block: two numbers per ``BLOCK_TERMS`` terms reach the driver."""
    n, first, last = terms.agg(F.count("*"), F.min("row"), F.max("row")).first()
    if n <= BLOCK_TERMS:
        return [(first, last)] if n else []
    sizes = terms.groupBy("row").count().repartitionByRange(n // BLOCK_TERMS, "row").sortWithinPartitions("row")
    return [(r["first"], r["last"]) for r in sizes.mapInArrow(_ranges, "first bigint, last bigint").collect()]


class Queries:
    """A block of queries: its vocabulary, and each query's terms, as numbers."""

    def __init__(self, rows):
        self.vocabulary = {t: n for n, t in enumerate(sorted({bytes(r.term) for r in rows}))}
        by = {}
        for r in rows:
            by.setdefault((r.row, r.item_id), []).append(self.vocabulary[bytes(r.term)])
        self.keys = sorted(by, key=lambda x: x[0])
        self.terms = [np.array(sorted(by[x])) for x in self.keys]
        self.cell = np.array([zlib.crc32(t) % WIDTH for t in self.vocabulary], np.int64)

    def lookup(self) -> np.ndarray:
        """(cell, query): how many of the query's terms lie in the cell."""
        m = np.zeros((WIDTH, len(self.keys)))
        for j, t in enumerate(self.terms):
            np.add.at(m[:, j], self.cell[t], 1.0)
        return m


def _statistics(documents: DataFrame, q: Queries) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every term of the block, over all documents."""
    vocabulary = q.vocabulary

    def run(it):
        df, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in it:
            for text in _texts(batch.column(1)):
                n, found = count_terms(text, vocabulary)
                docs, total = docs + (n > 0), total + n
                if found:
                    df[[vocabulary[t] for t in found]] += 1
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([docs, total, *df[at].tolist()], pa.int64())], names=["what", "n"])

    got = {r["what"]: r["n"] for r in documents.mapInArrow(run, "what bigint, n bigint").groupBy("what").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in got.items():
        if t >= 0:
            df[t] = n
    return got.get(-2, 0), got.get(-1, 0), df


class Chunk:
    """Some documents: their (document, term, impact) entries and their sketches."""

    def __init__(self, texts, q: Queries, weights: np.ndarray, n_docs: int, total: int):
        docs, terms, tf, m = [], [], [], np.ones(len(texts), np.int64)
        for d, text in enumerate(texts):
            n, found = count_terms(text, q.vocabulary)
            m[d] = length_factor(n, n_docs, total)
            docs += [d] * len(found)
            terms += [q.vocabulary[t] for t in found]
            tf += found.values()
        self.doc, self.term = np.array(docs, np.int64), np.array(terms, np.int64)
        self.impact = impact(weights[self.term], np.array(tf, np.int64), m[self.doc])
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.sketch = np.zeros((len(texts), WIDTH))
        np.maximum.at(self.sketch, (self.doc, q.cell[self.term]), self.impact.astype(float))

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for the query whose terms ``wanted`` marks."""
        size = self.first[docs + 1] - self.first[docs]
        base = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[docs] - base, size)
        hit = wanted[self.term[at]]
        owner = np.repeat(np.arange(len(docs)), size)[hit]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, owner, self.impact[at[hit]])
        return out


class Ranking:
    """The best ``k`` documents of each query so far, and the score that another must reach."""

    def __init__(self, n: int, k: int, limits: np.ndarray):
        self.k, self.limit = k, np.maximum(limits, 1)
        self.best = [[] for _ in range(n)]

    def add(self, j: int, ids, scores) -> None:
        best = self.best[j] + [(-int(s), i is None, i or 0) for i, s in zip(ids, scores)]
        best.sort()
        self.best[j] = best[:self.k]
        if len(best) >= self.k:
            self.limit[j] = max(self.limit[j], -self.best[j][-1][0])


def search_chunk(chunk: Chunk, ids: list, q: Queries, lookup: np.ndarray, ranking: Ranking) -> int:
    """Score the chunk's documents by falling bounds, query by query; returns how many pairs were scored."""
    bounds = (chunk.sketch @ lookup) * (1 + 1e-12)
    wanted = np.zeros(len(q.vocabulary), bool)
    scored = 0
    for j in np.flatnonzero((bounds >= ranking.limit).any(axis=0)):
        order = np.argsort(-bounds[:, j], kind="stable")
        wanted[q.terms[j]] = True
        for a in range(0, len(order), STEP):
            docs = order[a:a + STEP]
            docs = docs[bounds[docs, j] >= ranking.limit[j]]
            if not len(docs):
                break
            score = chunk.scores(docs, wanted)
            scored += len(docs)
            good = score >= ranking.limit[j]
            if good.any():
                ranking.add(j, [ids[d] for d in docs[good]], score[good])
        wanted[q.terms[j]] = False
    return scored


def _searcher(q: Queries, weights: np.ndarray, n_docs: int, total: int, limits: np.ndarray, k: int):
    schema = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(it):
        lookup, ranking = q.lookup(), Ranking(len(q.keys), k, limits)
        for batch in it:
            ids, texts = batch.column(0).to_pylist(), _texts(batch.column(1))
            for a, b in slices(len(ids), np.array([len(t) + CHUNK_BYTES // CHUNK_DOCS for t in texts]), CHUNK_BYTES):
                search_chunk(Chunk(texts[a:b], q, weights, n_docs, total), ids[a:b], q, lookup, ranking)
        found = [(row, item, None if null else i, -s) for (row, item), best in zip(q.keys, ranking.best) for s, null, i in best]
        for a in range(0, len(found), OUT_ROWS):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found[a:a + OUT_ROWS])], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rank_documents(documents: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every query, scores above 0 alone."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    terms = query_terms(queries, query_id_col, query_text_col)
    blocks = _blocks(terms)
    first_part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0
    schema = "row bigint, item_id bigint, doc_id bigint, score bigint"
    results = []
    for block in blocks:
        q = Queries(terms.where(F.col("row").between(*block)).collect())
        n_docs, total, df = _statistics(docs, q)
        if not n_docs:
            break
        weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
        none = np.zeros(len(q.keys), np.int64)
        head = cut(docs.where(first_part).mapInArrow(_searcher(q, weights, n_docs, total, none, k), schema))
        reached = {r["row"]: r["score"] for r in _best(head, k).where(F.col("rank") == k).select("row", "score").collect()}
        limits = np.array([reached.get(row, 0) for row, _ in q.keys], np.int64)
        rest = docs.where(~first_part).mapInArrow(_searcher(q, weights, n_docs, total, limits, k), schema)
        results.append(_best(head.unionByName(rest), k).select("item_id", "rank", "doc_id", "score"))
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, results)
