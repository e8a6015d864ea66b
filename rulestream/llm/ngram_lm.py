"""Language-model scoring with an Elias-Fano n-gram trie (operator 9).

Tokens are a document's words (A-Z lower-cased) and one end token; the end token also stands before the first word.  The
model is a bigram model with absolute discounting, interpolated with unigram probabilities.  Its n-grams are sharded by
context, and each shard is one trie: level 1 holds the contexts with their backoff weights, level 2 the successors.  The
pointers from level 1 into level 2 and the successors (made increasing by adding the context's base) are Elias-Fano
sequences, weights and probabilities are quantised to 256 values each, and all levels lie in one memory map.  A
successor is looked up relative to its context: its base plus the word's rank, by Elias-Fano successor search.

Distribution: one pass counts words (partial counts per batch, then one aggregation) and gives N, V and a table of the most
frequent words, at most ``TOP_WORDS`` of them whatever the input's size.  The counts of the other words reach the shards
that ask for them by a join of the distinct (shard, word) with all words' counts.  Another pass deals every token, with its
successor, to the shard of its context; frequent contexts are split by successor into parts of about ``SPLIT_TOKENS``
tokens, so no shard holds a frequent word alone.  A shard counts its n-grams from the training documents, builds the trie,
scores all documents' tokens and returns sums per document, which are added up.  Counts of n-grams and words are over all
training documents.

The unigram that bigrams back off to is exact for all words, by their full hashes.  A split context's distinct successors
are counted over all its parts beforehand.  ``base_score`` is exact.

Null texts are empty: one end token.  Repeated rows are scored as often as they occur (and learned from as often).  Rows with a null
id are in the training part of no fold and are scored.  Without training documents every score is the uniform model's.
"""

from __future__ import annotations

import mmap

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import crc32_mod, cut, mix64
from rulestream.llm.words import words_of

TOP_WORDS = 1 << 18
SHARD_TOKENS = 1_500_000
SPLIT_TOKENS = 200_000
BUCKET_TOKENS = 6_000_000
HOLD_PAIRS = 1 << 20
DISCOUNT = 0.75
ADD = 0.1
ROWS = 16384
END = np.uint64(0x5BD1E9955BD1E995)
_PART = np.uint64(0xC2B2AE3D27D4EB4F)


class EliasFano:
    """Non-decreasing whole numbers: low bits as they are, high bits in unary.  ``put`` places each array in the memory map."""

    def __init__(self, values: np.ndarray, universe: int, put):
        n = len(values)
        self.n, self.shift = n, max(0, int(universe // max(1, n)).bit_length() - 1)
        low = values & ((1 << self.shift) - 1)
        self.low = put(low.astype(np.uint8 if self.shift <= 8 else np.uint16 if self.shift <= 16 else np.uint32 if self.shift <= 32 else np.uint64))
        bits = np.zeros(n + (int(universe) >> self.shift) + 2, np.uint8)
        bits[(values >> self.shift) + np.arange(n)] = 1
        self.size = len(bits)
        self.high = put(np.packbits(bits))

    def _bits(self) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self.high, np.uint8), count=self.size)

    def get(self) -> np.ndarray:
        """All values."""
        return ((np.flatnonzero(self._bits()) - np.arange(self.n)) << self.shift) | self.low.astype(np.int64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value >= x, by bucket of the high bits and then along the bucket's low bits."""
        zeros = np.flatnonzero(self._bits() == 0)
        bucket, want = x >> self.shift, x & ((1 << self.shift) - 1)
        low, high = np.where(bucket > 0, zeros[np.maximum(bucket, 1) - 1] + 1 - bucket, 0), zeros[bucket] - bucket
        while True:
            go = np.flatnonzero(low < high)
            if not len(go):
                return low
            mid = (low[go] + high[go]) >> 1
            less = self.low[mid] < want[go]
            low[go[less]] = mid[less] + 1
            high[go[~less]] = mid[~less]

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each x, or -1."""
        if not self.n:
            return np.full(len(x), -1)
        at = self.successor(x)
        values = self.get()
        return np.where((at < self.n) & (values[np.minimum(at, self.n - 1)] == x), at, -1)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, 256 values): equally filled bins, each stands for its mean."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(256)
    edges = np.unique(np.quantile(x, np.linspace(0, 1, 257)[1:-1]))
    codes = np.searchsorted(edges, x, side="right")
    total, n = np.bincount(codes, x, 256), np.bincount(codes, minlength=256)
    return codes.astype(np.uint8), np.where(n > 0, total / np.maximum(1, n), 0)


class Trie:
    """Two levels over the n-grams of a shard, in one anonymous memory map."""

    def __init__(self, contexts: np.ndarray, pointers: np.ndarray, ranks: np.ndarray, words: np.ndarray, backoff: np.ndarray, logp: np.ndarray):
        """contexts: sorted keys; pointers: n + 1 ends into the successors; ranks: their ranks in the sorted ``words``."""
        arrays: list[np.ndarray] = []

        def put(a: np.ndarray) -> np.ndarray:
            arrays.append(a)
            return a

        weight, self.weights = quantise(backoff)
        code, self.values = quantise(logp)
        self.span = max(1, len(words))
        owner = np.repeat(np.arange(len(contexts)), np.diff(pointers))
        parts = {"contexts": put(contexts), "words": put(words), "weight": put(weight), "code": put(code)}
        self.pointers = EliasFano(pointers.astype(np.int64), int(pointers[-1]) + 1, put)
        self.successors = EliasFano(owner * self.span + ranks, max(1, len(contexts)) * self.span, put)
        size = sum(a.nbytes + 8 for a in arrays) + 8
        self.map, at, placed = mmap.mmap(-1, size), 0, {}
        for a in arrays:
            self.map[at:at + a.nbytes] = a.tobytes()
            placed[id(a)] = np.frombuffer(self.map, a.dtype, len(a), at)
            at += (a.nbytes + 7) // 8 * 8
        self.contexts, self.words, self.weight, self.code = (placed[id(parts[k])] for k in ("contexts", "words", "weight", "code"))
        for ef in (self.pointers, self.successors):
            ef.low, ef.high = placed[id(ef.low)], placed[id(ef.high)]

    def lookup(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, log10 probability where found, log10 backoff weight of the context; 0 for an unknown context)."""
        nc, nw = len(self.contexts), len(self.words)
        if not nc or not nw:
            return np.zeros(len(context), bool), np.zeros(len(context)), np.zeros(len(context))
        c = np.minimum(np.searchsorted(self.contexts, context), nc - 1)
        r = np.minimum(np.searchsorted(self.words, word), nw - 1)
        known = self.contexts[c] == context
        ask = np.flatnonzero(known & (self.words[r] == word))
        at = self.successors.find(c[ask].astype(np.int64) * self.span + r[ask])
        ends = self.pointers.get()
        inside = (at >= 0) & (at >= ends[c[ask]]) & (at < ends[c[ask] + 1])
        found, logp = np.zeros(len(context), bool), np.zeros(len(context))
        found[ask[inside]] = True
        logp[ask[inside]] = self.values[self.code[at[inside]]]
        return found, logp, np.where(known, self.weights[self.weight[c]], 0.0)


class Unigrams:
    """Corpus totals, and exact counts of the most frequent words (sorted hashes)."""

    def __init__(self, tokens: int, types: int, words: np.ndarray, counts: np.ndarray, split_tokens: int = SPLIT_TOKENS):
        order = np.argsort(words)
        self.tokens, self.types, self.words, self.counts = tokens, types, words[order], counts[order]
        self.split = np.maximum(1, self.counts // split_tokens)
        self.kinds = np.zeros(len(self.words), np.int64)  # distinct successors, of split contexts

    def denominator(self) -> float:
        return self.tokens + ADD * (self.types + 1)

    def parts(self, words: np.ndarray) -> np.ndarray:
        """Number of parts of each word's context."""
        if not len(self.words):
            return np.ones(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.split[at], 1)

    def log_p(self, words: np.ndarray, rare: np.ndarray, rare_counts: np.ndarray) -> np.ndarray:
        """log10 unigram probability; ``rare``: sorted words that are not in the table, with their counts."""
        count = np.zeros(len(words), np.int64)
        for known, counts in ((self.words, self.counts), (rare, rare_counts)):
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                count = np.where(known[at] == words, counts[at], count)
        return np.log10((count + ADD) / self.denominator())


def _tokens(w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, its successor) over the tokens end, word, ..., word of each row; the last one's successor is the end."""
    n = len(w.first) - 1
    at = w.first[:-1] + np.arange(n)
    token = np.insert(w.hash, w.first[:-1], END)
    row = np.repeat(np.arange(n), np.diff(w.first) + 1)
    nxt = np.empty(len(token), np.uint64)
    nxt[:-1] = token[1:]
    last = at + np.diff(w.first)
    nxt[last] = END
    return row, token, nxt


def _count_words(it):
    for batch in it:
        for _, _, w in words_of(batch.column(0)):
            words, n = np.unique(_tokens(w)[1], return_counts=True)
            yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["w", "c"])


def _distinct(token: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted."""
    order = np.lexsort((nxt, token))
    token, nxt = token[order], nxt[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (nxt[1:] != nxt[:-1])
    return token[new], nxt[new]


def _hot_pairs(uni: Unigrams, buckets: int, hold: int = HOLD_PAIRS):
    """Distinct (split context, successor) of a task, or of about ``hold`` pairs, in one row per bucket of successors: contexts' numbers, run lengths, words."""
    words = uni.words[uni.split > 1]

    def rows(held):
        token, nxt = _distinct(*(np.concatenate(x) for x in zip(*held)))
        bucket = (nxt % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        token, nxt, edges = token[order], nxt[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(edges)):
            t = token[edges[b]:edges[b + 1]]
            head = np.flatnonzero(np.diff(t, prepend=-1))
            out.append((b, t[head].astype("<u4").tobytes(), np.diff(np.append(head, len(t))).astype("<u4").tobytes(), _pack_words(uni, nxt[edges[b]:edges[b + 1]])))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 3))], names=["bucket", "contexts", "runs", "words"])

    def run(it):
        held, n = [], 0
        for batch in it:
            for _, _, w in words_of(batch.column(0)):
                _, token, nxt = _tokens(w)
                at = np.minimum(np.searchsorted(words, token), len(words) - 1)
                hot = words[at] == token
                if not hot.any():
                    continue
                held.append(_distinct(at[hot], nxt[hot]))
                n += len(held[-1][0])
                if n > 2 * hold:
                    held = [_distinct(*(np.concatenate(x) for x in zip(*held)))]
                    n = len(held[0][0])
                    if n > hold:
                        yield rows(held)
                        held, n = [], 0
        if held:
            yield rows(held)

    return run


def _count_kinds(uni: Unigrams):
    """Rows of ``_hot_pairs`` by bucket: (context's number, its distinct successors in the bucket)."""
    def counted(held):
        number, n = np.unique(_distinct(*(np.concatenate(x) for x in zip(*held)))[0], return_counts=True)
        return pa.record_batch([pa.array(number.astype(np.int32)), pa.array(n.astype(np.int64))], names=["number", "n"])

    def run(it):
        now, held = None, []
        for batch in it:
            for bucket, contexts, runs, words in zip(*(c.to_pylist() for c in batch.columns)):
                if held and bucket != now:
                    yield counted(held)
                    held = []
                token = np.repeat(np.frombuffer(contexts, "<u4"), np.frombuffer(runs, "<u4"))
                now = bucket
                held.append((token, _unpack_words(uni, words, len(token))))
        if held:
            yield counted(held)

    return run


def unigrams(training: DataFrame, top: int = TOP_WORDS, split_tokens: int = SPLIT_TOKENS) -> tuple[Unigrams, DataFrame]:
    """Counts over all training texts, of which at most ``top`` words' come to the driver, and the frame (w, c) of all."""
    counts = cut(training.select("text").mapInArrow(_count_words, "w bigint, c bigint").groupBy("w").agg(F.sum("c").alias("c")).withColumn("level", F.floor(F.log2("c") * 8).cast("int")))
    levels = counts.groupBy("level").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    least, total = 1 << 30, 0
    for r in sorted(levels, key=lambda r: -r.level):
        total += r.n
        if total > top:
            break
        least = r.level
    table = counts.where(F.col("level") >= least).select("w", "c").toArrow()
    uni = Unigrams(sum(r.c for r in levels), sum(r.n for r in levels), table.column(0).to_numpy().view(np.uint64).copy(), table.column(1).to_numpy().copy(), split_tokens)
    if (uni.split > 1).any():
        buckets = -(-uni.tokens // BUCKET_TOKENS)
        pairs = training.select("text").mapInArrow(_hot_pairs(uni, buckets), "bucket int, contexts binary, runs binary, words binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
        kinds = pairs.mapInArrow(_count_kinds(uni), "number int, n bigint").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
        uni.kinds[np.flatnonzero(uni.split > 1)[kinds.column(0).to_numpy()]] = kinds.column(1).to_numpy()
    return uni, counts.select("w", "c")


def _place(uni: Unigrams, token: np.ndarray, nxt: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context key, its shard, number of parts of its word) of each token."""
    parts = uni.parts(token)
    part = np.where(parts > 1, mix64(nxt) % parts.astype(np.uint64), np.uint64(0))
    context = mix64(token + part * _PART) if part.any() else mix64(token)
    return context, (context >> np.uint64(20)) % np.uint64(shards), parts


def _ask(uni: Unigrams, shards: int):
    """Distinct (shard, successor) of successors that are not in the table."""
    def run(it):
        for batch in it:
            for _, _, w in words_of(batch.column(0)):
                _, token, nxt = _tokens(w)
                place = np.minimum(np.searchsorted(uni.words, nxt), len(uni.words) - 1)
                rare = uni.words[place] != nxt if len(uni.words) else np.ones(len(nxt), bool)
                token, nxt = token[rare], nxt[rare]
                shard = _place(uni, token, nxt, shards)[1]
                order = np.lexsort((nxt, shard))
                shard, nxt = shard[order], nxt[order]
                new = np.ones(len(nxt), bool)
                new[1:] = (shard[1:] != shard[:-1]) | (nxt[1:] != nxt[:-1])
                yield pa.record_batch([pa.array(shard[new].astype(np.int32)), pa.array(nxt[new].view(np.int64))], names=["shard", "w"])

    return run


def _answer(it):
    """Rows (shard, word, count) by shard: records of chunk -1 with the words and their counts."""
    for batch in it:
        if batch.num_rows:
            shard, words, counts = (c.to_numpy() for c in batch.columns)
            at = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
            rows = [(shard[p], -1, 0, b"", b"", b"", words[p:q].tobytes(), b"", b"", counts[p:q].tobytes(), None) for p, q in zip(at, np.append(at[1:], len(shard)))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 8))], names=_RECORD)


def _pack_words(uni: Unigrams, words: np.ndarray) -> bytes:
    """Words as places in the table, low and high halves apart, then the hashes of those that it lacks."""
    none = len(uni.words)
    place = np.searchsorted(uni.words, words)
    if none:
        place[uni.words[np.minimum(place, none - 1)] != words] = none
    return (place & 0xFFFF).astype("<u2").tobytes() + (place >> 16).astype("<u2").tobytes() + words[place == none].tobytes()


def _unpack_words(uni: Unigrams, raw: bytes, n: int) -> np.ndarray:
    """The ``n`` words of ``_pack_words``."""
    place = np.frombuffer(raw, "<u2", n).astype(np.int64) | np.frombuffer(raw, "<u2", n, 2 * n).astype(np.int64) << 16
    words, rare = np.empty(n, np.uint64), place == len(uni.words)
    words[~rare] = uni.words[place[~rare]]
    words[rare] = np.frombuffer(raw[4 * n:], np.uint64)
    return words


def _deal(uni: Unigrams, shards: int):
    """Records of a chunk of rows by shard: contexts with run lengths, successors, (row, training) marks, multiplicities."""

    def run(it):
        count = TaskContext.get().partitionId() << 33
        for whole in it:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                learn = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                ids = batch.column(0)
                for a, b, w in words_of(batch.column(2)):
                    row, token, nxt = _tokens(w)
                    context, shard, parts = _place(uni, token, nxt, shards)
                    mark = (row * 2 + learn[a:b][row]).astype(np.uint16)
                    order = np.lexsort((mark, nxt, context, shard))
                    shard, context, nxt, mark, token, parts = (x[order] for x in (shard, context, nxt, mark, token, parts))
                    new = np.ones(len(order), bool)
                    new[1:] = (shard[1:] != shard[:-1]) | (context[1:] != context[:-1]) | (nxt[1:] != nxt[:-1]) | (mark[1:] != mark[:-1])
                    at = np.flatnonzero(new)
                    times = np.diff(np.append(at, len(order))).astype(np.uint32)
                    shard, context, nxt, mark, token, parts = (x[at] for x in (shard, context, nxt, mark, token, parts))
                    home = count % shards
                    edges = np.searchsorted(shard, np.arange(shards + 1).astype(np.uint64))
                    table = np.asarray(pc.fill_null(ids.slice(a, b - a), 0).to_numpy(zero_copy_only=False), "<i8").tobytes() + np.packbits(ids.slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)).tobytes()
                    rows = []
                    for s in range(shards):
                        p, q = edges[s], edges[s + 1]
                        if p == q and s != home:
                            continue
                        head = np.flatnonzero(np.diff(context[p:q], prepend=context[p:p + 1] + np.uint64(1)))
                        many = np.flatnonzero(times[p:q] > 1)
                        rows.append((s, count, b - a, np.ascontiguousarray(context[p:q][head]).tobytes(), token[p:q][head][parts[p:q][head] > 1].tobytes(), np.diff(np.append(head, q - p)).astype("<u4").tobytes(), _pack_words(uni, nxt[p:q]), mark[p:q].tobytes(),
                                     many.astype("<u4").tobytes(), times[p:q][many].tobytes(), table if s == home else None))
                    for k in range(0, len(rows), 64):
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 64]), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 8))], names=_RECORD)
                    count += 1

    return run


_RECORD = ["shard", "chunk", "rows", "contexts", "hot", "runs", "words", "marks", "many", "times", "ids"]
_RECORD_DDL = "shard int, chunk bigint, rows int, contexts binary, hot binary, runs binary, words binary, marks binary, many binary, times binary, ids binary"


def _score_shard(uni: Unigrams, records: list):
    """(chunk, rows, sums, ids) of each record batch of one shard: per row with tokens here its base and model log10 sums and counts."""
    answers = [r for r in records if r[1] < 0]
    records = [r for r in records if r[1] >= 0]
    if not records:
        return
    rare = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r[6], np.uint64) for r in answers)])
    rare_counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[9], np.int64) for r in answers)])
    order = np.argsort(rare)
    rare, rare_counts = rare[order], rare_counts[order]
    context = np.concatenate([np.repeat(np.frombuffer(r[3], np.uint64), np.frombuffer(r[5], "<u4")) for r in records])
    nxt = np.concatenate([_unpack_words(uni, r[6], len(r[7]) // 2) for r in records])
    mark = np.concatenate([np.frombuffer(r[7], np.uint16) for r in records])
    size = np.array([len(r[7]) // 2 for r in records])
    first = np.concatenate([[0], np.cumsum(size)])
    times = np.ones(len(mark), np.int64)
    for k, r in enumerate(records):
        times[first[k] + np.frombuffer(r[8], "<u4").astype(np.int64)] = np.frombuffer(r[9], np.uint32)
    order = np.lexsort((nxt, context))
    c, s = context[order], nxt[order]
    new = np.ones(len(order), bool)
    new[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1])
    kind_of = np.empty(len(order), np.int64)
    kind_of[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    c, s = c[at], s[at]
    n = np.bincount(kind_of, times * (mark & 1), len(at)).astype(np.int64)
    head = np.flatnonzero(np.diff(c, prepend=c[:1] + np.uint64(1)))
    owner = np.cumsum(np.diff(c, prepend=c[:1] + np.uint64(1)) != 0) - 1
    keys = c[head]
    total, kinds = np.bincount(owner, n, len(keys)), np.bincount(owner, n > 0, len(keys))
    hot = np.unique(np.concatenate([np.frombuffer(r[4], np.uint64) for r in records]))
    if len(hot):  # split contexts: their totals and distinct successors over all parts stand in the table
        place = np.searchsorted(uni.words, hot)
        for word, count, parts, distinct in zip(hot, uni.counts[place], uni.split[place], uni.kinds[place]):
            of = mix64(word + np.arange(parts, dtype=np.uint64) * _PART)
            k = np.searchsorted(keys, of)
            k = k[(k < len(keys)) & (keys[np.minimum(k, len(keys) - 1)] == of)]
            total[k], kinds[k] = count, distinct
    p_low = uni.log_p(s, rare, rare_counts)
    seen = np.flatnonzero(n > 0)
    live = np.flatnonzero(total > 0)
    index = np.full(len(keys), -1)
    index[live] = np.arange(len(live))
    share = np.minimum(1.0, DISCOUNT * np.maximum(kinds[live], 1) / total[live])
    p = np.maximum(n[seen] - DISCOUNT, 0) / total[owner[seen]] + share[index[owner[seen]]] * 10 ** p_low[seen]
    words, ranks = np.unique(s[seen], return_inverse=True)
    pointers = np.concatenate([[0], np.cumsum(np.bincount(index[owner[seen]], minlength=len(live)))])
    trie = Trie(keys[live], pointers, ranks.astype(np.int64), words, np.log10(share), np.log10(p))
    found, logp, weight = trie.lookup(c, s)
    score = np.where(found, logp, weight + p_low)[kind_of] * times
    base = (np.log10((total + ADD) / uni.denominator())[owner])[kind_of] * times
    known = (total > 0)[owner][kind_of] * times
    for k, r in enumerate(records):
        rows = (mark[first[k]:first[k + 1]] >> 1).astype(np.int64)
        here, back = np.unique(rows, return_inverse=True)
        part = slice(first[k], first[k + 1])
        sums = [np.bincount(back, v[part], len(here)) for v in (base, score, known, times)]
        yield r[1], r[2], here.astype("<u2").tobytes(), sums[0].tobytes(), sums[1].tobytes(), sums[2].astype("<u4").tobytes(), sums[3].astype("<u4").tobytes(), r[10]


def _score(uni: Unigrams):
    names = ["chunk", "rows", "at", "base", "score", "known", "tokens", "ids"]

    def batches_of(records):
        rows = list(_score_shard(uni, records))
        for k in range(0, len(rows), 64):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 64]), (pa.int64(), pa.int32(), *[pa.binary()] * 6))], names=names)

    def run(it):
        now, records = None, []
        for batch in it:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[0] != now:
                    if records:
                        yield from batches_of(records)
                    now, records = r[0], []
                records.append(r)
        if records:
            yield from batches_of(records)

    return run


def _add_up(it):
    """Rows by chunk: add the shards' sums; one row per document."""
    def out(n, sums, ids):
        valid = np.unpackbits(np.frombuffer(ids[8 * n:], np.uint8), count=n).astype(bool)
        return pa.record_batch([pa.array(np.frombuffer(ids[:8 * n], "<i8"), mask=~valid), *(pa.array(x) for x in sums)], names=["id", "n_tokens", "n_known", "base_score", "score"])

    now, n, sums, ids = None, 0, None, None
    for batch in it:
        for chunk, rows, at, base, score, known, tokens, table in zip(*(c.to_pylist() for c in batch.columns)):
            if chunk != now:
                if now is not None:
                    yield out(n, sums, ids)
                now, n, sums = chunk, rows, (np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows))
            where = np.frombuffer(at, "<u2")
            for total, part in zip(sums, (np.frombuffer(tokens, "<u4"), np.frombuffer(known, "<u4"), np.frombuffer(base), np.frombuffer(score))):
                total[where] += part
            ids = table if table is not None else ids
    if now is not None:
        yield out(n, sums, ids)


def score_documents(documents: DataFrame, fold: int = 10, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS, top_words: int = TOP_WORDS, split_tokens: int = SPLIT_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); learned from ids whose crc32 mod ``fold`` is not ``held_out``."""
    rest = crc32_mod(F.col("id"), fold)
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    learn = F.col("id").isNotNull() & (rest != held_out)
    uni, counts = unigrams(docs.where(learn), top_words, split_tokens)
    shards = max(1, -(-uni.tokens // shard_tokens))
    dealt = docs.select("id", learn.alias("learn"), "text").mapInArrow(_deal(uni, shards), _RECORD_DDL)
    if len(uni.words) < uni.types:
        asked = docs.select("text").mapInArrow(_ask(uni, shards), "shard int, w bigint").distinct().join(counts, "w").select("shard", "w", "c")
        dealt = dealt.union(asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_answer, _RECORD_DDL))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "chunk")
    parts = dealt.mapInArrow(_score(uni), "chunk bigint, rows int, at binary, base binary, score binary, known binary, tokens binary, ids binary")
    sums = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_add_up, "id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return sums.select(F.col("id").alias(id_col), (F.coalesce(rest, F.lit(-1)) == held_out).alias("held_out"), "n_tokens", "n_known", F.lit(uni.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
