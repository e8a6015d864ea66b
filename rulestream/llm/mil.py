"""Quality classifier by attention-based multiple-instance learning (operator 4).

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is encoded from its own characters and
words (shares of character classes, word lengths, repetition inside the passage and against earlier passages of the
document), a learned layer embeds it, gated attention weighs the passages of a bag, and the score is the logistic
value of the weighted passage.  The weights are learned from document labels only, on a sample of at most
``SAMPLE`` labelled documents outside the held-out fold, in the order of a hash of their ids.

Labels, language, source and id are never inputs of a score.  Scores are computed in Arrow batches without a shuffle;
the model (some thousand numbers) travels with the function.  Null texts count as empty; an empty text is a bag of one
empty passage and has a score.  Texts are scored whole.  Repeated rows are scored as often as they occur.
If no labelled row exists, every score is 0.5; if only one label occurs, that label's smoothed share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import batches
from rulestream.llm.words import Words, words_of

PASSAGE_WORDS = 48
SAMPLE = 4000
EMBED, GATE, EPOCHS, SEED = 16, 8, 160, 7

# Character classes that are counted per passage.
_CLASSES = [range(65, 91), range(97, 123), range(128, 256), range(48, 58), b"!", b"*", b"#", b"$%&", b"|", b".", b",;:", b"'\"()[]{}", b"=+-_/\\<>@^~`?"]


def _tables() -> list[np.ndarray]:
    """Three classes a table, 21 bits each: one gather and one sum count three classes."""
    out = []
    for k in range(0, len(_CLASSES), 3):
        t = np.zeros(256, np.uint64)
        for shift, chars in enumerate(_CLASSES[k:k + 3]):
            t[list(chars)] = np.uint64(1) << np.uint64(21 * shift)
        out.append(t)
    return out


_TABLES = _tables()
FEATURES = len(_CLASSES) + 9


def _repeats(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each (group, value) occurred before, in order."""
    order = np.lexsort((np.arange(len(value)), value, group))
    g, v = group[order], value[order]
    again = np.zeros(len(value), bool)
    again[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return again


def passages(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, first passage of each row and their number at the end).  Every row has one passage at least."""
    counts = np.diff(w.first)
    per = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(per)])
    x = np.zeros((int(first[-1]), FEATURES))
    if not len(w.hash):
        return x, first
    row = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(row)) - w.first[row]
    passage = first[row] + number // PASSAGE_WORDS
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    here = passage[heads]
    n = np.diff(np.append(heads, len(row))).astype(float)
    length = (w.end - w.start).astype(float)
    chars = np.add.reduceat(length, heads)
    begin, c = w.start[heads], 0
    for table in _TABLES:
        sums = np.add.reduceat(table[w.data], begin)
        for shift in range(min(3, len(_CLASSES) - c)):
            x[here, c] = (sums >> np.uint64(21 * shift) & np.uint64((1 << 21) - 1)) / chars
            c += 1
    total = lambda v: np.add.reduceat(v.astype(float), heads)
    mean = chars / n
    x[here, c] = mean / 10
    x[here, c + 1] = np.sqrt(np.maximum(0, total(length**2) / n - mean**2)) / 10
    x[here, c + 2] = total(_repeats(passage, w.hash)) / n
    next_same = np.zeros(len(row), bool)
    next_same[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    x[here, c + 3] = total(next_same) / n
    pair = w.hash.copy()
    pair[1:] += w.hash[:-1] * np.uint64(3)
    x[here, c + 4] = total(_repeats(row, pair)) / n
    x[here, c + 5] = np.minimum(n, PASSAGE_WORDS) / PASSAGE_WORDS
    x[here, c + 6] = total(length <= 1) / n
    x[here, c + 7] = np.log1p(counts[row[heads]]) / 10
    x[here, c + 8] = 1
    return x, first


def _init(rng) -> dict[str, np.ndarray]:
    g = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
    return {"E": g(FEATURES, EMBED), "e": np.zeros(EMBED), "V": g(EMBED, GATE), "U": g(EMBED, GATE), "a": g(GATE, 1)[:, 0], "c": g(EMBED, 1)[:, 0], "b": np.zeros(1)}


def _forward(p: dict, x: np.ndarray, first: np.ndarray) -> tuple:
    h = np.tanh(((x - p["mean"]) / p["std"]) @ p["E"] + p["e"])
    v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    raw = (v * u) @ p["a"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    soft = np.exp(raw - np.maximum.reduceat(raw, first[:-1])[bag])
    att = soft / np.add.reduceat(soft, first[:-1])[bag]
    z = np.add.reduceat(att[:, None] * h, first[:-1], axis=0)
    return 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30))), z, att, h, v, u, bag


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights by Adam on the logistic loss with a small penalty; bags are whole."""
    base = {"mean": x.mean(0), "std": x.std(0) + 1e-3}
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return base | {k: v * 0 for k, v in _init(np.random.default_rng(SEED)).items()} | {"b": np.array([np.log(share / (1 - share))])}
    p, rng = _init(np.random.default_rng(SEED)), np.random.default_rng(SEED)
    m1, m2, step = {k: v * 0 for k, v in p.items()}, {k: v * 0 for k, v in p.items()}, 0
    size = max(64, min(512, len(y)))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), size):
            bags = np.sort(order[a:a + size])
            n = np.diff(first)[bags]
            rows = np.repeat(first[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            f, t = np.concatenate([[0], np.cumsum(n)]), y[bags]
            xb = x[rows]
            s, z, att, h, v, u, bag = _forward(p | base, xb, f)
            d = (s - t) / len(t)
            dz = d[:, None] * p["c"]
            dh = att[:, None] * dz[bag]
            da = att * ((h - z[bag]) * dz[bag]).sum(1)
            dv, du = da[:, None] * p["a"] * u * (1 - v**2), da[:, None] * p["a"] * v * u * (1 - u)
            dh += dv @ p["V"].T + du @ p["U"].T
            de = dh * (1 - h**2)
            g = {"E": ((xb - base["mean"]) / base["std"]).T @ de, "e": de.sum(0), "V": h.T @ dv, "U": h.T @ du, "a": (da[:, None] * v * u).sum(0), "c": z.T @ d, "b": np.array([d.sum()])}
            step += 1
            rate = 0.01 * (0.1 if epoch > epochs * 0.7 else 1)
            for k in p:
                grad = g[k] + (1e-4 * p[k] if k != "b" else 0)
                m1[k], m2[k] = 0.9 * m1[k] + 0.1 * grad, 0.999 * m2[k] + 0.001 * grad**2
                p[k] = p[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return p | base


def train(documents: DataFrame, labels: DataFrame, learn_from: Column, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """Weights from at most ``sample`` labelled documents for which ``learn_from`` (over ``doc_id``) holds."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("mark")).where(F.col("doc_id").isNotNull() & F.col("mark").isin(0, 1))
    marks = marks.groupBy("doc_id").agg(F.max("mark").alias("mark")).where(learn_from).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(marks), "doc_id").select("doc_id", "mark", "text")

    def run(it):
        def make(batch):
            rows = []
            for _, _, w in words_of(batch.column(2)):
                x, first = passages(w)
                rows += [x[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:])]
            return batch.column(0), batch.column(1), rows

        yield from batches(it, ["doc_id", "mark", "x"], [pa.int64(), pa.int32(), pa.binary()], make)

    got = chosen.mapInArrow(run, "doc_id bigint, mark int, x binary").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).collect()
    if not got:
        return None
    bags = [np.frombuffer(r.x, "<f4").reshape(-1, FEATURES).astype(float) for r in got]
    return fit(np.concatenate(bags), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), np.array([r.mark for r in got], float))


def score_quality(documents: DataFrame, model: dict[str, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; 0 to 1, higher: label 1 likelier."""

    def run(it):
        def make(batch):
            out = []
            for a, b, w in words_of(batch.column(1)):
                out.append(_forward(model, *passages(w))[0] if model is not None else np.full(b - a, 0.5))
            return batch.column(0), np.concatenate(out)

        yield from batches(it, ["id", "score"], [pa.int64(), pa.float64()], make)

    return documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id bigint, score double").withColumnRenamed("id", id_col)


def filter_quality(documents: DataFrame, model: dict[str, np.ndarray] | None, least: float = 0.7) -> DataFrame:
    """Rows whose text scores ``least`` or more, with all their columns as they are."""
    names, schema = documents.columns, documents.schema

    def run(it):
        for batch in it:
            col = batch.column(names.index("text"))
            keep = [np.zeros(0, bool)]
            for a, b, w in words_of(col):
                keep.append(_forward(model, *passages(w))[0] >= least if model is not None else np.ones(b - a, bool))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return documents.mapInArrow(run, schema)
