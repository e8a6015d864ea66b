"""Secrets by two character Markov models (operator 11).

Base spans come from three fixed patterns with checks.  Everything else that may be a secret is a *run*: a stretch of
letters, digits and ``+/_=-``.  Two Markov models of order two over these characters, one of random strings and one of
ordinary identifiers, give every character of a run a log-likelihood ratio, given the two characters before it.  A run
falls into pieces at its signs; a scan over the pieces sums their ratios, starts anew where the sum turns negative, and
ends a segment where it has fallen ``ODDS`` below its peak.  A segment of ``MIN_CHARS`` characters or more whose sum is
above ``ODDS`` (the log of the prior odds of a run being ordinary) is added as kind ``random`` where it overlaps no base
span; base spans always stay.

Both models are learned from labelled samples: values inside base spans are secret; other runs of at most
``MAX_IDENTIFIER`` characters, and pairs of neighbouring words joined as identifiers, are ordinary; each distinct string
counts once, so that a string in a third of all documents weighs no more than another, and ``RARE`` is taken off every ordinary
n-gram's count, so that a secret that the patterns miss does not teach the model of identifiers its own n-grams.  The samples are those of the
``SAMPLE`` documents whose ids hash lowest (ids decide first, then their texts are read in place; rows of one id go
together), beside generated random strings and numbers.  Only n-gram counts, bounded by the alphabet, reach the driver.

Offsets count code points, ends are exclusive.  Texts are scanned whole and in linear time, however long; null counts as
empty and gives no spans; an empty table gives no rows; repeated rows and rows without id are processed like all others;
other columns are not carried, whatever their names.  Finding makes no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

SAMPLE = 2000
MIN_CHARS = 16
MAX_IDENTIFIER = 64
RARE = 2
ODDS = float(np.log(1e4))
SMOOTH = 2.0
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
_PIECE = re.compile(r"[A-Za-z0-9]+|[+/_=-]+")
_ANY_RUN = re.compile(r"[A-Za-z0-9+/_=-]{3,}")
_EDGE = len(_ALPHABET)
_CODE = np.full(128, _EDGE, np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(_EDGE)
# a row without any of these holds no span
_MAYBE = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=])|AKIA[A-Z0-9]{16}|[A-Za-z0-9+/_=-]{%d}""" % MIN_CHARS


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns: leftmost, non-overlapping within a kind, failing matches dropped."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def base_values(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand in the base spans."""
    return sorted([m.span(2) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
                  + [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20] + [m.span() for m in _HEX.finditer(text)])


def _codes(s: str) -> np.ndarray:
    return _CODE[np.frombuffer(s.encode("ascii"), np.uint8)]


def _contexts(s: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    c = _codes(s)
    padded = np.concatenate(([_EDGE, _EDGE], c))
    return padded[:-2], padded[1:-1], c


def trigram_counts(strings) -> np.ndarray:
    """How often each character follows each two others; edges stand before every string."""
    text = "\0\0" + "\0\0".join(strings)
    c = _codes(text)
    cell = (c[:-2] * (_EDGE + 1) + c[1:-1]) * (_EDGE + 1) + c[2:]
    n = np.bincount(cell[c[2:] != _EDGE], minlength=(_EDGE + 1) ** 3).astype(float)
    return n.reshape(_EDGE + 1, _EDGE + 1, _EDGE + 1)


def _log_model(n: np.ndarray) -> np.ndarray:
    """log P(c | a, b) with each order smoothed by the next lower one."""
    n = n[:, :, :_EDGE]
    one = n.sum((0, 1)) + 1.0
    one /= one.sum()
    two = n.sum(0) + SMOOTH * one
    two /= two.sum(1, keepdims=True)
    three = n + SMOOTH * two
    return np.log(three / three.sum(2, keepdims=True))


@dataclass
class Models:
    """Log-likelihood ratio (random against ordinary) of a character after two others."""

    ratio: np.ndarray

    def ratios(self, run: str) -> np.ndarray:
        return self.ratio[_contexts(run)]


def fit(secret: np.ndarray, ordinary: np.ndarray) -> Models:
    return Models(_log_model(secret) - _log_model(ordinary))


def generated(seed: int = 11) -> tuple[list[str], list[str]]:
    """Random strings over the alphabets of keys, and ordinary numbers, dates and versions."""
    rng = np.random.default_rng(seed)
    upper, lower, digit = _ALPHABET[:26], _ALPHABET[26:52], _ALPHABET[52:62]
    alphabets = [upper + lower + digit, upper + lower + digit + "+/", upper + lower + digit + "_-", digit + "abcdef", upper + digit, lower + digit]
    random = ["".join(rng.choice(list(alphabets[k % len(alphabets)]), int(rng.integers(MIN_CHARS, 65)))) for k in range(3000)]
    numbers = [str(rng.integers(10**4, 10 ** int(rng.integers(5, 19)))) for _ in range(400)]
    dates = [f"{1970 + k % 80}-{k % 12 + 1:02d}-{k % 28 + 1:02d}" for k in range(200)]
    return random, numbers + dates


def segments(run: str, models: Models) -> list[tuple[int, int]]:
    """Stretches of whole pieces of a run that are rather random than ordinary."""
    total = np.concatenate(([0.0], np.cumsum(models.ratios(run))))
    out, start, peak, end = [], 0, 0.0, 0

    def close():
        a, b = start, end
        while a < b and run[a] in "+/_=-":
            a += 1
        while b > a and run[b - 1] in "+/_-":
            b -= 1
        if b - a >= MIN_CHARS and total[b] - total[a] > ODDS:
            out.append((a, b))

    for m in _PIECE.finditer(run):
        now = total[m.end()] - total[start]
        if now > peak:
            peak, end = now, m.end()
        elif now < 0 or now < peak - ODDS:
            close()
            start, peak, end = m.end(), 0.0, m.end()
    close()
    return out


def all_spans(text: str | None, models: Models | None) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, is base) by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    out = [(a, k, b, True) for a, k, b in base]
    if models is not None:
        starts = np.array([a for a, _, _ in base])
        far = np.maximum.accumulate([b for _, _, b in base]) if base else None
        for m in _RUN.finditer(text):
            for a, b in segments(m.group(), models):
                a, b = a + m.start(), b + m.start()
                before = np.searchsorted(starts, b) if base else 0
                if not (before and far[before - 1] > a):
                    out.append((a, 3, b, False))
    return sorted(out)


def labelled(text: str) -> tuple[set[str], set[str]]:
    """(secret, ordinary) strings of one text."""
    values = base_values(text)
    secret = {s for a, b in values for s in (text[a:b].replace(".", ""),) if len(s) >= 3}
    ordinary, last, at = set(), "", 0
    for m in _ANY_RUN.finditer(text):
        while at < len(values) and values[at][1] <= m.start():
            at += 1
        if at < len(values) and values[at][0] < m.end():
            last = ""
            continue
        s = m.group()
        if len(s) <= MAX_IDENTIFIER:
            ordinary.add(s)
        if s.isalpha() and len(s) <= 16:
            if last:
                ordinary.add(f"{last}{('_', '-', '/', '')[(len(last) + len(s)) % 4]}{s.title() if len(last) % 2 else s}")
            last = s
        else:
            last = ""
    return secret, ordinary


def learn(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Models:
    """Both models from the labelled strings of the ``sample`` documents whose ids hash lowest."""
    h = F.xxhash64(F.col(id_col))
    cutoff = documents.select(h.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    random, numbers = generated()
    secret, ordinary = trigram_counts(random), trigram_counts(numbers)
    if cutoff is not None:
        texts = documents.where((h <= cutoff) & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))

        def label(it):
            for batch in it:
                for t in batch.column(0).to_pylist():
                    s, o = labelled(t)
                    yield pa.record_batch([pa.array([True] * len(s) + [False] * len(o), pa.bool_()), pa.array([*s, *o], pa.string())], names=["secret", "string"])

        def count(it):
            n = np.zeros((2, _EDGE + 1, _EDGE + 1, _EDGE + 1))
            for batch in it:
                kind = batch.column(0)
                for s in (False, True):
                    n[int(s)] += trigram_counts(batch.column(1).filter(pc.equal(kind, s)).to_pylist())
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(at), pa.array(n.ravel()[at].astype(np.int64))], names=["cell", "n"])

        strings = texts.mapInArrow(label, "secret boolean, string string").distinct()
        cells = strings.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
        both = np.zeros((2, *secret.shape))
        for r in cells:
            both.ravel()[r.cell] = r.n
        ordinary, secret = ordinary + np.maximum(both[0] - RARE, 0), secret + both[1]
    return fit(secret, ordinary)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_secrets(documents: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): all spans of every whole text, by start, then kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(it):
        for batch in it:
            text = batch.column(1)
            maybe = pc.fill_null(pc.match_substring_regex(text, _MAYBE), False).to_pylist()
            found = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, k, b, base in all_spans(text[n].as_py(), models)] if maybe[n] else [] for n in range(len(text))]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["id", "spans"])

    return documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id bigint, spans {_SPANS}").withColumnRenamed("id", id_col)


def redact(documents: DataFrame, models: Models | None, text_col: str = "text") -> DataFrame:
    """All rows and columns; every span of the text is replaced by ``[SECRET]``, overlapping ones as one."""
    names = documents.columns
    at = names.index(text_col)

    def clean(text):
        out, last = [], 0
        for a, _, b, _ in all_spans(text, models):
            if a >= last:
                out += [text[last:a], "[SECRET]"]
            last = max(last, b)
        return "".join(out) + text[last:] if out else text

    def run(it):
        for batch in it:
            col = pa.array([clean(t) for t in batch.column(at).to_pylist()], batch.column(at).type)
            yield pa.record_batch([col if n == at else batch.column(n) for n in range(len(names))], schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
