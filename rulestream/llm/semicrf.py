"""Personal data by a semi-Markov conditional random field over whole spans (operator 5).

Base spans come from four fixed patterns with checks.  Around every digit or at-sign a window of text is cut into
tokens (runs of letters and digits, single other characters).  Candidate segments of at most ``MAX_TOKENS`` tokens and
``MAX_CHARS`` characters that pass a kind's check are scored as wholes (digit counts, grouping, checksum, signs, shape,
neighbours) for each kind they may be, and a dynamic program over the window chooses boundaries and kinds jointly.  Its
segments are added where they overlap no base span; base spans always stay.

The weights are learned here by the log-likelihood of the base spans, and of the same spans written otherwise (without
country code, with other separators, defanged), in at most ``WINDOWS`` pieces of text of at most ``PIECE`` characters.
They are drawn by a hash of their text from all windows, cut at white space, of the documents whose own hash is among the
smallest (about ``SAMPLE`` of them at least); no text moves but these pieces.

Offsets count code points, ends are exclusive.  Texts are processed whole, in time and memory proportional to their
length; null counts as empty, an empty table gives no rows, repeated rows are processed as often as they occur, no shuffle
is made.  Other columns are not carried; ``redact`` keeps them all.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE = 1500
WINDOWS = 600
PIECE = 600
REACH = 40
MAX_TOKENS = 20
MAX_CHARS = 320
STRIDE = 512
EPOCHS = 25
STEPS = 600
MARGIN = 1.0
_SEED_CHAR = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\W_]+|[^\s]", re.UNICODE)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns: leftmost, non-overlapping within a kind."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _DOTTED.finditer(text):
        if m.group().count(".") > 2:
            parts, start = m.group().split("."), m.start()
            for k in range(0, len(parts) - 3, 4):  # the pattern takes four numbers after four
                end = start + sum(map(len, parts[k:k + 4])) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k:k + 4]):
                    out.append((start, 1, end))
                start = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches within ``REACH`` characters of a digit or at-sign, widened to white space (by ``REACH`` more at most); near ones are one."""
    out: list[list[int]] = []
    for m in _SEED_CHAR.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.start() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    done: list[list[int]] = []
    for a, b in out:
        for _ in range(REACH):
            if a and not text[a - 1].isspace():
                a -= 1
            if b < len(text) and not text[b].isspace():
                b += 1
        if done and a < done[-1][1]:
            done[-1][1] = max(b, done[-1][1])
        else:
            done.append([a, b])
    return [(a, b) for a, b in done]


def pieces(text: str) -> list[str]:
    """All windows of a text, cut at white space into pieces of at most ``PIECE`` characters (a longer word is cut inside)."""
    out = []
    for lo, hi in windows(text):
        while hi - lo > PIECE:
            at = max(text.rfind(c, lo + 1, lo + PIECE) for c in " \t\n")
            at = at if at > lo else lo + PIECE
            out.append(text[lo:at])
            lo = at
        out.append(text[lo:hi])
    return out


def _kind_check(kind: int, span: str) -> bool:
    d = _digits(span)
    if kind == 0:
        return span.count("@") == 1 and "." in span.split("@")[1]
    if kind == 1:
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(d) <= 19 and luhn(d)
    return 10 <= len(d) <= 15


_GROUPS = re.compile(r"[0-9]+")
_BETWEEN = re.compile(r"(?<=[0-9])[^0-9]+(?=[0-9])")
N_FEATURES = 38


def span_features(text: str, a: int, b: int) -> list[float]:
    """Whole-span features of text[a:b] and its neighbours."""
    s = text[a:b]
    runs = _GROUPS.findall(s)
    groups = [len(g) for g in runs]
    n = sum(groups)
    letters = sum(c.isalpha() for c in s)
    before, after = text[a - 1] if a else " ", text[b] if b < len(text) else " "
    dots, ats = s.count("."), s.count("@")
    spaces, dashes = s.count(" "), s.count("-")
    octets = len(groups) == 4 and all(x <= 3 for x in groups) and all(int(x) <= 255 for x in runs)
    gaps = _BETWEEN.findall(s)
    return [1.0, n >= 14 and n <= 19, n >= 10 and n <= 13, n >= 7 and n <= 9, n < 7, n > 19, 13 < n < 20 and luhn("".join(runs)),
            s[0] == "+", s[0] == "(", "(" in s and ")" in s, "(" in s and ")" not in s or ")" in s and "(" not in s, octets, octets and dots == 3, dots == 3, ats == 1, ats > 1, ats == 1 and "." in s[s.index("@"):],
            letters > 0, letters > 0 and ats == 0, spaces > 4, dashes > 0, before.isalnum(), after.isalnum(), before in "+._%-@" or after in "@-" or before in "0123456789", not s[-1].isalnum(),
            len(groups) == 1, 2 <= len(groups) <= 5, len(groups) > 5, bool(re.search(r"\s\s|[^0-9A-Za-z.@+() _%-]", s)), ats == 1 and spaces > 0,
            groups == [3, 3, 4], groups[-3:] == [3, 3, 4] and len(groups) > 3, len(groups) > 2 and all(x == 4 for x in groups[:-1]), groups == [4, 6, 5], len(set(gaps)) == 1, len(set(gaps)) > 2,
            octets and set(gaps) <= {".", "[.]"}, any(len(g) > 3 for g in gaps)]


def segments(text: str, lo: int, hi: int):
    """Token bounds (starts, ends) of text[lo:hi], and an iterator over (first, last + 1, kinds) of segments that may be an entity."""
    starts, ends = array("q"), array("q")
    for m in _TOKEN.finditer(text, lo, hi):
        starts.append(m.start())
        ends.append(m.end())

    def candidates():
        for i, a in enumerate(starts):
            c = text[a]
            if not (c.isalnum() or c in "+("):
                continue
            digits, ats = 0, 0
            for j in range(i, min(len(starts), i + MAX_TOKENS)):
                x, y = starts[j], ends[j]
                if y - a > MAX_CHARS or j > i and x - ends[j - 1] > 1 or c.isalpha() and not ats and j > i and x > ends[j - 1]:
                    break  # too long; a wide gap; or a word and then white space before any at-sign
                ats += text[x] == "@"
                digits += sum("0" <= z <= "9" for z in text[x:y])
                if digits > 20 and not ats:
                    break
                if text[y - 1].isalnum() and (ats or digits >= 4 and not c.isalpha()):
                    kinds = [k for k in range(len(KINDS)) if _kind_check(k, text[a:y])]
                    if kinds:
                        yield i, j + 1, kinds

    return starts, ends, candidates()


def _scored(text: str, starts, ends, cands, w: np.ndarray) -> np.ndarray:
    """Scores (candidate, kind); minus infinity for kinds whose check fails."""
    score = np.array([span_features(text, starts[i], ends[j - 1]) for i, j, _ in cands], float) @ w
    return score + _allowed(cands)


def _allowed(cands) -> np.ndarray:
    out = np.full((len(cands), len(KINDS)), -np.inf)
    for k, (_, _, kinds) in enumerate(cands):
        out[k, kinds] = 0
    return out


def _logsum(a: np.ndarray) -> float:
    m = a.max()
    return float(m + np.log(np.exp(a - m).sum()))


def _ends(cands: list[tuple[int, int]], n: int) -> list[list[int]]:
    by = [[] for _ in range(n + 1)]
    for k, (_, j, _) in enumerate(cands):
        by[j].append(k)
    return by


def _gradient(feats: np.ndarray, allowed: np.ndarray, cands, n: int, gold: dict[int, int], w: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood of one window: observed less expected features, by the forward-backward sums over segmentations."""
    score = feats @ w + allowed
    either = np.logaddexp.reduce(score, axis=1)
    ends = _ends(cands, n)
    fwd = np.zeros(n + 1)
    for t in range(1, n + 1):
        fwd[t] = _logsum(np.array([fwd[t - 1]] + [fwd[cands[k][0]] + either[k] for k in ends[t]])) if ends[t] else fwd[t - 1]
    bwd = np.zeros(n + 1)
    starts = [[] for _ in range(n + 1)]
    for k, c in enumerate(cands):
        starts[c[0]].append(k)
    for t in range(n - 1, -1, -1):
        bwd[t] = _logsum(np.array([bwd[t + 1]] + [bwd[cands[k][1]] + either[k] for k in starts[t]])) if starts[t] else bwd[t + 1]
    i, j = np.array([c[:2] for c in cands]).T
    chance = np.exp(fwd[i][:, None] + score + bwd[j][:, None] - fwd[n])
    seen = np.zeros_like(chance)
    for k, kind in gold.items():
        seen[k, kind] = 1
    return feats.T @ (seen - chance)


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (feature, kind) from (text, true spans), one window each."""
    data = []
    for text, spans in examples:
        first, last, cands = segments(text, 0, len(text))
        cands = list(cands)
        if not cands:
            continue
        index = {(first[i], last[j - 1]): k for k, (i, j, _) in enumerate(cands)}
        gold = {index[a, b]: kind for a, kind, b in spans if (a, b) in index and kind in cands[index[a, b]][2]}
        data.append((np.array([span_features(text, first[i], last[j - 1]) for i, j, _ in cands], float), _allowed(cands), cands, len(first), gold))
    w = np.zeros((N_FEATURES, len(KINDS)))
    w[0] = -3.0  # an entity is rare
    mean, square, step = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(max(epochs, -(-STEPS * 32 // max(1, len(data))))):  # few examples are seen more often
        for a in range(0, len(data), 32):
            g, step = sum(_gradient(*d, w) for d in data[a:a + 32]) - 0.002 * w, step + 1
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            w = w + 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return w


def decode(text: str, lo: int, hi: int, w: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Best segmentation of a window: (start, kind, end, score) of its entities.

    ``top`` is pushed forward from each token, so candidates are scored ``STRIDE`` at a time and never held all at once.
    """
    starts, ends, cands = segments(text, lo, hi)
    n = len(starts)
    top, gain, back, kind = array("d", bytes(8 * (n + 1))), array("d", bytes(8 * (n + 1))), array("q", [-1]) * (n + 1), array("b", bytes(n + 1))
    done, some = 0, []  # top is final up to ``done``

    def settle(upto: int):
        nonlocal done
        while done < upto:
            done += 1
            if top[done - 1] >= top[done]:
                top[done], back[done] = top[done - 1], -1

    def push():
        score = _scored(text, starts, ends, some, w)
        for (i, j, _), k, best in zip(some, score.argmax(1).tolist(), score.max(1).tolist()):
            settle(i)
            if top[i] + best > top[j]:
                top[j], gain[j], back[j], kind[j] = top[i] + best, best, i, k
        some.clear()

    for c in cands:
        some.append(c)
        if len(some) == STRIDE:
            push()
    if some:
        push()
    settle(n)
    out, t = [], n
    while t > 0:
        if back[t] < 0:
            t -= 1
        else:
            out.append((starts[back[t]], kind[t], ends[t - 1], gain[t]))
            t = back[t]
    return out[::-1]


def all_spans(text: str | None, w: np.ndarray | None) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, is base) by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    out = [(a, k, b, True) for a, k, b in base]
    if w is not None:
        starts = np.array([a for a, _, _ in base])
        far = np.maximum.accumulate([b for _, _, b in base]) if base else None
        for lo, hi in windows(text):
            for a, k, b, s in decode(text, lo, hi, w):
                before = np.searchsorted(starts, b) if base else 0
                if s > MARGIN and not (before and far[before - 1] > a):
                    out.append((a, k, b, False))
    return sorted(out)


def _rewritten(span: str, kind: int) -> list[str]:
    """The same datum in the notations that the base patterns miss."""
    d = _digits(span)
    if kind == 3 and len(d) > 10:
        d = d[-10:]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}"]
    if kind == 2:
        return [x.join(d[i:i + 4] for i in range(0, len(d), 4)) for x in "./"]
    if kind == 1:
        return [span.replace(".", "[.]"), "[.]".join(span.rsplit(".", 1))]
    return []


def train(texts: list[str]) -> np.ndarray | None:
    """Weights from pieces of text, labelled by the fixed patterns and in rewritten notations; None without any piece."""
    if not texts:
        return None
    examples = []
    for text in texts:
        spans = base_spans(text)
        examples.append((text, spans))
        for a, k, b in spans if len(spans) == 1 else ():
            examples += [(text[:a] + new + text[b:], [(a, k, a + len(new))]) for new in _rewritten(text[a:b], k)]
    for k in range(40):  # dates, times and plain numbers are nobody's data
        day = f"{1990 + k}-{k % 12 + 1:02d}-{k % 28 + 1:02d}"
        examples += [(f"on {day} {k % 24:02d}:{k + 10}:{k + 11} at", []), (f"from {day} to {day} or {k * 7919 + 100000} of", []), (f"in {k + 1},{k + 100},{k + 200} v{k}.{k + 1}.{k + 2} and", []),
                     (f"rows {k * 31 + 1000} {k * 17 + 20} {k * 7 + 100} {k + 3000} {k + 50} sum", []), (f"id {k * 7919 + 1234567890} or 978-3-16-{k + 148410}-0 here", [])]
    return fit(examples)


def learn(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, limit: int = WINDOWS) -> np.ndarray | None:
    """Weights from at most ``limit`` pieces of the documents of smallest hash; None if no text holds a digit or at-sign."""
    texts = documents.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    zeros = F.lit(64) - F.length(F.bin("h"))  # each further leading zero bit halves what is taken
    counts = {r.zeros: r.n for r in texts.groupBy(zeros.alias("zeros")).agg(F.count("*").alias("n")).collect()}
    level, taken = max(counts, default=0), 0
    while level > 0 and (taken := taken + counts.get(level, 0)) < sample:
        level -= 1

    def run(it):
        for batch in it:
            for text in batch.column(0).to_pylist():
                yield pa.record_batch([pa.array(pieces(text), pa.string())], names=["piece"])

    found = texts.where(zeros >= level).select("text").mapInArrow(run, "piece string").distinct()
    return train([r.piece for r in found.orderBy(F.xxhash64("piece"), "piece").limit(limit).collect()])


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_personal_data(documents: DataFrame, weights: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): all spans of every whole text, by start, then kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(it):
        for batch in it:
            found = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, k, b, base in all_spans(t, weights)] for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["id", "spans"])

    return documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id bigint, spans {_SPANS}").withColumnRenamed("id", id_col)


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str | None, w: np.ndarray | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one, by the first."""
    if not text:
        return text
    out, last = [], 0
    for a, k, b, _ in all_spans(text, w):
        if a >= last:
            out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = max(last, b)
    return "".join(out) + text[last:] if out else text


def redact(documents: DataFrame, weights: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """All rows and columns, personal data replaced in the text."""
    names = documents.columns

    def run(it):
        at = names.index(text_col)
        for batch in it:
            col = pa.array([redacted(t, weights) for t in batch.column(at).to_pylist()], batch.column(at).type)
            yield pa.record_batch([col if n == at else batch.column(n) for n in range(len(names))], schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
