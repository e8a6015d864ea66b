"""BPE encoding and decoding for a word-end byte-level vocabulary (operator 7).

Encoding follows the backtracking method: an Aho-Corasick automaton over all vocabulary entries finds every token
that starts at each position of a word; the encoder walks left to right, takes the longest token whose pair with
its predecessor is in the pair-compatibility table, and steps back when none fits.  A token sequence is the
sequence of exact merges if and only if every adjacent pair is compatible, so the result equals rank-ordered
merging, and each position is left at most once.  The table is filled on demand: an entry is whether merging the
two tokens' symbols alone gives back just these two tokens.

Decoding gathers token texts from one byte blob through a table of offsets.

Texts: null counts as empty; an empty text has no tokens; texts are processed whole, whatever their length.
Columns besides the id and the text are not carried.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import batches, slices

# White space as the vocabulary's pattern sees it, and its pre-tokenizer pattern.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
_TRAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # signs of which a run is one piece
_SPLIT = re.compile(f"[{_SPACES}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_NOT_ASCII_SPLIT = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")  # with the wider spaces: texts that ASCII white space alone does not split
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
NEVER = 1 << 30
NO_MERGE = (NEVER, -1)
CACHE = 1 << 18
PAIRS_PER_RUN = 4
SLICE_CHARS = 1 << 23


def _byte_chars() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


class WordBpe:
    """Encoder and decoder for one tokenizer file.  Symbols: a byte inside a word is chr(b), a word's last byte chr(256 + b).

    ``cache`` bounds the entries of the caches; ids do not depend on it.
    """

    def __init__(self, path: str, cache: int = CACHE):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.find = regex.compile(_PATTERN).findall
        symbols: dict[str, str] = {}
        for c, b in _byte_chars().items():
            symbols[c] = chr(b)
            symbols[c + _WORD_END] = chr(256 + b)
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: list[tuple[int, int, int] | None] = [None] * (max(vocab.values()) + 1)
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ", 1)
            symbols[a + b] = symbols[a] + symbols[b]
            self.merged[vocab[a], vocab[b]] = rank, vocab[a + b]
            self.parts[vocab[a + b]] = vocab[a], vocab[b], rank
        self.single = {s: vocab[t] for t, s in symbols.items() if len(s) == 1}
        self.symbols = [""] * (max(vocab.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for t, s in symbols.items():
            self.symbols[vocab[t]] = s
            self.automaton.add_word(s, vocab[t])
        self.automaton.make_automaton()
        self.whole = {s: vocab[t] for t, s in symbols.items()}
        self.size = [len(s) for s in self.symbols]
        self.shorter = [-1] * len(self.symbols)  # a token's longest proper prefix that is a token
        for s, token in self.whole.items():
            self.shorter[token] = next((self.whole[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.whole), -1)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        texts = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        parts = [(texts.get(i, "") + " ").encode() for i in range(max(texts) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self.pairs: list[dict[int, bool]] = [{} for _ in range(len(self.symbols) + 1)]  # by left token; the last row (-1) is a word's start
        self.n_pairs = 0
        self.cache = cache
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _merge(self, symbols: str) -> list[int]:
        """Rank-ordered merging, the definition; only used to fill the pair table."""
        ids = [self.single[c] for c in symbols]
        while len(ids) > 1:
            best = min(self.merged.get(p, NO_MERGE) for p in zip(ids, ids[1:]))
            if best == NO_MERGE:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merged.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token that lie at its left (0) or right (1) edge, innermost first, with the rank that absorbs each."""
        out = [(token, NEVER)]
        while (parts := self.parts[out[-1][0]]) is not None:
            out.append((parts[side], parts[2]))
        return out[::-1]

    def _check(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary: it would have to come before its left part is absorbed, and not after its right part is."""
        if not self.compatible(-1, b):
            return False
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            rank = self.merged.get((x, y), NO_MERGE)[0]
            if rank < until_x and rank <= until_y and rank != NEVER:
                return False
            if until_x == until_y == NEVER:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b may stand side by side; a = -1: b, merged from its symbols, is itself."""
        row = self.pairs[a]
        got = row.get(b)
        if got is None:
            self.n_pairs += 1
            if self.n_pairs > PAIRS_PER_RUN * self.cache:
                self.n_pairs = 0
                for r in self.pairs:
                    r.clear()
            got = row[b] = self._merge(self.symbols[b]) == [b] if a < 0 else self._check(a, b)
        return got

    def _backtrack(self, word: str) -> list[int]:
        """Longest tokens first, stepping back where no token fits; each position is given up at most once."""
        size, shorter, pairs = self.size, self.shorter, self.pairs
        longest = [-1] * len(word)
        for end, token in self.automaton.iter(word):
            longest[end + 1 - size[token]] = token
        out: list[int] = []
        dead: set[int] = set()
        pos, token, n, before = 0, longest[0], len(word), -1
        while True:
            row = pairs[before]
            while token >= 0:
                fits = row.get(token)
                if fits is None:
                    fits = self.compatible(before, token)
                if fits and not (dead and pos + size[token] in dead):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += size[token]
                if pos == n:
                    return out
                before, token = token, longest[pos]
            else:
                dead.add(pos)
                token = out.pop()
                pos -= size[token]
                before = out[-1] if out else -1
                token = shorter[token]

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        word = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        token = self.whole.get(word)
        ids = [token] if token is not None and self.compatible(-1, token) else self._backtrack(word)
        got = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.pieces) >= 2 * self.cache:
                self.pieces.clear()
            self.pieces[piece] = got
        return got

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run without white space, from its words' ids."""
        pieces = self.pieces
        word = chunk.rstrip(_TRAIL)
        if word.isalpha():
            got = pieces.get(word) or self._piece(word)
            if len(word) < len(chunk):  # the signs after a word are one piece
                tail = chunk[len(word):]
                got += pieces.get(tail) or self._piece(tail)
        else:
            got = b"".join([pieces.get(p) or self._piece(p) for p in self.find(chunk)])
        if len(chunk) <= 64:
            if len(self.chunks) >= self.cache:
                self.chunks.clear()
            self.chunks[chunk] = got
        return got

    def _normal(self, text: str) -> str:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # a final capital sigma is lower-cased like any other
            text = text.replace("Σ", "σ")
        return text.lower()

    def _plain(self, text: str) -> bytes:
        text = self._normal(text)
        known = self.chunks
        words = text.split() if not _ODD_SPACE.search(text) else [c for c in _SPLIT.split(text) if c]
        return b"".join([known.get(c) or self._chunk(c) for c in words])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_special is None or "<|" not in text:
            return self._plain(text)
        return b"".join(np.uint32(self.special[p]).tobytes() if p in self.special else self._plain(p) for p in self.split_special.split(text) if p)

    def encode_all(self, texts: list[str | None]):
        """``encode`` of each text in turn; of a slice of texts every distinct run is looked up once."""
        for a, b in slices(len(texts), np.array([len(t or "") for t in texts], np.int64), SLICE_CHARS):
            if b - a == 1 and len(texts[a] or "") > SLICE_CHARS:
                yield self.encode(texts[a])
                continue
            alone, low = {}, []
            for i in range(a, b):
                normal = self._normal(texts[i] or "")
                if any(c in normal for c in _NOT_ASCII_SPLIT) or not normal.isascii() and _WIDE_SPACE.search(normal):
                    alone[i], normal = self.encode(texts[i]), ""
                low.append(normal)
            words = pc.ascii_split_whitespace(pa.array(low, pa.large_string()))
            runs = words.flatten().dictionary_encode()
            known = self.chunks
            ids = [known.get(c) or (self._chunk(c) if c else b"") for c in runs.dictionary.to_numpy(zero_copy_only=False)]
            table = np.frombuffer(b"".join(ids), "<u4")
            size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
            code = runs.indices.to_numpy()
            ends = np.concatenate([[0], np.cumsum(size[code])])
            shift = ((np.cumsum(size) - size)[code] - ends[:-1]).astype(np.int32)
            got = table[np.repeat(shift, size[code]) + np.arange(ends[-1], dtype=np.int32)]
            first = ends[words.offsets.to_numpy()]
            for i in range(a, b):
                yield alone[i] if i in alone else got[first[i - a]:first[i - a + 1]].tobytes()

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids: their texts joined by a space."""
        i = np.frombuffer(ids, "<u4")
        if not len(i):
            return b""
        low = self.offset[i]
        size = self.offset[i + 1] - low
        ends = np.cumsum(size)
        return self.blob[np.repeat(low - (ends - size), size) + np.arange(int(ends[-1]))].tobytes()[:-1]


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The encoder of a file, once per Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def bpe_encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, n_tokens): every whole text's ids as binary, little-endian unsigned 32-bit.  No shuffle."""

    def run(it):
        bpe = load(tokenizer)

        def make(batch):
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            return batch.column(0), ids, [len(x) // 4 for x in ids]

        yield from batches(it, ["id", "ids", "n_tokens"], [pa.int64(), pa.binary(), pa.int64()], make)

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, ids binary, n_tokens bigint").withColumnRenamed("id", id_col)


def bpe_decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """(id..., decoded): the first column, and the text of the ids in ``ids_col`` (null: empty)."""
    id_col = df.columns[0]

    def run(it):
        bpe = load(tokenizer)
        yield from batches(it, ["id", "text"], [pa.int64(), pa.string()],
                           lambda batch: (batch.column(0), pa.array([bpe.decode(x or b"").decode("utf-8") for x in batch.column(1).to_pylist()], pa.string())))

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, "id bigint, text string").toDF(id_col, out_col)


def bpe_round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) in one pass: encode, then decode the ids, and keep both digests."""

    def run(it):
        bpe = load(tokenizer)

        def make(batch):
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            return (batch.column(0), [len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids])

        yield from batches(it, ["id", "n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.int64(), pa.string(), pa.string()], make)

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
