"""Line dedup, packing, Jaccard join, BPE, extraction, scoring: brute force, round trips and odd inputs."""
import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulestream.llm import bpe, density, jaccard, linededup, ngram_lm, packing
from rulestream.llm.words import words_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DDL = "doc_id bigint, text string, id string, n int"  # extra columns whose names clash with internal ones
ODD = [(1, None), (2, ""), (2, ""), (3, " \t\n"), (None, "a b c d e f"), (4, "A b"), (5, "a B"), (5, "x y z q r s"), (6, "x y z q r s"), (7, "w" * 200000), (8, "ab " * 30000)]


def table(spark, rows):
    return spark.createDataFrame([(a, b, "e", 1) for a, b in rows], DDL)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


# ---- BPE

def reference_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_library():
    t, b = reference_tokenizer(), bpe.load(TOKENIZER)
    rng = random.Random(1)
    texts = ["", "ΑΣ ΣΑΣ. İstanbul", "it's we'll 'S x'd", "a\x1cb c\x1fd", "<|endoftext|> hi<|startoftext|>x <|no|>", "é  x y　z", "日本語 123 ４５", "👍👍🏽 jekyll's</w> </w>",
             "aaaaaaaaaaaaaaaaaaaaaaaa", "​ x\x00y", "ß ẞ ŉ ǰ", "x" * 3000, "word*** word''' **a**b"]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz' éñ.!1") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    for x in texts:
        want = t.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(b.encode(x), "<u4").tolist() == want, x[:50]
        assert b.decode(b.encode(x)).decode() == t.decode(want, skip_special_tokens=False), x[:50]


def test_bpe_frames(spark):
    df = table(spark, ODD)
    ids = bpe.bpe_encode(df, TOKENIZER)
    assert ids.count() == len(ODD)
    back = {r.doc_id: r.decoded for r in bpe.bpe_decode(ids, TOKENIZER).collect()}
    assert back[1] == "" and back[4] == "a</w> b</w>"
    assert bpe.bpe_round_trip(df.limit(0), TOKENIZER).count() == 0


# ---- packing

def padding(sizes):
    return sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in sizes)


def test_differencing_is_balanced():
    rng = random.Random(2)
    sizes = [rng.randint(1, 900) for _ in range(400)]
    got = packing.differencing(sizes, 45)
    assert sorted(i for w in got for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in got]
    assert max(sums) - min(sums) < 40
    assert all(sum(sizes[i] for i in w) <= 4096 for w in packing.windows([3000, 3000, 3000, 1000], 4096))


def dense_differencing(sizes, m):
    """Every partition with all its ``m`` windows, as the definition has it."""
    heap = [(-n, i, [(n, [i])] + [(0, [])] * (m - 1)) for i, n in enumerate(sizes)]
    count = len(sizes)
    while len(heap) > 1:
        heap.sort()
        (_, _, a), (_, _, b) = heap[:2]
        both = sorted(((x + y, i + j) for (x, i), (y, j) in zip(a, b[::-1])), key=lambda w: -w[0])
        heap = [*heap[2:], (both[-1][0] - both[0][0], count, both)]
        count += 1
    return [sorted(items) for _, items in heap[0][2]]


def test_differencing_of_filled_windows():
    rng = random.Random(7)
    for _ in range(60):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 40))]
        for m in (1, 2, len(sizes) // 3 + 1, len(sizes) + 3):
            want = dense_differencing(sizes, m) if m > 1 else [list(range(len(sizes)))]
            assert packing.differencing(sizes, m) == want


def test_encode_all_looks_up_each_run_once():
    enc = bpe.WordBpe(TOKENIZER)
    odd = [None, "", "  ", "a\x1cb", "a\xa0b c", "x <|endoftext|> y", "İSTANBUL ΣΑΣ", "a\u2003b", " lead trail ", "é e\u0301", "\x85", "a<|b", "t\tn\nv\x0bf\x0cr\r x", "ßİ ſ"]
    assert list(enc.encode_all(odd)) == [enc.encode(t) for t in odd]
    assert list(enc.encode_all([])) == []

    class Counting(dict):
        asked = 0

        def get(self, key):
            Counting.asked += 1
            return super().get(key)

    enc.chunks = Counting()
    got = list(enc.encode_all(["one two two"] * 500))
    assert Counting.asked == 2 and set(got) == {enc.encode("one two two")}


def test_packing(spark, ):
    rng = random.Random(3)
    rows = ODD + [(100 + i, " ".join(rng.choice(["that", "whether", "under", "of"]) for _ in range(rng.randint(0, 900)))) for i in range(300)]
    pieces = packing.pack_documents(table(spark, rows), TOKENIZER).collect()
    by_seq = collections.defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append(p)
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        assert [p.offset for p in seq] == [sum(q.length for q in seq[:k]) for k in range(len(seq))]
        assert sum(p.length for p in seq) <= packing.CAPACITY
    total = sum(p.length for p in pieces)
    assert padding([sum(p.length for p in s) for s in by_seq.values()]) < 0.06 * total
    b = bpe.load(TOKENIZER)
    want = collections.Counter(b.encode(t) + b"\x02\0\0\0" for i, t in rows if i is not None and i >= 100)
    docs = collections.defaultdict(list)
    for p in pieces:
        if p.doc_id is not None and p.doc_id >= 100:
            docs[p.doc_id].append(p)
    got = collections.Counter()
    for ps in docs.values():
        ps.sort(key=lambda p: p.start)
        assert [p.start for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        got[b"".join(bytes(p.ids) for p in ps)] += 1
    assert got == want
    assert sum(p.length for p in pieces if p.doc_id == 2) == 2  # a repeated empty row is packed twice
    assert packing.pack_documents(table(spark, []), TOKENIZER).count() == 0


def test_small_caches_stay_bounded_and_give_the_same_ids():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdeé.") for _ in range(rng.randint(1, 12))) for _ in range(40)) for _ in range(60)]
    small = bpe.WordBpe(TOKENIZER, cache=16)
    assert list(small.encode_all(texts)) == list(bpe.load(TOKENIZER).encode_all(texts))
    assert len(small.chunks) <= 16 and len(small.pieces) <= 32
    assert sum(map(len, small.pairs)) <= bpe.PAIRS_PER_RUN * 16 + 1


def test_packing_takes_a_batch_in_parts():
    ids, texts = [1, 2, None, 4, 5, 6], ["a" * 40, None, "é" * 30, "", "b" * 300, "c"]
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
    parts = list(packing.text_parts(iter([batch, batch.slice(3), batch.slice(0, 0)]), 100))
    assert [p.num_rows for p in parts] == [4, 1, 1, 1, 1, 1]
    assert [r for p in parts for r in p.column(0).to_pylist()] == ids + ids[3:]
    assert [r for p in parts for r in p.column(1).to_pylist()] == texts + texts[3:]


def test_packing_without_held_encoder(spark, monkeypatch):
    """Small parts and caches change the memory only: the same rows come out."""
    monkeypatch.setattr(packing, "SMALL_PART_BYTES", 500)
    monkeypatch.setattr(packing, "SMALL_CACHE", 8)
    rng = random.Random(7)
    rows = table(spark, ODD + [(100 + i, " ".join(rng.choice(["that", "under", "x1", "é"]) for _ in range(rng.randint(0, 300)))) for i in range(200)]).repartition(2).persist()
    got, want = (packing.pack_documents(rows, TOKENIZER, group=16, hold_encoder=hold).collect() for hold in (False, True))
    assert got == want and len(got) > 200


# ---- line dedup

def test_line_dedup(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    make = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", "", "", "", ".", ",", "\n"]) for _ in range(n))
    passages, rows, marks = [make(55) for _ in range(4)], [], []
    for i in range(50):
        parts = make(rng.randint(60, 200)).split(" ")
        mark = rng.sample(range(4), rng.randint(0, 2))
        for p in mark:
            k = rng.randrange(len(parts))
            parts = parts[:k] + [passages[p]] + parts[k:]
        rows.append((i, " ".join(parts)))
        marks.append([p for p in mark if passages[p] in rows[-1][1]])
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, None), (53, ""), (53, ""), (None, rows[3][1]), (54, "Thing."), (55, "Thing.")]
    out = linededup.dedup_lines(table(spark, rows))
    assert out.columns[:1] == ["doc_id"] and {"id", "n", "text"} <= set(out.columns)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    seen = set()
    for i, text in rows[:50]:
        r = got[i][0]
        for p in marks[i]:
            assert (passages[p] in r.text) == (p not in seen)
        if not set(marks[i]) & seen:
            assert r.text == text and r.words_deleted == 0
        seen |= set(marks[i])
    assert got[50][0].text.strip() == "" and 3 in got[50][0].deleted_for and got[51][0].text.strip() == ""
    assert got[None][0].text == rows[3][1] and got[52][0].text is None and [r.text for r in got[53]] == ["", ""] and got[55][0].text == "Thing."
    assert linededup.dedup_lines(table(spark, [])).count() == 0


def test_patience_and_blocks():
    assert linededup.patience([1, 2, 3, 9], [7, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]
    a, b = np.arange(20), np.array([*range(10, 20), 99, *range(0, 10)])
    assert linededup.common_blocks(a, b, np.full(21, 5)) == [(0, 10), (11, 21)]  # other order
    assert linededup.common_blocks(a, a, np.full(20, 1)) == []


def test_blocks_that_stand_twice():
    w = np.full(60, 4)
    p, x, y, z = np.arange(10), np.arange(100, 120), np.arange(200, 220), np.arange(300, 310)
    twice, once = np.concatenate([p, x, p]), np.concatenate([y, p, z])
    assert linededup.common_blocks(twice, once, w[:40]) == [(20, 30)]  # twice in the earlier document
    assert linededup.common_blocks(once, twice, w[:40]) == [(0, 10), (30, 40)]  # twice in the later one
    assert linededup.common_blocks(np.concatenate([x, p, p]), np.concatenate([p, y, p]), w[:40]) == [(0, 10), (30, 40)]
    song = np.array([1, 2, 1, 2, 3, 3, 1, 2, 1, 3])  # mostly repeated lines
    assert linededup.common_blocks(np.concatenate([song, x, song[::-1], song]), np.concatenate([y, song, z]), w[:40]) == [(20, 30)]
    assert linededup.common_blocks(np.concatenate([p[:5], x, p[5:]]), once, w[:40]) == []  # in two halves of 20 words


def test_blocks_by_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 25))] for _ in range(2))
        w = [rng.randint(1, 12) for _ in range(4)]
        want = {k for i in range(len(b)) for j in range(i + 1, len(b) + 1) if sum(w[v] for v in b[i:j]) >= 32
                and any(a[k:k + j - i] == b[i:j] for k in range(len(a))) for k in range(i, j)}
        got = linededup.common_blocks(np.array(a, "<u4"), np.array(b, "<u4"), np.array([w[v] for v in b], "<u2"))
        assert {k for p, q in got for k in range(p, q)} == want


def test_passage_that_stands_twice(spark):
    rng = random.Random(9)
    make = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    p = make(60)
    rows = [(1, f"{make(90)} {p} {make(40)} {p} {make(50)}"), (2, f"{make(70)} {p} {make(80)}"), (3, f"{make(30)} {p} {make(60)} {p}")]
    got = {r.doc_id: r for r in linededup.dedup_lines(table(spark, rows)).collect()}
    inner = " ".join(p.split()[20:40])
    assert got[1].text == rows[0][1] and inner not in got[2].text and inner not in got[3].text and got[3].words_deleted > 60


def cut_lines(texts):
    out = []
    for text in texts:
        (_, _, w), = words_of(pa.array([text]))
        out.append(linededup.Lines(w))
    return out


def test_passages_of_51_to_60_words_are_paired_and_deleted():
    rng = random.Random(10)
    vocab = [f"w{i}" for i in range(2000)]
    make = lambda n: [w for _ in range(n) for w in [rng.choice(vocab)] * (rng.randint(1, 30) if rng.random() < 0.02 else 1)][:n]
    missed = 0
    for _ in range(2500):
        p = make(rng.randint(51, 60))
        a, b = cut_lines(" ".join(make(rng.randint(0, 80)) + p + make(rng.randint(0, 80))) for _ in range(2))
        paired = len(np.intersect1d(a.anchors()[1], b.anchors()[1])) > 0
        assert paired == bool(linededup.common_blocks(a.hash.astype("<u4"), b.hash.astype("<u4"), b.words))
        missed += not paired
    assert missed <= 2  # 31 words or fewer in whole lines


def test_anchors_of_a_row_do_not_depend_on_its_neighbours():
    rng = random.Random(11)
    texts = [" ".join(rng.choice("a b c d. e f g\nh".split(" ")) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    (_, _, w), = words_of(pa.array(texts))
    row, h = linededup.Lines(w).anchors()
    for i, lines in enumerate(cut_lines(texts)):
        assert sorted(h[row == i]) == sorted(lines.anchors()[1])


def test_holder_of_a_part_does_not_protect_the_rest(spark):
    rng = random.Random(12)
    make = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows, inner = [], {}
    for k in range(0, 600, 3):
        p = make(60)
        part = rng.randrange(24, 41)
        at = rng.randint(0, 60 - part)
        rows += [(k, " ".join(make(40) + p[at:at + part] + make(40))), (k + 1, " ".join(make(50) + p + make(30))), (k + 2, " ".join(make(30) + p + make(50)))]
        inner[k + 2] = " ".join(p[20:40])
    got = {r.doc_id: r.text for r in linededup.dedup_lines(table(spark, rows)).collect()}
    assert [k for k, x in inner.items() if x in got[k]] == []


# ---- Jaccard join

def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("block_rows", [2048, 20])
def test_jaccard_equals_brute_force(spark, block_rows):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    base, rows = [rng.choice(vocab) for _ in range(120)], []
    for i in range(260):
        if i % 7 < 3:
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        elif i % 7 == 3:
            w = base[:60] + [rng.choice(vocab) for _ in range(60)]
        else:
            w = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(table(spark, rows), block_rows=block_rows).collect()}
    assert got == brute_components(rows)


def test_jaccard_odd_rows(spark):
    got = sorted(jaccard.similar_documents(table(spark, ODD)).collect(), key=str)
    assert len(got) == len(ODD)
    of = {r.doc_id: r.component_id for r in got}
    assert of[1] == 1 and of[2] == 2 and of[3] == 3 and of[5] == 4 and of[6] == 4 and of[None] is None
    kept = sorted((r.doc_id for r in jaccard.keep_one(table(spark, ODD)).collect() if r.doc_id is not None))
    assert kept == [1, 2, 3, 4, 5, 7, 8]  # row 5 with the text of row 6 stays, that with the text of row 4 goes
    assert jaccard.similar_documents(table(spark, [])).count() == 0


def test_rows_of_one_id_are_kept_by_their_own_texts(spark):
    """Different texts under one id stay, and do not chain the groups of their other copies."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, b), (3, a), (3, b), (3, c), (4, c), (5, c + " more"), (6, b), (7, "own words " + c[:60]), (7, "own words " + c[:60]), (8, ""), (8, None), (None, a), (9, a), (9, "quite another text of seven words")]
    names = ["doc_id", "text", "sid", "COMP", "number"]  # names that the operator uses itself
    docs = spark.createDataFrame([(i, t, "s", 1, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, sid string, COMP int, number int")
    kept = jaccard.keep_one(docs)
    assert kept.columns == names
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [x for x in got if x[0] != 8] == sorted([(1, a), (2, b), (3, c), (7, "own words " + c[:60]), (None, a), (9, "quite another text of seven words")], key=str)
    assert len([x for x in got if x[0] == 8]) == 1
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_rtree_finds_every_pair_within_the_bound():
    rng = np.random.default_rng(1)
    points = rng.poisson(2, (300, jaccard.GROUPS)).astype(np.int64)
    points[100:200] = points[:100] + (rng.random((100, jaccard.GROUPS)) < 0.02)
    n = points.sum(1)
    q, p = jaccard.RTree(points, n).search(points, n)
    want = {(i, j) for i in range(300) for j in range(300) if 100 * n[i] >= 80 * n[j] and 100 * n[j] >= 80 * n[i] and 180 * np.minimum(points[i], points[j]).sum() >= 80 * (n[i] + n[j])}
    assert set(zip(q.tolist(), p.tolist())) == want and len(want) > 400


# ---- extraction

def test_main_text():
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><a href="/x">menu</a></nav><div class="ad">Buy this long advert of many words now and here.</div>'
            '<article><h1>Head &amp; title</h1><p><b>One  two<br><p>three\nfour &copy;</p><form>name <input></form><aside>side</aside><ul><li>a<li>b</ul></article>'
            '<div id="comments"><p>reader comment that is long and says much about it</p></div><footer>&copy; foot</footer></body></html>')
    assert density.main_text(page) == "Head & title\nOne two\nthree four ©\na\nb"
    assert density.main_text(None) == "" and density.main_text("") == "" and density.main_text("plain < text") == "plain < text"
    assert density.main_text("<div><div class=menu><a href=x>home</a><a>b</a></div><div><p>The long body of the page.</p><p>With a second paragraph of text.</p></div></div>") == "The long body of the page.\nWith a second paragraph of text."


STORY = "".join(f"<p>Paragraph {i} of the story, with words enough to be read, and a second part of it.</p>" for i in range(6))
LINKS = "".join(f"<li><a href=/{i}>Menu entry {i}</a>" for i in range(5))


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><meta charset=utf-8><body><div>{STORY}</div>",  # head without end
    f"<head><title>T</title><div>{STORY}</div>",
    f"<body><div><p class=ad>Buy now{STORY}</div>",
    f"<body><ul><li class=share>Share it<li>other</ul><div>{STORY}</div>",
    f"<body><div><nav><ul>{LINKS}</ul></div><div>{STORY}</div>",  # an ancestor's end tag ends the menu
    f"<body><aside>Aside<article>{STORY}</article>",
    f"<body><div class=ad>Buy now<div>{STORY}</div>",
    f"<body><label>Name<div>{STORY}</div>",
    f"<body><svg><path d=1><div>{STORY}</div>",
    f"<body><form action=/><input name=x><div>{STORY}</div></form>",
    f"<body><div class='layout has-sidebar'><nav><ul>{LINKS}</ul></nav><div>{STORY}</div></div>",
    f"<body><div id='page-share'><main>{STORY}</main></div>",
])
def test_boilerplate_ends_and_wrappers(page):
    text = density.main_text(page)
    assert all(f"Paragraph {i} of the story" in text for i in range(6)), text
    assert "Menu entry" not in text


def test_boilerplate_is_still_left_out():
    assert "Related work" in density.main_text(f"<body><article><h2 id='related-work'>Related work</h2>{STORY}</article>")
    replies = "".join(f"<article class=comment-body><p>Reply {i}: {'and so on and on, ' * 20}</p></article>" for i in range(9))
    text = density.main_text(f"<body><article>{STORY}</article><div class=comments>{replies}</div><aside class=related><article><p>Teaser text.</p></article></aside><p><button><div>Press</div></button>")
    assert "Paragraph 5" in text and not any(x in text for x in ("Reply", "Teaser", "Press"))


def test_extraction_frame(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "<p>x</p>", 2), (None, "v", "<p>" + "y " * 100000, 3)], "page_id bigint, url string, html string, id int")
    got = {r.page_id: r.text for r in density.extract_main_text(pages).collect()}
    assert got[1] == "" and got[2] == "x" and len(got[None]) == 199999
    assert density.extract_main_text(pages.limit(0)).count() == 0


# ---- language model

def brute_scores(rows):
    texts = [(i, words(t) + ["\n"]) for i, t in rows]
    c, c2 = collections.Counter(), collections.Counter()
    for i, t in texts:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            c.update(t)
            c2.update(zip(["\n"] + t, t))
    n, followers = sum(c.values()), collections.Counter(a for a, _ in c2)
    low = n + 0.1 * (len(c) + 1)
    out = []
    for i, t in texts:
        score = 0.0
        for a, b in zip(["\n"] + t, t):
            p = (c[b] + 0.1) / low
            if c[a]:
                p = max(c2[a, b] - 0.75, 0) / c[a] + 0.75 * followers[a] / c[a] * p
            score += math.log10(p)
        out.append((-1 if i is None else i, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / low) for w in t), score))
    return sorted(out)


@pytest.mark.parametrize("shard_tokens", [1_500_000, 500])
def test_lm_equals_brute_force(spark, shard_tokens):
    rng = random.Random(7)
    rows = [r for r in ODD if r[0] != 8] + [(100 + i, " ".join(rng.choice("the of and whether under over again more most some".split()) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_lm.score_documents(table(spark, rows), shard_tokens=shard_tokens).collect())
    want = brute_scores(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(abs(g[4] - w[4]) < 1e-8 for g, w in zip(got, want))
    assert all(abs(g[5] - w[5]) < 0.05 * w[1] + 0.05 for g, w in zip(got, want) if w[1] > 1 and w[0] >= 100)  # quantised
    assert ngram_lm.score_documents(table(spark, [])).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    v = np.unique(rng.integers(0, 100000, 5000))
    ef = ngram_lm.EliasFano(v, 100000, lambda a: a)
    x = rng.integers(0, 100000, 20000)
    assert (ef.get() == v).all() and (ef.successor(x) == np.searchsorted(v, x)).all()
    found = ef.find(x)
    assert ((found >= 0) == np.isin(x, v)).all() and (v[found[found >= 0]] == x[found >= 0]).all()


def test_lm_split_contexts(spark, monkeypatch):
    """Parts of a frequent context keep base scores exact."""
    rows = [(i, "the a the b the c the d " * 20) for i in range(1, 40)]
    want = brute_scores(rows)
    uni = ngram_lm.Unigrams(1000, 3, np.array([5, 9], np.uint64), np.array([900, 50]))
    uni.split = np.array([4, 1])
    assert uni.parts(np.array([5, 9, 7], np.uint64)).tolist() == [4, 1, 1]
    got = sorted((r.doc_id, r.base_score) for r in ngram_lm.score_documents(table(spark, rows)).collect())
    assert all(abs(g[1] - w[4]) < 1e-9 for g, w in zip(got, want))


@pytest.mark.parametrize("limits", [{}, {"top_words": 4}, {"top_words": 12, "split_tokens": 100}, {"top_words": 12, "split_tokens": 100, "shard_tokens": 700}])
def test_lm_scores_do_not_depend_on_input_limits(spark, limits):
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(300)]
    pick = rng.choices(range(300), [1 / (i + 1) for i in range(300)], k=20000)
    rows = [(i, " ".join(vocab[v] for v in pick[i * 50:i * 50 + 50])) for i in range(400)]
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_lm.score_documents(table(spark, rows), **limits).collect())
    want = brute_scores(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(abs(g[4] - w[4]) < 1e-8 for g, w in zip(got, want))
    assert max(abs(g[5] - w[5]) / w[1] for g, w in zip(got, want)) < 0.01  # quantised


@pytest.mark.parametrize("hold", [1 << 20, 40])
def test_successors_of_split_contexts_in_few_rows(hold):
    """One row a bucket and task (or ``hold`` pairs), however many contexts are split; distinct successors are exact."""
    rng = random.Random(5)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(60)) for _ in range(300)]
    column = pa.array([*texts, None, ""])
    words_, counts = np.unique(np.concatenate([ngram_lm._tokens(w)[1] for _, _, w in words_of(column)]), return_counts=True)
    top = np.argsort(-counts)[:50]
    uni = ngram_lm.Unigrams(int(counts.sum()), len(words_), words_[top], counts[top], 20)
    assert (uni.split > 1).sum() > 20
    followers = collections.defaultdict(set)
    for _, _, w in words_of(column):
        for a, b in zip(*(x.tolist() for x in ngram_lm._tokens(w)[1:])):
            followers[a].add(b)
    rows = []
    for task in (column.slice(0, 150), column.slice(150)):
        made = [r for batch in ngram_lm._hot_pairs(uni, 3, hold)(pa.record_batch([task.slice(k, 25)], names=["text"]) for k in range(0, len(task), 25)) for r in batch.to_pylist()]
        assert hold == 40 or len(made) <= 3
        rows += made
    rows.sort(key=lambda r: r["bucket"])
    got = collections.Counter()
    for batch in ngram_lm._count_kinds(uni)([pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int32()), ("contexts", pa.binary()), ("runs", pa.binary()), ("words", pa.binary())]))]):
        for r in batch.to_pylist():
            got[int(uni.words[uni.split > 1][r["number"]])] += r["n"]
    assert got == {int(w): len(followers[int(w)]) for w in uni.words[uni.split > 1]}
