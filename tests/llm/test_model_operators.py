"""Quality classifier, personal data, near vectors, top-k search, pipeline."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulestream.llm import collisions, kdtree, mil, semicrf

DDL = "doc_id bigint, text string, score string, v int"


def quality_rows(n=240):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randint(20, 200)))
        if i % 4 == 0:
            text = text + " " + " ".join(f"{word().upper()}!!" for _ in range(60))
        rows.append((i, text, "x", 0, int(i % 4 != 0)))
    return rows


def test_quality_separates_held_out_documents(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([r[:4] for r in rows], DDL)
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    model = mil.train(docs, labels, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in mil.score_quality(docs, model).collect()}
    held = [(got[r[0]] >= 0.7) == bool(r[4]) for r in rows if r[0] % 3 == 0]
    assert sum(held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(1, None, "a", 1), (1, None, "a", 1), (2, "", "b", 1), (None, "x " * 100000, "c", 1)], DDL)
    scores = [r.score for r in mil.score_quality(odd, model).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    kept = mil.filter_quality(docs, model)
    assert kept.columns == docs.columns and 0.6 * len(rows) < kept.count() < 0.9 * len(rows)
    assert mil.score_quality(docs.limit(0), model).count() == 0
    assert mil.train(docs, labels.limit(0), F.lit(True)) is None
    one = mil.train(docs, labels.where("quality = 1"), F.lit(True))
    assert all(abs(r.score - 0.99) < 0.02 for r in mil.score_quality(docs, one).collect())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute_spans(t):
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m)) <= 19 and semicrf.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(4000):
        t = "".join(rng.choice("aB1 9@.+-()%_é0") for _ in range(rng.randint(0, 60)))
        assert semicrf.base_spans(t) == brute_spans(t), t
    t = "x 4539 1488 0343 6467 y 4111111111111111 +1 (743) 555-3824 a.b@c.d.e@f.g 1.2.3.256 001.2.3.4"
    assert semicrf.base_spans(t) == brute_spans(t)


def test_personal_data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        w = ["word%s" % "abcdefgh"[rng.randrange(8)] for _ in range(40)]
        w[rng.randrange(40)] = rng.choice([f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"u{i}@mail.example.com", "10.1.2.3", "4111111111111111", "plain"])
        rows.append((i, " ".join(w), "s", 1))
    docs = spark.createDataFrame(rows + [(500, None, "s", 1), (501, "", "s", 1), (None, "a@b.cd", "s", 1), (502, "call (743) 555-3824 now", "s", 1), (503, "on 2024-01-02 12:30:11 of 1,234,567 v1.2.3", "s", 1), (504, "7 " * 20000, "s", 1)], DDL)
    w = semicrf.learn(docs)
    got = {r.doc_id: r.spans for r in semicrf.find_personal_data(docs, w).collect()}
    for i, t, _, _ in rows:
        assert [(s.start, semicrf.KINDS.index(s.kind), s.end) for s in got[i] if s.base] == brute_spans(t)
    assert got[500] == [] and got[501] == [] and len(got[None]) == 1
    assert [(s.kind, s.start, s.end, s.base) for s in got[502]] == [("phone", 5, 19, False)]  # found by the method
    assert got[503] == []
    out = {r.doc_id: r for r in semicrf.redact(docs, w).collect()}
    assert out[502].text == "call [PHONE] now" and out[500].text is None and out[None].text == "[EMAIL]" and out[503].score == "s"
    assert semicrf.find_personal_data(docs.limit(0), w).count() == 0 and semicrf.learn(docs.where("doc_id = 501")) is None
    digest = semicrf.find_personal_data(docs.where("doc_id = 502"), w).select(semicrf.digest(F.col("spans")).alias("d")).first().d
    assert digest == "phone:5:19"


def test_decoding_equals_all_segmentations():
    rng = random.Random(8)
    w = np.random.default_rng(8).normal(0, 1.5, (semicrf.N_FEATURES, len(semicrf.KINDS)))
    found = 0
    for _ in range(150):
        t = "".join(rng.choice(["a ", "555-", "3824", "743", ".", " ", "@", "b.cd", "10.", "2"]) for _ in range(rng.randint(3, 9)))
        first, last, cands = semicrf.segments(t, 0, len(t))
        cands = list(cands)
        score = semicrf._scored(t, first, last, cands, w).max(1) if cands else []

        def best(at):
            return max([0.0] + [score[k] + best(j) for k, (i, j, _) in enumerate(cands) if i >= at])

        got = semicrf.decode(t, 0, len(t), w)
        assert abs(sum(s for *_, s in got) - best(0)) < 1e-9
        assert all(x[2] <= y[0] for x, y in zip(got, got[1:])) and all(semicrf._kind_check(k, t[a:b]) for a, k, b, _ in got)
        found += len(got)
    assert found > 20


def test_personal_data_in_other_notations_and_long_runs():
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    text = lambda x: " ".join("word%s" % rng.choice("abcdefgh") for _ in range(12)) + f" {x} " + " ".join("word%s" % rng.choice("abcdefgh") for _ in range(12))

    def card():
        while not semicrf.luhn(d := digits(16)):
            pass
        return d

    known = [lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), card, lambda: f"u{digits(2)}@mail.example.com", lambda: "plain"]
    w = semicrf.train([p for _ in range(400) for p in semicrf.pieces(text(rng.choice(known)()))])
    new = [(3, lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"), (3, lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"), (3, lambda: f"{digits(3)}.{digits(3)}.{digits(4)}"),
           (2, lambda: "/".join(re.findall("....", card()))), (1, lambda: "[.]".join(str(rng.randrange(256)) for _ in range(4)))]
    hits = extra = 0
    for _ in range(300):
        kind, make = rng.choice(new)
        x = make()
        t = text(x)
        got = [s[:3] for s in semicrf.all_spans(t, w) if not s[3]]
        hits += (t.index(x), kind, t.index(x) + len(x)) in got
        extra += len(got)
    assert hits >= 0.95 * 300 and hits >= 0.95 * extra, (hits, extra)
    for t in ("1" * 200_000, "1.2." * 20_000, "7 " * 20_000, "x" * 100_000 + "@" + "y" * 500 + ".com"):
        assert [s[:3] for s in semicrf.all_spans(t, w) if s[3]] == semicrf.base_spans(t)
        assert "".join(semicrf.pieces(t)).replace(" ", "") in t.replace(" ", "") and max(map(len, semicrf.pieces(t))) <= semicrf.PIECE


def vectors(spark, n=400, dim=16):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, dim))
    x[100:200] = x[:100] + rng.standard_normal((100, dim)) * rng.choice([0.02, 0.15, 0.2], (100, 1))
    x[200:260] = x[7] + rng.standard_normal((60, dim)) * 0.05
    x[260:280] = x[9]
    rows = [(i, [float(v) for v in x[i]], int(i % 100 // 50) if i < 380 else None, "e") for i in range(n)]
    rows += [(900, None, 1, "e"), (901, [0.0] * dim, 1, "e"), (902, [1.0] * (dim - 1) + [None], 1, "e"), (903, [float("nan")] * dim, 1, "e"), (904, [1.0, 2.0], 1, "e"), (905, [], 1, "e"), (None, [1.0] * dim, 1, "e")]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, v string")


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_near_vectors_equal_brute_force(spark, block_rows):
    rows, df = vectors(spark)
    x = np.array([r[1] for r in rows[:400]], np.float32).astype(float)
    label = np.array([-1 if r[2] is None else r[2] for r in rows[:400]])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (label[:, None] == label) & (label[:, None] >= 0)
    np.fill_diagonal(link, False)
    comp = np.arange(400)
    for _ in range(50):
        comp = np.minimum(comp, np.where(link, comp, 400).min(1))
    got = {r.vec_id: r for r in collisions.near_duplicates(df, block_rows=block_rows).collect()}
    assert len(got) == len(rows)
    found, all_links = sum(got[i].n_links for i in range(400)), int(link.sum())
    assert 0.97 * all_links <= found <= all_links
    if found == all_links:
        assert [got[i].component_id for i in range(400)] == comp.tolist()
    for i in (900, 901, 902, 903, 905, 399):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert collisions.near_duplicates(df.limit(0)).count() == 0


def test_needed_collisions_meets_recall():
    k = collisions.needed_collisions(32, 1.5, 0.999)
    rng = np.random.default_rng(0)
    hits = (np.abs(rng.standard_normal((20000, 32))) <= 1.5).sum(1)
    assert (hits >= k).mean() >= 0.998 and (hits >= k + 3).mean() < 0.995


@pytest.mark.parametrize("shard_rows", [16384, 60])
def test_top_k_equals_brute_force(spark, shard_rows):
    rows, df = vectors(spark)
    q = {r[0]: [int(np.floor(64 * float(np.float32(v)))) for v in r[1]] for r in rows if r[0] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1])}
    want = {}
    for a in q:
        if a % 20 == 0:
            s = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a and len(q[a]) == len(q[b]))[:20]
            want[a] = [(k + 1, b, -x) for k, (x, b) in enumerate(s)]
    got = {}
    for r in kdtree.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {a: sorted(s) for a, s in got.items()} == {a: s for a, s in want.items() if s}
    assert kdtree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_prunes_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    points = np.floor(64 * np.repeat(rng.standard_normal((8, 16)) * 4, 300, axis=0) + rng.standard_normal((2400, 16)))
    tree = kdtree.Tree(points, np.arange(2400))
    q, i, s = tree.search(points[:5], np.arange(5), np.full(5, -np.inf), 20)
    full = points[:5] @ points.T
    for n in range(5):
        order = sorted((-full[n, j], j) for j in range(2400) if j != n)[:20]
        assert [(-s[k], i[k]) for k in np.flatnonzero(q == n)] == order
    df = spark.createDataFrame([(20, [1.0]), (3, [2.0]), (3, [2.0]), (4, [1e300])], "vec_id bigint, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in kdtree.top_k(df, F.col("vec_id") == 20).orderBy("rank").collect()]
    assert got == [(1, 4, 2**63 - 1), (2, 3, 8192), (3, 3, 8192)]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, rows = text(60), []
    for i in range(120):
        t = text(150)
        if i % 10 == 1:
            t += " " + passage
        if i % 6 == 0:
            t = " ".join(f"{w.upper()}!!" for w in t.split())
        if i % 15 == 2:
            t += f" write to user{i}@mail.example.com"
        rows.append((i, t, "en", "s", len(t)))
    near = rows[3][1].split()
    rows += [(200, rows[3][1], "en", "s", 1), (201, " ".join(near[k] if k % 33 else "zz" for k in range(len(near))), "en", "s", 1)]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 6 != 0)) for r in rows if r[0] < 120], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
    assert {r.doc_id for r in seen["quality"]} == {r[0] for r in rows if r[0] % 6 or r[0] >= 200}
    kept = {r.doc_id: r.text for r in seen["line_dedup"]}
    assert sum(passage in t for t in kept.values()) == 1 and 200 not in kept
    assert not any("@" in r.text for r in seen["personal_data"]) and sum("[EMAIL]" in r.text for r in seen["personal_data"]) == sum("@" in r.text for r in seen["near_duplicates"]) > 0
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in seen["personal_data"]}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])
