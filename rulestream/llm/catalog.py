"""Registered queries of the training-data operators, and DuckDB SQL for those that SQL can express.

Every query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.llm import bpe, collisions, density, jaccard, kdtree, linededup, markov, mil, ngram_lm, packing, semicrf, sketches, strtree
from rulestream.llm.common import crc32_mod, importable, read_table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "lines_deleted", "words_deleted", "deleted_for", "text")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = mil.train(docs, read_table(spark, sf_dir, "labels"), crc32_mod(F.col("doc_id"), 4) != 2)
    return mil.score_quality(docs, model).select("doc_id", (crc32_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> counts the base spans, which base_sha256 covers; ``spans`` holds the method's too."""
    docs = read_table(spark, sf_dir, "documents")
    found = semicrf.find_personal_data(docs, semicrf.learn(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("bigint").alias(f"n_{kind}") for kind in semicrf.KINDS]
    return found.select("doc_id", *counts, F.sha2(semicrf.digest(base).cast("binary"), 256).alias("base_sha256"), semicrf.digest(F.col("spans")).alias("spans"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.extract_main_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> counts the base spans, which base_sha256 covers; ``spans`` holds the method's too, of kind random."""
    docs = read_table(spark, sf_dir, "documents")
    found = markov.find_secrets(docs, markov.learn(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("bigint").alias(f"n_{kind}") for kind in markov.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(markov.digest(base).cast("binary"), 256).alias("base_sha256"), markov.digest(F.col("spans")).alias("spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strtree.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (op1_line_dedup, op2_packing, op3_jaccard_join, op4_quality, op5_personal_data, op6_near_vectors, op7_bpe, op8_main_text, op9_lm_score, op10_top_k, op11_secrets, op12_hard_negatives, op13_lexical_search, pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(f):
        return lambda spark, sf_dir: f(importable(spark), sf_dir)

    return {f.__name__: ready(f) for f in _QUERIES}


_COMPONENTS = """
reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN two_way l ON l.a = r.other),
roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

_ORACLES = {
    "op3_jaccard_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingle AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM shingle),
flat AS (SELECT doc_id, unnest(s) AS x FROM shingle),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM flat p JOIN flat q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 80 * (m.n + n.n - c)),
two_way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
nodes AS (SELECT doc_id AS id FROM documents),""" + _COMPONENTS + """
SELECT z.doc_id, z.n::BIGINT AS n_shingles, r.component_id FROM sizes z JOIN roots r ON r.id = z.doc_id""",
    "op6_near_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, label, [x::DOUBLE for x in embedding] AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
two_way AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e) WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),""" + _COMPONENTS + """,
degree AS (SELECT a, count(*) AS n FROM two_way GROUP BY a)
SELECT r.id AS vec_id, coalesce(d.n, 0)::BIGINT AS n_links, r.component_id, r.id = r.component_id AS kept FROM roots r LEFT JOIN degree d ON d.a = r.id""",
    "op10_top_k": """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT * FROM r WHERE rank <= 10""",
    "op13_lexical_search": """
WITH terms AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT row_number() OVER () AS d, doc_id, w, len(w)::BIGINT AS n FROM terms WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM sized),
tf AS (SELECT d, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT d, doc_id, n, unnest(w) AS t FROM sized) GROUP BY ALL),
asked AS (
  SELECT item_id, unnest(list_distinct(list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> ''))) AS t
  FROM benchmark WHERE text IS NOT NULL),
weights AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS wt FROM tf, totals GROUP BY t),
scores AS (
  SELECT item_id, doc_id, sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // total)))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weights USING (t), totals GROUP BY item_id, d, doc_id),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM r WHERE rank <= 50""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
