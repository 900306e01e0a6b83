"""Registered queries of this subpackage, with production parameters, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.llm import bpe, hard_negatives, lang_id, mixing, near_vectors, prefix_trie, repeats, shingle_join, spotsigs, token_counts, token_store, topk, toxicity
from factlake.session import materialize

#: Name of the vocabulary file; a path may be given instead (see ``vocabulary``).
VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(~held_out()))
    return lang_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    store = token_store.write_store(docs, vocabulary())
    keys = docs.select("doc_id").distinct()
    return token_store.fetch(store, keys).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = materialize(token_counts.length_histogram(_read(spark, sf_dir, "documents"), vocabulary()))
    return token_counts.limit_table(histogram)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(_read(spark, sf_dir, "embeddings"), 0.93)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(_read(spark, sf_dir, "documents"), vocabulary())
    return bpe.digests(bpe.decode(ids, vocabulary()))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shingle_join.linked_components(_read(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def domain() -> Column:
    """Domain of a source: its number modulo 4; sources without a number are ``other``."""
    number = F.regexp_extract(F.col("source").cast("string"), r"(\d+)$", 1)
    return F.when(F.coalesce(number, F.lit("")) == "", "other").otherwise(F.concat(F.lit("d"), (F.pmod(number.cast("decimal(38,0)"), F.lit(4))).cast("int").cast("string")))


#: Target weights of the production mix; languages and sources below weigh what they hold.  Sources without a number get
#: their share of the tokens, and the numbered domains divide the rest.
WEIGHTS = {("d0",): 0.4, ("d1",): 0.3, ("d2",): 0.2, ("d3",): 0.1, ("other",): None}


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(_read(spark, sf_dir, "documents"), WEIGHTS, 1.0, domain(), max_epochs=4, seed=11)
    return taken.select("doc_id", "mix_epoch", "mix_domain", "lang", "source", "mix_tokens")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    labels = _read(spark, sf_dir, "labels").where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn, totals = toxicity.draw(labels.where(~held_out()))
    model = toxicity.fit(docs.select("doc_id", "text").join(drawn, "doc_id"), totals=totals)
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


#: Turns that a rebuilt conversation takes over at most.
MOST_HEAD = 5


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST_HEAD + 1))
    base = F.col("conv_id") - F.col("conv_id") % 100
    return prefix_trie.node_table(_read(spark, sf_dir, "conversations"), base, head, MOST_HEAD)


def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_edited(_read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    label = F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, rows.where(vec % 100 == 0), n_positives=5, n_negatives=5, least_percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_id, op2_token_store, op3_token_counts, op4_near_vectors, op5_bpe, op6_substring_dedup, op7_top_k, op8_shingle_join, op9_source_mix, op10_toxicity, op11_prefix_trie, op12_spotsigs, op13_hard_negatives)
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op4_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""",
    "op6_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w)),
least AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i FROM win JOIN least USING (s) WHERE first < doc_id), range(13) AS r(k)),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op7_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_prefix_trie": """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END) AS r FROM ids),
h AS (SELECT c, c - c % 100 AS base, xor(r, 4294967295::BIGINT) % 6 AS h FROM crc),
t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, [coalesce(role, ''), coalesce(text, '')] AS v
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, list(v ORDER BY p) AS v FROM t GROUP BY c),
b AS (SELECT h.c, list_concat(coalesce(base.v[1:h.h], []), coalesce(own.v[h.h + 1:], [])) AS v FROM h LEFT JOIN s base ON base.c = h.base LEFT JOIN s own ON own.c = h.c),
m AS (SELECT c, d, v[1:d] AS path, len(v) = d AS ends FROM (SELECT c, v, unnest(generate_series(0, len(v))) AS d FROM b)),
n AS (SELECT d, path, min(c) AS id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ends FROM m GROUP BY d, path),
k AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
w AS (
  SELECT n.*, coalesce(k.kids, 0) AS kids, u.id AS parent, (n.n - 1) * coalesce(length(n.path[n.d][2]), 0) AS saved
  FROM n LEFT JOIN k ON k.d = n.d AND k.path = n.path LEFT JOIN n u ON u.d = n.d - 1 AND u.path = n.path[1:n.d - 1]),
a AS (SELECT x.d, x.path, sum(w.saved)::BIGINT AS saved, count(*) FILTER (WHERE w.kids = 0) AS leaves FROM w JOIN m x ON x.c = w.id AND x.d <= w.d GROUP BY x.d, x.path)
SELECT w.id AS conv_id, w.d::BIGINT AS depth, w.parent AS parent_conv_id, w.n::BIGINT AS n_convs, w.kids::BIGINT AS n_children, a.leaves::BIGINT AS n_leaves, a.saved AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN a ON a.d = w.d AND a.path = w.path
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS a, c.vec_id AS b, q.label = c.label AS same, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
p AS (SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM s WHERE same) WHERE r <= 5),
n AS (
  SELECT p.a, p.b, p.score AS positive_score, s.b AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INTEGER AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, b AS positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    "op8_shingle_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
}
