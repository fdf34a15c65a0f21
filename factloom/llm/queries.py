"""The registered query of each operator over its whole table, and the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cover_search, exact_dedup, language_id, lm_scoring, near_dedup, packing, prefix_trie, private_data, quality, suffix_dedup, toxicity, tree_lloyd
from .fitting import remainder
from .textops import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that long repeats take away, and a digest of what is left."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def _held_out_scores(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.trained(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    return _held_out_scores(toxicity.score(docs, net), remainder(F.col("doc_id"), 4) == 2)


def op3_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the benchmark's passages as the target and all documents as the background."""
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.cross_entropy_difference(docs, table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), width=5, percent=75)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.trained(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    return _held_out_scores(quality.score(docs, model), remainder(F.col("doc_id"), 5) == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("key", "depth", "prefix")


OP7_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""

#: All links of all pairs that share a shingle, and what can be reached by them.
OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(root) AS component_id FROM r GROUP BY 1) c ON c.v = d.doc_id
"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.default_tokenizer())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, protos = language_id.learn(docs, remainder(F.col("doc_id"), 3) != 1)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return language_id.predict(docs, langs, protos).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.default_tokenizer())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_dual_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters, squared distances and their sums, and a digest of each vector's final centroid."""
    found, centroids = tree_lloyd.lloyd(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024.0, dims=64, seed=3)
    return tree_lloyd.inertia(found, centroids).withColumn("centroid_sha256", tree_lloyd.centroid_digest(centroids)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return private_data.digests(private_data.find_spans(docs, private_data.learn(docs)))


#: The unsigned crc32 of the decimal id, modulo 4, byte by byte over a table of 256 remainders.
OP11_SQL = """
WITH RECURSIVE tab AS (SELECT range AS i, 0 AS k, range AS v FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT conv_id, conv_id::VARCHAR AS digits, 4294967295 AS v FROM (SELECT DISTINCT conv_id FROM t)
  UNION ALL SELECT conv_id, substr(digits, 2), xor(crc.v >> 8, tab.v) FROM crc JOIN tab ON k = 8 AND i = (xor(crc.v, ord(substr(digits, 1, 1))) & 255) WHERE digits <> ''),
c AS (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE digits = ''),
r AS (SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos < h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h),
s AS (SELECT c.conv_id, list(sha256(role.length() || ':' || role || text) ORDER BY pos) FILTER (pos IS NOT NULL) AS path,
    list(len([w for w in regexp_split_to_array(text, '[\x20\x09-\x0D]+') if w <> '']) ORDER BY pos) FILTER (pos IS NOT NULL) AS words
  FROM c LEFT JOIN r USING (conv_id) GROUP BY ALL),
p AS (SELECT conv_id, coalesce(path, []) AS path, words, unnest(range(coalesce(len(path), 0) + 1)) AS depth FROM s),
n AS (SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(words[depth]), 0) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(path)), '') AS ends
  FROM p GROUP BY ALL),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
u AS (SELECT node[1:d] AS node, sum((n_convs - 1) * words) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN u USING (node) LEFT JOIN n o ON m.depth > 0 AND o.node = m.node[1:m.depth - 1]
"""


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """A round's assignment and its centroids as two tables, for each round."""
    assign = """a{r} AS MATERIALIZED (SELECT row, v, c AS cluster, d FROM (SELECT row, v, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v, w)]) AS d FROM v, c{r})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)"""
    move = """m{r} AS (SELECT cluster AS c, list(floor_mean ORDER BY i) AS w FROM (
    SELECT cluster, i, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster),
c{s} AS MATERIALIZED (SELECT c, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (c))"""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v AS w FROM v WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id), v LIMIT {k})"""]  # fmt: skip
    for r in range(rounds):
        parts += [assign.format(r=r), move.format(r=r, s=r + 1)]
    parts.append(assign.format(r=rounds))
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} ON c = cluster"""


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op3_cover_tree_top_k": OP3_SQL, "op5_minhash_near_dedup": OP5_SQL, "op7_exact_dedup": OP7_SQL, "op11_prefix_trie": OP11_SQL, "op12_dual_tree_lloyd": _lloyd_sql()}
