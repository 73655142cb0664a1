"""The registered queries of this subpackage, and their SQL twins.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe_counts, cover_tree, crf_languages, kneser_ney, line_join, multi_index, ns_bounds, order_minhash, prefix_crc, raking, text_density, viterbi_pieces, winnowing
from larder.llm.common import read_table


def piece_model() -> str:
    """The place of the public SentencePiece file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding gives the text back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = viterbi_pieces.encode(docs, piece_model(), exact="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "round_trip", "ids")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return multi_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, [x::DOUBLE for x in embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id GROUP BY e.vec_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", crf_languages.held_out(F.col("doc_id")).alias("held_out"), "text")
    return crf_languages.identify(texts, crf_languages.learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every document."""
    return order_minhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, limit and decision for every document."""
    return kneser_ney.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that match an earlier line."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_join.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


OP6_SQL = f"""WITH {line_join.dedup_lines_sql("documents")}
SELECT doc_id, text, n_lines, n_removed FROM deduped"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated weight, probability and decision for every document."""
    return raking.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


OP7_SQL = f"""WITH {raking.mix_sql("documents")}
SELECT doc_id, source, lang, topic, n_tokens, weight, probability, sampled FROM mixed"""


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every hundredth vector."""
    return cover_tree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 1024)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
    list_sum([p[1] * p[2] for p in list_zip(q.v, r.v)])::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = text_density.extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    counted = bpe_counts.count_tokens(docs, piece_model())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document against the texts of the benchmark."""
    drawn = prefix_crc.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = """
WITH RECURSIVE bits(b, k, v) AS (
  SELECT r.range, 0, r.range FROM range(256) r
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
texts AS (
  SELECT true AS own, row_number() OVER () AS no, doc_id, text FROM documents
  UNION ALL SELECT false, -row_number() OVER (), NULL, text FROM benchmark),
cut AS MATERIALIZED (
  SELECT own, no, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM texts),
grams AS MATERIALIZED (
  SELECT own, no, array_to_string(w[i:i + n - 1], ' ') AS gram, count(*) AS c
  FROM (SELECT own, no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n) GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT gram, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode(gram)), 2),
      lambda i: ('0x' || substr(hex(encode(gram)), i, 2))::BIGINT)),
    lambda crc, b: xor(crc >> 8, t[xor(crc & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT gram FROM grams), crc_table),
counts AS (
  SELECT bucket, coalesce(sum(c) FILTER (own), 0) AS s, coalesce(sum(c) FILTER (NOT own), 0) AS t
  FROM grams JOIN hashed USING (gram) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM counts, totals),
weights AS (SELECT no, sum(c) AS n, sum(c * g) AS weight FROM grams JOIN hashed USING (gram) JOIN gain USING (bucket) WHERE own GROUP BY no),
scored AS (
  SELECT doc_id, len(w) >= 20 AS may, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM cut LEFT JOIN weights USING (no) WHERE own),
ranked AS (SELECT *, row_number() OVER (ORDER BY may DESC, score DESC, doc_id) AS place, count(*) FILTER (may) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every usable vector."""
    found = ns_bounds.cluster(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql(rounds: int = 3) -> str:
    """One pair of CTEs a round."""
    near = """near{r} AS MATERIALIZED (
      SELECT vec_id, q, arg_min(j, (d, j)) AS j, min(d) AS d
      FROM (SELECT vec_id, no, q, j, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(q, c)])::BIGINT AS d FROM v, c{r})
      GROUP BY no, vec_id, q)"""
    moved = """c{n} AS MATERIALIZED (
      SELECT j, coalesce(m.c, old.c) AS c FROM c{r} old LEFT JOIN (
        SELECT j, list(x ORDER BY i) AS c FROM (
          SELECT j, i, floor(sum(q[i]) / count(*))::BIGINT AS x FROM near{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY j, i)
        GROUP BY j) m USING (j))"""
    parts = []
    for r in range(rounds):
        parts += [near.replace("{r}", str(r)), moved.replace("{r}", str(r)).replace("{n}", str(r + 1))]
    return """WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS no, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
      WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h) - 1 AS j, c FROM (SELECT sha256('1:' || vec_id) AS h, q AS c FROM v ORDER BY h LIMIT 16)),
    """ + ",\n".join([*parts, near.replace("{r}", str(rounds))]) + f""",
    sums AS (SELECT j, sum(d)::BIGINT AS s FROM near{rounds} GROUP BY j)
    SELECT vec_id, j::INTEGER AS cluster, d AS distance, s AS cluster_inertia, (SELECT sum(s)::BIGINT FROM sums) AS inertia,
      sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM near{rounds} JOIN sums USING (j) JOIN c{rounds} USING (j)"""


OP12_SQL = _op12_sql()


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a passage of the benchmark."""
    return winnowing.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP13_SQL = f"""WITH {winnowing.contamination_sql("documents", "benchmark")}
SELECT * FROM contaminated"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_embedding_near_dedup, op3_language_id, op4_minhash_near_dedup, op5_quality, op6_line_dedup, op7_mixing, op8_top_k, op9_main_text, op10_token_counts, op11_importance_resampling,
                                  op12_centroid_clustering, op13_decontamination)}


def sql() -> dict[str, str]:
    return {"op2_embedding_near_dedup": OP2_SQL, "op6_line_dedup": OP6_SQL, "op7_mixing": OP7_SQL, "op8_top_k": OP8_SQL,
            "op11_importance_resampling": OP11_SQL, "op12_centroid_clustering": OP12_SQL, "op13_decontamination": OP13_SQL}
