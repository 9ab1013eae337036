"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import balltree, decontamination, exact_dedup, html, language, minhash, packing, quality, secrets, separators, tokenfiles, warc, whitening

#: oracle SQL by query name
SQL: dict[str, str] = {}
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_table(spark, sf_dir, "documents"))


SQL["op5_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.NearDuplicates(words=3, percent=85)(_table(spark, sf_dir, "documents"))


SQL["op6_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), spot AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM words WHERE len(w) > 0
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 2], ' ') AS g FROM spot
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents
  UNION
  SELECT y, r FROM reach JOIN edges ON x = v
), c AS (
  SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL["op7_decontamination"] = """
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') FROM benchmark
), sizes AS (
  SELECT DISTINCT least(len(w), 5) AS size FROM words WHERE kind = 'i' AND len(w) > 0
), spot AS (
  SELECT kind, id, w, size, unnest(range(1, len(w) - size + 2)) AS k
  FROM words JOIN sizes ON CASE kind WHEN 'i' THEN size = least(len(w), 5) ELSE size <= len(w) END
), s AS (
  SELECT DISTINCT kind, id, size, array_to_string(w[k:k + size - 1], ' ') AS g FROM spot
), n AS (
  SELECT id AS item_id, count(*) AS n_item_shingles FROM s WHERE kind = 'i' GROUP BY id
), hits AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM s d JOIN s i ON d.g = i.g AND d.size = i.size WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL
)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles::DOUBLE AS containment
FROM hits JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item_shingles
"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out("doc_id")))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", F.to_json("languages").alias("languages"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op2_warc"] = """
WITH t AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM t
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "finding", "candidate", "score", "is_secret")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.cluster(_table(spark, sf_dir, "embeddings"))


def _clustering_sql(rounds: int = 5, k: int = 40) -> str:
    """Rounds as one table each; distances and floors in whole numbers."""
    sql = f"""
WITH p AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS c, v AS w FROM p ORDER BY sha256('2:' || vec_id) LIMIT {k}
)"""
    for r in range(rounds + 1):
        sql += f""", d{r} AS (
  SELECT vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - w[i]) * (v[i] - w[i])))::BIGINT AS d FROM p, c{r}) GROUP BY vec_id
)"""
        if r < rounds:
            sql += f""", s{r} AS (
  SELECT c, list(m ORDER BY i) AS w FROM (
    SELECT c, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM d{r}, range(1, 65) t(i) GROUP BY c, i
  ) GROUP BY c
), c{r + 1} AS (
  SELECT c{r}.c, coalesce(s{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN s{r} USING (c)
)"""
    return sql + f"""
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM d{rounds} JOIN c{rounds} USING (c)
"""


SQL["op11_centroids"] = _clustering_sql()


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_table(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
