"""The registered queries, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import CHAT_SQL, chat_digest, log_of, with_control_strings
from .common import cut, table
from .eenns_clusters import CLUSTERS_SQL, clusters
from .fpe_pii import pii_pseudonyms
from .lz_fingerprint import lz_fingerprints
from .merkle_fixity import Audit, index
from .minmax_dedup import minmax_dedup
from .nbest_pieces import n_best_pieces
from .packing import pack
from .pq_dedup import pq_dedup
from .quality_gam import quality
from .suffix_dedup import substring_dedup
from .toxicity_fm import toxicity
from .turn_repair import REPAIR_SQL, damage, repair_digest


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as WARC files of 1000 records, against a replica derived from them:
    by a hash of page_id some records are altered, some lost. One row a file."""
    body = F.concat_ws("\n", F.lit("WARC/1.0"), F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html").select(F.floor(F.col("page_id") / 1000).alias("file"), F.col("page_id").alias("key"), body.alias("body"))
    own = index(pages, "file", "key", "body")
    fault = F.coalesce(F.substring(F.sha2(F.col("key").cast("string"), 256), 1, 2), F.lit(""))
    altered = F.when(fault == "0a", F.sha2(F.concat(F.lit("~"), F.substring("body", 2, 2**31 - 1)), 256)).otherwise(F.col("digest"))
    both = cut(own.select("file", "offset", "digest", "copies", altered.alias("other"), (fault == "0b").alias("lost")), "index")
    return Audit(both, both.where("not lost").select("file", "offset", F.col("other").alias("digest"), "copies")).summary()


OP1_SQL = """
WITH r AS (
  SELECT CAST(floor(page_id / 1000) AS BIGINT) AS file, page_id AS k, concat('WARC/1.0', chr(10), coalesce(url, ''), chr(10), coalesce(html, '')) AS body FROM pages),
d AS (SELECT file, k, body, sha256(body) AS digest, CAST(strlen(body) AS BIGINT) AS length, count(*) AS copies FROM r GROUP BY file, k, body),
o AS (SELECT *, CAST(coalesce(sum(length * copies) OVER (PARTITION BY file ORDER BY k NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off,
  coalesce(substr(sha256(CAST(k AS VARCHAR)), 1, 2), '') AS fault FROM d),
x AS (SELECT 'a' AS replica, file, off, digest, copies FROM o UNION ALL
  SELECT 'b', file, off, CASE WHEN fault = '0a' THEN sha256(concat('~', substr(body, 2))) ELSE digest END, copies FROM o WHERE fault <> '0b'),
e AS (SELECT replica, coalesce(CAST(file AS VARCHAR), '') AS file, off, off // 65536 AS node, concat(off, ':', digest, ':', sum(copies)) AS entry FROM x GROUP BY replica, file, off, digest),
l0 AS (SELECT replica, file, node, sha256(string_agg(entry, ',' ORDER BY entry)) AS hash FROM e GROUP BY replica, file, node),
l1 AS (SELECT replica, file, node // 16 AS node, sha256(string_agg(hash, ',' ORDER BY node)) AS hash FROM l0 GROUP BY replica, file, node // 16),
l2 AS (SELECT replica, file, node // 16 AS node, sha256(string_agg(hash, ',' ORDER BY node)) AS hash FROM l1 GROUP BY replica, file, node // 16),
l3 AS (SELECT replica, file, node // 16 AS node, sha256(string_agg(hash, ',' ORDER BY node)) AS hash FROM l2 GROUP BY replica, file, node // 16),
l4 AS (SELECT replica, file, node // 16 AS node, sha256(string_agg(hash, ',' ORDER BY node)) AS hash FROM l3 GROUP BY replica, file, node // 16),
t AS (SELECT replica, file, sha256(string_agg(hash, ',' ORDER BY node)) AS hash FROM l4 GROUP BY replica, file),
roots AS (SELECT file, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM t GROUP BY file),
p4 AS (SELECT file, node, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM l4
  WHERE file IN (SELECT file FROM roots WHERE a IS DISTINCT FROM b) GROUP BY file, node),
p3 AS (SELECT file, node, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM l3
  WHERE (file, node // 16) IN (SELECT (file, node) FROM p4 WHERE a IS DISTINCT FROM b) GROUP BY file, node),
p2 AS (SELECT file, node, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM l2
  WHERE (file, node // 16) IN (SELECT (file, node) FROM p3 WHERE a IS DISTINCT FROM b) GROUP BY file, node),
p1 AS (SELECT file, node, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM l1
  WHERE (file, node // 16) IN (SELECT (file, node) FROM p2 WHERE a IS DISTINCT FROM b) GROUP BY file, node),
p0 AS (SELECT file, node, max(hash) FILTER (replica = 'a') AS a, max(hash) FILTER (replica = 'b') AS b FROM l0
  WHERE (file, node // 16) IN (SELECT (file, node) FROM p1 WHERE a IS DISTINCT FROM b) GROUP BY file, node),
n AS (SELECT file, count(*) AS visited FROM (SELECT file FROM p0 UNION ALL SELECT file FROM p1 UNION ALL SELECT file FROM p2 UNION ALL SELECT file FROM p3 UNION ALL SELECT file FROM p4) GROUP BY file),
q AS (SELECT file, off, max(h) FILTER (replica = 'a') AS a, max(h) FILTER (replica = 'b') AS b FROM (
  SELECT replica, file, off, string_agg(entry, ',' ORDER BY entry) AS h FROM e WHERE (file, node) IN (SELECT (file, node) FROM p0 WHERE a IS DISTINCT FROM b) GROUP BY replica, file, off) GROUP BY file, off),
w AS (SELECT file, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS altered, count(*) FILTER (b IS NULL) AS missing, count(*) FILTER (a IS NULL) AS extra,
  string_agg(CAST(off AS VARCHAR), ',' ORDER BY off) AS damaged FROM q WHERE a IS DISTINCT FROM b GROUP BY file)
SELECT roots.file AS file, a AS root, b AS replica_root, CAST(coalesce(visited, 0) AS BIGINT) AS visited, CAST(coalesce(altered, 0) AS BIGINT) AS altered,
  CAST(coalesce(missing, 0) AS BIGINT) AS missing, CAST(coalesce(extra, 0) AS BIGINT) AS extra, coalesce(damaged, '') AS damaged
FROM roots LEFT JOIN n USING (file) LEFT JOIN w USING (file)
"""


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n_best_pieces(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("piece_bpe_32k.model"))


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_ss_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("byte_bpe_50k.json"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_pseudonyms(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(damage(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(log_of(with_control_strings(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))))


def op13_eenns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {f.__name__: f for f in (op1_merkle_fixity, op2_quality_gam, op3_lz_fingerprint, op4_pq_dedup, op5_nbest_pieces, op6_toxicity_fm, op7_minmax_dedup, op8_ss_packing, op9_suffix_dedup, op10_pii_pseudonyms,
                                   op11_turn_repair, op12_chat_format, op13_eenns_clusters)}
ORACLE_SQL: dict[str, str] = {"op1_merkle_fixity": OP1_SQL, "op11_turn_repair": REPAIR_SQL, "op12_chat_format": CHAT_SQL, "op13_eenns_clusters": CLUSTERS_SQL}
