"""Registered governance and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.patterns import LOAD_RESTRICTION, PII_PATTERNS, REDACTION_PATTERNS
from ..operators import governance as G
from ..operators import search
from ..sources import ledger
from ..sources.tables import read_table, read_wide
from .ledger_queries import silver_df
from .oracle import with_ctes
from .registry import register

SALT = "ledgerflow-demo-salt"
SEARCH_QUERY = "Nation retention stations: the ingestion of other records"


def _sq(s: str) -> str:
    return s.replace("'", "''")


_LONG_CTE = """long AS (
  SELECT 'text_token' AS column_name, trim(tok) AS value
  FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS tok FROM documents)
  UNION ALL SELECT 'lang', trim(lang) FROM documents
  UNION ALL SELECT 'source', trim(source) FROM documents)"""


def _rates_body() -> str:
    parts = []
    for i, (name, (rx, cat, sens)) in enumerate(PII_PATTERNS.items()):
        parts.append(f"SELECT column_name, COUNT(*) AS non_null, {i} AS priority, '{name}' AS pii_type, "
                     f"'{cat}' AS category, '{sens}' AS sensitivity, "
                     f"ROUND(COUNT(*) FILTER (WHERE regexp_matches(value, '{_sq(rx)}')) / COUNT(*), 4) AS match_rate "
                     f"FROM long GROUP BY column_name")
    return "\nUNION ALL\n".join(parts)


def _rates_sql() -> str:
    return f"WITH {_LONG_CTE}\n{_rates_body()}"


def _doc_tokens(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select(F.explode(F.split("text", r"\s+")).alias("text_token"), "lang", "source")


@register("g1_pii_scan_documents", ids=("G1", "G6"), headline=True, sql=_rates_sql())
def q_g1(spark, sf):
    d = read_wide(spark, sf, "documents", ["text", "lang", "source"])
    toks = d.select(F.explode(F.split("text", r"\s+")).alias("text_token"))
    counted = toks.groupBy("text_token").agg(F.count(F.lit(1)).alias("n"))  # combined map-side, so a pattern meets a token once
    a = G.pii_match_rates(counted, ["text_token"], weight="n")
    b = G.pii_match_rates(d.select("lang", "source"), ["lang", "source"])
    return a.unionByName(b)


def _redact_sql() -> str:
    expr = "text"
    counts = []
    for name, rx in REDACTION_PATTERNS:
        counts.append(f"len(regexp_extract_all({expr}, '{_sq(rx)}')) AS n_{name}")
        expr = f"regexp_replace({expr}, '{_sq(rx)}', '[{name.upper()}]', 'g')"
    return f"SELECT doc_id, {expr} AS redacted_text, {', '.join(counts)} FROM documents"


@register("g8_redact_documents", ids=("G8",), sql=_redact_sql())
def q_g8(spark, sf):
    d = read_wide(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", G.redact_text("text").alias("redacted_text"), *G.pii_hits("text"))


@register("g4_mask_customers", ids=("G4",), sql=f"""
SELECT c_custkey AS customer_id,
       'Person-' || substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 10) AS customer_name,
       'ACCT_' || substr(sha256('{SALT}' || CAST(c_custkey AS VARCHAR)), 1, 16) AS account_token,
       substr(translate(upper(sha256('{SALT}' || c_name)), '0123456789', 'GHIJKLMNOP'), 1, 5)
         || substr(translate(upper(sha256('{SALT}' || c_name)), 'ABCDEF', '012345'), 6, 4)
         || substr(translate(upper(sha256('{SALT}' || c_name)), '0123456789', 'GHIJKLMNOP'), 10, 1) AS tax_token,
       repeat('X', greatest(length(regexp_replace(CAST(c_phone_like AS VARCHAR), '[^0-9]', '', 'g')) - 4, 0))
         || right(regexp_replace(CAST(c_phone_like AS VARCHAR), '[^0-9]', '', 'g'), 4) AS phone_masked
FROM (SELECT *, 9000000000 + c_custkey AS c_phone_like FROM customer)""")
def q_g4(spark, sf):
    c = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name", (F.lit(9000000000) + F.col("c_custkey")).alias("phone"))
    out = c.select("customer_id", G.pseudonym("customer_id").alias("customer_name"),
                   G.token("customer_id", SALT, "ACCT").alias("account_token"),
                   G.pan_token("c_name", SALT).alias("tax_token"),
                   G.mask_last4("phone").alias("phone_masked"))
    return out


@register("g5_dim_customers", ids=("G5", "P8"), sql=with_ctes("customers", """
SELECT customer_id, customer_tier, city, sha256(customer_name) AS customer_name_hash,
       CASE WHEN balance >= 5000 THEN 'HIGH' WHEN balance >= 1000 THEN 'MID' ELSE 'LOW' END AS balance_band
FROM customers WHERE is_active"""))
def q_g5(spark, sf):
    c = ledger.customers(spark, sf).where(F.col("is_active"))
    band = F.when(F.col("balance") >= 5000, "HIGH").when(F.col("balance") >= 1000, "MID").otherwise("LOW")
    return c.select("customer_id", "customer_tier", "city", F.sha2("customer_name", 256).alias("customer_name_hash"),
                    band.alias("balance_band"))


@register("g9_partner_feed", ids=("G9", "S18"), sql=with_ctes("silver merchants", f"""
SELECT 'P-' || m.category AS partner_id, s.transaction_id,
       sha256('{SALT}' || CAST(s.customer_id AS VARCHAR)) AS customer_hash,
       CAST(s.amount AS DOUBLE) AS amount, s.transaction_date
FROM silver s JOIN merchants m ON s.merchant_id = m.merchant_id"""))
def q_g9(spark, sf):
    partners = ledger.merchants(spark, sf).select("merchant_id", F.concat(F.lit("P-"), "category").alias("partner_id"))
    s = silver_df(spark, sf).join(partners, "merchant_id", "inner")
    return s.select("partner_id", "transaction_id",
                    F.sha2(F.concat(F.lit(SALT), F.col("customer_id").cast("string")), 256).alias("customer_hash"),
                    F.col("amount").cast("double").alias("amount"), "transaction_date")


def _kw_sql() -> str:
    terms = search.query_terms(SEARCH_QUERY)
    score = " + ".join(f"(CASE WHEN contains(lower(text), '{t}') THEN 1 ELSE 0 END)" for t in terms)
    return f"""SELECT doc_id, CAST({score} AS INTEGER) AS score FROM documents
WHERE {score} > 0 ORDER BY score DESC, doc_id LIMIT 3"""


@register("r16_keyword_search", ids=("R16", "T1"), sql=_kw_sql())
def q_r16(spark, sf):
    return search.keyword_search(read_table(spark, sf, "documents"), "text", "doc_id", SEARCH_QUERY, 3)


@register("r17_vector_top3", ids=("R17",), sql="""
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id = 0)
SELECT vec_id, ROUND(list_dot_product(CAST(embedding AS DOUBLE[]), qv)
       / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(qv, qv))), 6)
       AS similarity
FROM embeddings, q ORDER BY similarity DESC, vec_id LIMIT 3""")
def q_r17(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return search.cosine_top_k(e, e.where(F.col("vec_id") == 0), "vec_id", "embedding", 3)


def _tier_sql() -> str:
    lr = LOAD_RESTRICTION
    return f"""
WITH {_LONG_CTE},
rates AS ({_rates_body()}),
best AS (SELECT column_name, sensitivity, match_rate,
                ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY match_rate DESC, priority) AS r FROM rates),
f AS (SELECT * FROM best WHERE r = 1 AND match_rate > 0.2),
o AS (SELECT MAX(CASE sensitivity WHEN 'Internal' THEN 1 WHEN 'Confidential' THEN 2 WHEN 'Restricted' THEN 3 ELSE 0 END)
             AS o FROM f)
SELECT CASE COALESCE(o, 0) WHEN 3 THEN 'Restricted' WHEN 2 THEN 'Confidential' WHEN 1 THEN 'Internal' ELSE 'Public' END
         AS dataset_classification,
       CASE COALESCE(o, 0) WHEN 3 THEN '{_sq(lr["Restricted"])}' WHEN 2 THEN '{_sq(lr["Confidential"])}'
            WHEN 1 THEN '{_sq(lr["Internal"])}' ELSE '{_sq(lr["Public"])}' END AS load_restriction
FROM o"""


@register("g3_dataset_tier_documents", ids=("G3", "G1"), sql=_tier_sql())
def q_g3(spark, sf):
    d = read_wide(spark, sf, "documents", ["text", "lang", "source"])
    toks = d.select(F.explode(F.split("text", r"\s+")).alias("text_token"))
    found = G.pii_scan(toks, ["text_token"]).unionByName(G.pii_scan(d.select("lang", "source"), ["lang", "source"]))
    return G.dataset_tier(found)
