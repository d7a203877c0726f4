"""Document retrieval over Spark (R16 keyword score, R17 exact cosine top-k)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .marts import top_n


def query_terms(query: str, min_len: int = 5) -> list[str]:
    """Words of the query longer than 4 letters, lower-cased, de-duplicated in order."""
    seen: list[str] = []
    for w in re.findall(r"[A-Za-z]+", query.lower()):
        if len(w) >= min_len and w not in seen:
            seen.append(w)
    return seen


def keyword_scores(docs: DataFrame, text_col: str, query: str) -> DataFrame:
    """score = number of query terms contained in the lower-cased text."""
    low = F.lower(F.col(text_col))
    score = sum((F.when(low.contains(t), 1).otherwise(0) for t in query_terms(query)), F.lit(0))
    return docs.withColumn("score", score.cast("int"))


def keyword_search(docs: DataFrame, text_col: str, key: str, query: str, k: int) -> DataFrame:
    """Top-k documents by score (ties by key); zero scores are not results."""
    s = keyword_scores(docs.select(key, text_col), text_col, query).where(F.col("score") > 0)
    return top_n(s.select(key, "score"), "score", k, [key])


def cosine_top_k(vectors: DataFrame, query: DataFrame, key: str, vec_col: str, k: int) -> DataFrame:
    """Exact cosine similarity of every vector to one query vector, top-k.

    The query side is a single row attached as a scalar subquery (no join);
    the similarity is a per-row array expression (zip_with / aggregate) and
    the top-k a TakeOrderedAndProject (per-partition top-k, then merge).
    """
    q = query.select(F.transform(vec_col, lambda x: x.cast("double")).alias("_q"))
    # scalar subquery: fails at run time unless the query side is one row
    j = vectors.select(key, F.transform(vec_col, lambda x: x.cast("double")).alias("_v")) \
               .withColumn("_q", q.scalar())
    dot = F.aggregate(F.zip_with("_v", "_q", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    nv = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda acc, x: acc + x * x))
    nq = F.sqrt(F.aggregate("_q", F.lit(0.0), lambda acc, x: acc + x * x))
    sim = F.round(F.try_divide(dot, nv * nq), 6)
    return top_n(j.select(key, sim.alias("similarity")), "similarity", k, [key])
