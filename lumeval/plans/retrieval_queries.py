"""Retrieval and similarity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..operators import scorers as S
from ..sources import fixtures as X
from ..sources.tables import read_table

TOP_K = 2


def _hits(spark, sf_dir, k):
    return R.top_k_cosine(X.rag_queries(spark, sf_dir), X.rag_corpus(spark, sf_dir), k,
                          carry=("label",), q_carry=("label",), exclude_self=True)


def _relevant_counts(spark, sf_dir):
    # leave-one-out: the relevant set of a question excludes the question itself
    c = X.rag_corpus(spark, sf_dir)
    return c.groupBy(F.col("label").alias("_ql")).agg((F.count(F.lit(1)) - 1).alias("n_relevant"))


def retrieve_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + H1: top-2 other vectors per vector by cosine, stable ties."""
    h = _hits(spark, sf_dir, TOP_K)
    return h.select("q", "rank", "chunk_id", F.round("score", 6).alias("score"))


_RANKED_SQL = r"""
pairs AS (
  SELECT a.vec_id AS q, b.vec_id AS chunk_id, b.vec_id AS pos, b.label AS c_label, a.label AS q_label,
    list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, pos ASC) AS rank FROM pairs
  QUALIFY rank <= 3),
relevant AS (SELECT label, count(*) - 1 AS n_relevant FROM embeddings GROUP BY label)
"""

RETRIEVE_TOPK_SQL = X.with_ctes(_RANKED_SQL, body="""
SELECT q, rank, chunk_id, round(score, 6) AS score FROM ranked WHERE rank <= 2
""")


def rag_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 + C10 + F3 at k = 2 per question."""
    s = R.retrieval_scores(_hits(spark, sf_dir, TOP_K), X.rag_queries(spark, sf_dir),
                           _relevant_counts(spark, sf_dir))
    return s.select("q", F.round("context_precision", 6).alias("context_precision"),
                    F.round("context_recall", 6).alias("context_recall"))


RAG_PRECISION_RECALL_SQL = X.with_ctes(_RANKED_SQL, body="""
, per_q AS (
  SELECT e.vec_id AS q, count(r.q) AS n_ret, sum(CASE WHEN c_label = q_label THEN 1 ELSE 0 END) AS n_hit,
         coalesce(any_value(rel.n_relevant), 0) AS n_rel
  FROM embeddings e LEFT JOIN ranked r ON r.q = e.vec_id AND r.rank <= 2
  LEFT JOIN relevant rel ON rel.label = e.label GROUP BY e.vec_id)
SELECT q,round(CASE WHEN n_ret = 0 THEN 0.0 ELSE n_hit / n_ret END, 6) AS context_precision,
       round(CASE WHEN n_rel = 0 THEN 1.0 ELSE n_hit / n_rel END, 6) AS context_recall
FROM per_q
""")


def rag_k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank once at k = 3, then mean precision / recall for k = 1, 2, 3."""
    s = R.retrieval_scores(_hits(spark, sf_dir, 3), X.rag_queries(spark, sf_dir),
                           _relevant_counts(spark, sf_dir), k_values=(1, 2, 3))
    return s.groupBy("k").agg(
        F.round(F.avg("context_precision"), 6).alias("mean_context_precision"),
        F.round(F.avg("context_recall"), 6).alias("mean_context_recall"),
        F.count(F.lit(1)).alias("n_questions"))


RAG_K_SWEEP_SQL = X.with_ctes(_RANKED_SQL, body="""
, ks AS (SELECT unnest([1, 2, 3]) AS k),
per_q AS (
  SELECT ks.k, e.vec_id AS q, count(r.q) AS n_ret, sum(CASE WHEN c_label = q_label THEN 1 ELSE 0 END) AS n_hit,
         coalesce(any_value(rel.n_relevant), 0) AS n_rel
  FROM embeddings e CROSS JOIN ks LEFT JOIN ranked r ON r.q = e.vec_id AND r.rank <= ks.k
  LEFT JOIN relevant rel ON rel.label = e.label
  GROUP BY ks.k, e.vec_id)
SELECT k,
  round(avg(CASE WHEN n_ret = 0 THEN 0.0 ELSE n_hit / n_ret END), 6) AS mean_context_precision,
  round(avg(CASE WHEN n_rel = 0 THEN 1.0 ELSE n_hit / n_rel END), 6) AS mean_context_recall,
  count(*) AS n_questions
FROM per_q GROUP BY k
""")


def rag_id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 + C10 + F3 with text ids and a list of relevant ids for every question:
    the chunk of its own vector and the next one."""
    e = read_table(spark, sf_dir, "embeddings")

    def chunk(n):
        return F.concat(F.lit("c"), (F.col("vec_id") + n).cast("string"))

    questions = e.select(F.concat(F.lit("q"), F.col("vec_id").cast("string")).alias("q"), "embedding",
                         F.array(chunk(0), chunk(1)).alias("relevant_ids"))
    chunks = e.select(chunk(0).alias("chunk_id"), F.col("vec_id").alias("pos"), "embedding")
    s = R.scores_by_id_list(R.top_k_cosine(questions, chunks, TOP_K), questions)
    return s.select("q", "context_precision", "context_recall")


RAG_ID_LISTS_SQL = r"""
WITH pairs AS (
  SELECT a.vec_id AS q, b.vec_id AS chunk_id,
    list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
  FROM embeddings a, embeddings b),
hits AS (
  SELECT q, chunk_id FROM pairs
  QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, chunk_id ASC) <= 2),
per_q AS (
  SELECT e.vec_id, count(h.q) AS n_ret,
         count(CASE WHEN h.chunk_id IN (e.vec_id, e.vec_id + 1) THEN 1 END) AS n_hit
  FROM embeddings e LEFT JOIN hits h ON h.q = e.vec_id GROUP BY e.vec_id)
SELECT 'q' || CAST(vec_id AS VARCHAR) AS q, CASE WHEN n_ret = 0 THEN 0.0 ELSE n_hit / n_ret END AS context_precision,
       n_hit / 2 AS context_recall
FROM per_q
"""


def rag_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 + H1: retrieval context from the top-2 chunks' document texts."""
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"))
    h = _hits(spark, sf_dir, TOP_K)
    return R.build_context(h, docs)


RAG_CONTEXT_SQL = X.with_ctes(_RANKED_SQL, body=r"""
SELECT q, string_agg('[Source: ' || CAST(r.chunk_id AS VARCHAR) || ']' || chr(10) || coalesce(d.text, ''),
                     chr(10) || chr(10) ORDER BY rank) AS context
FROM ranked r LEFT JOIN documents d ON d.doc_id = r.chunk_id
WHERE rank <= 2 GROUP BY q
""")


def _neighbour_pairs(spark, sf_dir):
    # each vector paired with the next one (equi-join on vec_id + 1)
    e = read_table(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("a"))
    b = e.select((F.col("vec_id") - 1).alias("id"), F.col("embedding").alias("b"))
    return a.join(b, "id")


def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of neighbouring vectors, in double."""
    p = _neighbour_pairs(spark, sf_dir)
    sc = S.get_scorer("embedding_similarity").column(
        p, {"reference_embedding": "a", "output_embedding": "b"})
    return p.select("id", F.round(sc.getField("similarity_score"), 6).alias("similarity_score"))


_PAIRS_SQL = r"""
vp AS (
  SELECT a.vec_id AS id,
    list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
"""

COSINE_PAIRS_SQL = X.with_ctes(_PAIRS_SQL, body="SELECT id, round(s, 6) AS similarity_score FROM vp")


def similarity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 + B3: similarity with an inclusive 0.1 pass mark, columns bound by a rename map."""
    p = _neighbour_pairs(spark, sf_dir)
    scorer = S.similarity_scorer("embedding_similarity_0_1", 0.1)
    sc = scorer.column(p, {"reference_embedding": "a", "output_embedding": "b"})
    return p.select("id", F.round(sc.getField("similarity_score"), 6).alias("similarity_score"),
                    sc.getField("is_similar").alias("is_similar"))


SIMILARITY_THRESHOLD_SQL = X.with_ctes(_PAIRS_SQL, body="""
SELECT id, round(s, 6) AS similarity_score, s >= 0.1 AS is_similar FROM vp
""")
