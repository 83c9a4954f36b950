"""The operators' queries over the given tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fill_in_middle, sharding, token_alignment
from .common import read
from .embedding_dedup import near_duplicates
from .html_extract import extract
from .language_id import identify
from .lm_score import score_texts
from .ngram_join import jaccard_components
from .packing import pack
from .piece_codec import encode
from .quality_kn import classify
from .suffix_dedup import remove_repeats
from .topk_search import top_k


def op1_suffix_dedup(spark, sf_dir):
    return remove_repeats(spark, read(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark, sf_dir):
    return near_duplicates(spark, read(spark, sf_dir, "embeddings"))


def op3_lm_score(spark, sf_dir):
    return score_texts(spark, read(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"))


def op5_piece_codec(spark, sf_dir):
    rows = encode(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids_crc32", "round_trip")


def op6_packing(spark, sf_dir):
    return pack(spark, read(spark, sf_dir, "documents"))


def op7_html_extract(spark, sf_dir):
    return extract(spark, read(spark, sf_dir, "pages"))


def op8_topk_search(spark, sf_dir):
    return top_k(spark, read(spark, sf_dir, "embeddings"))


def op9_ngram_join(spark, sf_dir):
    return jaccard_components(spark, read(spark, sf_dir, "documents")).drop("set_id", "component")


def op10_quality_kn(spark, sf_dir):
    return classify(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_token_alignment(spark, sf_dir):
    return token_alignment.align(spark, read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    rows = fill_in_middle.transform(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restore("output", "form").cast("binary"), 256).alias("restored_sha256"))


def op13_sharding(spark, sf_dir):
    return sharding.shard(spark, read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_embedding_dedup, op3_lm_score, op4_language_id, op5_piece_codec, op6_packing,
    op7_html_extract, op8_topk_search, op9_ngram_join, op10_quality_kn, op11_token_alignment, op12_fill_in_middle,
    op13_sharding)}

#: Floor, integer products and the ties of the top-k report are plain SQL.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
ORACLE_SQL: dict[str, str] = {"op8_topk_search": TOPK_SQL, "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
                              "op13_sharding": sharding.oracle_sql()}
