"""Exact top-k cosine retrieval (F1, H1) and retrieval scoring (F3, C9, C10,
G10, B8).

Plan:

1. Questions and chunks are dealt into blocks by a hash; the number of
   blocks follows from their bytes (``lumeval.retrieval.maxBatchBytes`` a
   block), so a pair of blocks fits a task whatever the tables' size.
2. Every pair of blocks meets in one cell of a shuffle.  A cell computes all its
   cosines as NumPy products of tiles that stay in the processor's caches, looks only at those
   above a question's k-th best so far, and gives out its top k per question, so
   no pair rows reach the next shuffle, and nothing passes the driver.
3. One window ``row_number() <= k`` per question merges the <= k x blocks
   candidates (Catalyst adds a partial WindowGroupLimit before the shuffle).

Ids of questions and chunks may be of any type.  A vector that is null or
holds a null, and a zero vector, is never retrieved and retrieves nothing.
Ties keep corpus order (``pos`` ascending), as a stable descending sort does.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import broadcast_if_small

DEFAULT_MAX_BATCH_BYTES = 64 * 1024 * 1024
TILE = 1024  # questions, and chunks, of one NumPy product: 8 MiB of cosines


def _unit_matrix(t: pa.Table) -> np.ndarray:
    col = pa.chunked_array(t.column("_vec").chunks, t.schema.field("_vec").type)
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in col.chunks])
    mat = flat.reshape(len(col), -1)
    norms = np.linalg.norm(mat, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mat /= norms[:, None]  # ``flat`` is a copy
    mat[norms == 0] = np.nan  # cosine undefined: never retrieved
    return mat


def _padded(mat: np.ndarray) -> np.ndarray:
    """Zero rows up to whole tiles: products have one shape, so equal vectors get equal cosines wherever they stand."""
    out = np.zeros((-(-len(mat) // TILE) * TILE, mat.shape[1]))
    out[:len(mat)] = mat
    return out


def _best(k: int, row: np.ndarray, at: np.ndarray, score: np.ndarray):
    """The k entries of each row with the highest scores, the first of equal ones."""
    order = np.lexsort((at, -score, row))
    row, at, score = row[order], at[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    return row[rank < k], at[rank < k], score[rank < k], rank[rank < k]


def _tile_topk(q_unit: np.ndarray, c_unit: np.ndarray, k: int, q_self=None, c_self=None):
    """(question, chunk, cosine) of the top k chunks of each question; of equal cosines the first chunk.

    A question keeps its k best so far; of a later tile only what is above the least of them is looked at.
    ``q_self``, ``c_self``: numbers of the ids; chunks with the question's own are left out.
    """
    nq, m = len(q_unit), len(c_unit)
    q_unit, c_unit = _padded(q_unit), _padded(c_unit)
    if q_self is not None:
        by = [np.argsort(c_self[i:i + TILE], kind="stable") for i in range(0, m, TILE)]
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for j in range(0, nq, TILE):
        n = min(TILE, nq - j)
        row, at, score = parts[0]
        least = np.full(n, -np.inf)
        for i in range(0, m, TILE):
            s = (q_unit[j:j + TILE] @ c_unit[i:i + TILE].T)[:n, :m - i]
            if q_self is not None:
                own = by[i // TILE]
                low, high = (np.searchsorted(c_self[i:i + TILE][own], q_self[j:j + n], side) for side in ("left", "right"))
                same = high - low
                s[np.repeat(np.arange(n), same),
                  own[np.repeat(low - (np.cumsum(same) - same), same) + np.arange(same.sum())]] = -np.inf
            if i == 0:
                kk = min(k, s.shape[1])
                cut = np.maximum(np.partition(s, s.shape[1] - kk, axis=1)[:, s.shape[1] - kk], np.finfo(float).min)
                r, c = np.nonzero(s >= cut[:, None])
            else:
                r, c = np.nonzero(s > least[:, None])
            if len(r):
                row, at, score, rank = _best(k, np.concatenate([row, r]), np.concatenate([at, c + i]),
                                             np.concatenate([score, s[r, c]]))
                least[row[rank == k - 1]] = score[rank == k - 1]
        parts.append((row + j, at, score))
    return [np.concatenate(x) for x in zip(*parts)]


def _cell_topk(k: int, exclude_self: bool, carry: list[str], q_carry: list[str]):
    names = ["q", "chunk_id", "pos", "score", *carry, *[f"q_{c}" for c in q_carry]]

    def run(qs: pa.Table, cs: pa.Table) -> pa.Table:
        nq, m = qs.num_rows, cs.num_rows
        qi = ci = np.zeros(0, np.int64)
        score = np.zeros(0)
        if nq and m:
            q_unit, c_unit = _unit_matrix(qs), _unit_matrix(cs)
            order = np.argsort(cs.column("pos").to_numpy(), kind="stable")  # of equal cosines the first position stays
            # a vector without a cosine is never retrieved and retrieves nothing
            known = np.flatnonzero(~np.isnan(q_unit).any(axis=1))
            order = order[~np.isnan(c_unit).any(axis=1)[order]]
            ids = []
            if exclude_self:
                both = pd.factorize(np.concatenate([qs.column("_self").to_pandas(), cs.column("_self").to_pandas()]))[0]
                ids = [both[:nq][known], both[nq:][order]]
            qi, ci, score = _tile_topk(q_unit[known], c_unit[order], k, *ids)
            qi, ci = known[qi], order[ci]
        left, right = (t.drop_columns(["_vec"]).take(pa.array(i)) for t, i in ((qs, qi), (cs, ci)))
        return pa.table([left.column("q"), right.column("chunk_id"), right.column("pos"), pa.array(score, pa.float64()),
                         *[right.column(c) for c in carry], *[left.column(f"q_{c}") for c in q_carry]], names=names)
    return run


def _usable(vec: str):
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))


def top_k_cosine(queries: DataFrame, corpus: DataFrame, k: int = 2, *, q_col: str = "q",
                 q_vec: str = "embedding", c_id: str = "chunk_id", c_pos: str = "pos",
                 c_vec: str = "embedding", carry: tuple[str, ...] = (),
                 q_carry: tuple[str, ...] = (), exclude_self: bool = False,
                 max_batch_bytes: int | None = None) -> DataFrame:
    """Top-k chunks per question by cosine,
    ``(q, rank, chunk_id, pos, score, *carry, *q_<q_carry>)``: ``carry`` are
    corpus columns, ``q_carry`` question columns that travel along."""
    spark = queries.sparkSession
    if max_batch_bytes is None:
        max_batch_bytes = int(spark.conf.get("lumeval.retrieval.maxBatchBytes",
                                             str(DEFAULT_MAX_BATCH_BYTES)))
    carry, q_carry = list(carry), list(q_carry)
    qs, cs = queries.filter(_usable(q_vec)), corpus.filter(_usable(c_vec))

    def blocks(df, vec):
        total = df.agg(F.sum(F.size(vec).cast("long") * 8 + 64)).first()[0] or 0
        return max(1, math.ceil(int(total) / max_batch_bytes))

    n_q, n_c = blocks(qs, q_vec), blocks(cs, c_vec)
    n_c = max(n_c, spark.sparkContext.defaultParallelism // n_q)

    def other(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n, *cols):
        return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")

    left = qs.select(
        (dealt(n_q, q_col, q_vec) * n_c).alias("_b"), other(n_c).alias("_o"), F.col(q_col).alias("q"),
        F.col(q_col).cast("string").alias("_self"), F.col(q_vec).cast("array<double>").alias("_vec"),
        *[F.col(c).alias(f"q_{c}") for c in q_carry]).withColumn("_cell", F.col("_b") + F.col("_o")).drop("_b", "_o")
    right = cs.select(
        dealt(n_c, c_id, c_vec).alias("_b"), other(n_q).alias("_o"), F.col(c_id).alias("chunk_id"),
        F.col(c_id).cast("string").alias("_self"), F.col(c_pos).cast("long").alias("pos"),
        F.col(c_vec).cast("array<double>").alias("_vec"), *carry) \
        .withColumn("_cell", F.col("_b") + F.col("_o") * n_c).drop("_b", "_o")
    schema = T.StructType([
        T.StructField("q", left.schema["q"].dataType), T.StructField("chunk_id", right.schema["chunk_id"].dataType),
        T.StructField("pos", T.LongType()), T.StructField("score", T.DoubleType()),
        *[T.StructField(c, right.schema[c].dataType) for c in carry],
        *[T.StructField(f"q_{c}", left.schema[f"q_{c}"].dataType) for c in q_carry]])
    cand = left.groupBy("_cell").cogroup(right.groupBy("_cell")).applyInArrow(
        _cell_topk(k, exclude_self, carry, q_carry), schema)
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("pos").asc())
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _precision_recall(n_retrieved, n_hit, n_relevant):
    return (F.when(n_retrieved == 0, F.lit(0.0)).otherwise(n_hit / n_retrieved).alias("context_precision"),
            F.when(n_relevant == 0, F.lit(1.0)).otherwise(n_hit / n_relevant).alias("context_recall"))


def retrieval_scores(hits: DataFrame, queries: DataFrame, relevant_counts: DataFrame,
                     k_values=(None,), q_label: str = "label", c_label: str = "label") -> DataFrame:
    """Context precision / recall per (k, question) from ranked hits (C9, C10,
    F3); a question without hits has a row, too.

    Relevance is label equality, resolved in long form: a hit is relevant
    when its chunk label equals the question's; the relevant-set size comes
    from a per-label count, so no per-question id list is ever built.
    """
    ks = F.explode(F.array(*[F.lit(k).cast("int") for k in k_values])).alias("k")
    asked = queries.select("q", F.col(q_label).alias("_ql"), ks)
    if f"q_{q_label}" in hits.columns:  # the question label came with the hits
        h = hits.withColumn("_hl", F.col(f"q_{q_label}"))
    else:
        h = hits.join(queries.select("q", F.col(q_label).alias("_hl")), "q")
    h = h.select("*", ks).filter(F.col("k").isNull() | (F.col("rank") <= F.col("k")))
    agg = h.groupBy("k", "q").agg(
        F.count(F.lit(1)).alias("n_retrieved"),  # chunk ids are distinct per question
        F.sum(F.when(F.col(c_label) == F.col("_hl"), 1).otherwise(0)).alias("n_hit")) \
        .withColumnsRenamed({"k": "_k", "q": "_q"})
    out = asked.join(agg, (F.col("q") == F.col("_q")) & F.col("k").eqNullSafe(F.col("_k")), "left")
    # one row per label: broadcast behind a size check
    out = out.join(broadcast_if_small(relevant_counts), "_ql", "left")
    zero = F.lit(0)
    return out.select("k", "q", *_precision_recall(
        F.coalesce("n_retrieved", zero), F.coalesce("n_hit", zero), F.coalesce("n_relevant", zero)))


def scores_by_id_list(hits: DataFrame, queries: DataFrame, relevant: str = "relevant_ids") -> DataFrame:
    """C9 + C10 where every question lists its relevant chunk ids (null: none);
    repeated ids count once, a question without hits has a row."""
    got = hits.groupBy("q").agg(F.collect_set("chunk_id").alias("_got"))  # at most k ids
    out = queries.select("q", F.col(relevant).alias("_rel")).join(got, "q", "left")
    none = F.array().cast(out.schema["_rel"].dataType)
    rel, ids = F.array_distinct(F.coalesce("_rel", none)), F.coalesce("_got", none)
    return out.select("q", *_precision_recall(F.size(ids), F.size(F.array_intersect(ids, rel)), F.size(rel)))


def build_context(hits: DataFrame, contents: DataFrame, id_col: str = "chunk_id",
                  content_col: str = "content") -> DataFrame:
    """``[Source: id]\\ncontent`` pieces joined by a blank line in rank order.
    Each group holds k pieces, so collecting per question is bounded."""
    j = hits.join(contents.select(F.col(id_col).alias("chunk_id"), F.col(content_col).alias("_c")),
                  "chunk_id", "left")
    piece = F.concat(F.lit("[Source: "), F.col("chunk_id").cast("string"), F.lit("]\n"),
                     F.coalesce(F.col("_c"), F.lit("")))
    g = j.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", piece.alias("p")))).alias("ps"))
    return g.select("q", F.array_join(F.transform("ps", lambda s: s.getField("p")), "\n\n").alias("context"))
