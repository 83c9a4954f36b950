"""Exact top-k search by inner product with multi-resolution segment statistics.

Components are floor(1024 x).  For segments of m components with mean mu and deviation sigma,
|q - v|^2 >= sum m ((mu_q - mu_v)^2 + (sigma_q - sigma_v)^2); since sum m (mu^2 + sigma^2) = |v|^2, the
score (|q|^2 + |v|^2 - |q - v|^2) / 2 is at most sum m (mu_q mu_v + sigma_q sigma_v).  Bounds of few long segments
discard most candidates, bounds of more segments most of the rest; survivors are computed exactly.

Queries and candidates are cut into blocks; every pair of blocks is a task that returns k
rows per query, and a window over these keeps k.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows without
id, take no part; only vectors of the query's length are its candidates; equal (vec_id, vector) rows
count once; other rows of the query's own id are candidates; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace
from .embedding_dedup import vector_rows

K = 10
EVERY = 100
QUERY_BLOCK, ROW_BLOCK = 1024, 4096
SEGMENTS = (2, 8, 16)


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(m) * (means, deviations) of each vector's segments: inner products bound scores."""
    parts = [p for p in np.array_split(np.arange(x.shape[1]), segments) if len(p)]
    cols = []
    for p in parts:
        seg = x[:, p]
        mean = seg.mean(1)
        dev = np.sqrt(np.maximum((seg * seg).mean(1) - mean * mean, 0))
        cols += [np.sqrt(len(p)) * mean, np.sqrt(len(p)) * dev]
    return np.stack(cols, 1)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them where they are small enough."""
    if len(x) and float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * len(q) < 2.0 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return (x * q).sum(1)


def block_top(queries: np.ndarray, qids: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int = K):
    """(query, row) indices of each query's k best rows, ``own[i]`` being the row of the query itself or -1."""
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1).max(initial=0)
    slack = (1e-9 * norms + 1e-6)[:, 0]
    levels = [(segment_stats(q, s), segment_stats(x, s)) for s in SEGMENTS if s <= q.shape[1]]
    coarse = levels[0][0] @ levels[0][1].T
    out = []
    for i in range(len(q)):
        bound = coarse[i]
        if own[i] >= 0:
            bound[own[i]] = -np.inf
        live = len(x) - (own[i] >= 0)
        take = min(k, live)
        if take <= 0:
            continue
        seed = np.argpartition(-bound, take - 1)[:take]  # the k best bounds give a first k-th score
        least = exact(queries[i], rows[seed]).min()
        keep = np.flatnonzero(bound >= least - slack[i])
        for qs, xs in levels[1:]:
            finer = xs[keep] @ qs[i]
            if len(keep) > 4 * take:
                seed = keep[np.argpartition(-finer, take - 1)[:take]]
                least = max(least, exact(queries[i], rows[seed]).min())
            keep = keep[finer >= least - slack[i]]
        score = exact(queries[i], rows[keep])
        best = np.lexsort((ids[keep], -score))[:take]
        out += [(i, int(keep[b]), int(score[b])) for b in best]
    return out


def _quantised(it):
    """(vec_id, embedding) -> (vec_id, dims, raw) with raw the 64-bit integers floor(1024 x)."""
    for batch in it:
        ids, dims, raw = [], [], []
        for i, v in zip(batch.column(0).to_pylist(), vector_rows(batch, "embedding")):
            if i is not None and v is not None:
                ids.append(i)
                dims.append(len(v))
                raw.append(np.floor(1024 * v).astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                          pa.array(raw, pa.binary())], names=["vec_id", "dims", "raw"])


def _search(k: int):
    """Rows (dims, qb, xb, is_query, vec_id, raw) sorted by (dims, qb, xb) -> (query_id, vec_id, score)."""
    def solve(rows):
        qs = [r for r in rows if r[0]]
        xs = [r for r in rows if not r[0]]
        out = [[], [], []]
        if qs and xs:
            place = {(r[1], r[2]): n for n, r in enumerate(xs)}
            ids = np.array([r[1] for r in xs])
            got = block_top(np.stack([np.frombuffer(r[2], np.int64) for r in qs]), None,
                            np.stack([np.frombuffer(r[2], np.int64) for r in xs]), ids,
                            np.array([place.get((r[1], r[2]), -1) for r in qs]), k)
            for i, j, s in got:
                out[0].append(qs[i][1]), out[1].append(xs[j][1]), out[2].append(s)
        return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["query_id", "vec_id", "score"])

    def run(it):
        key, rows = None, []
        for batch in it:
            for r in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if r[:3] != key:
                    if rows:
                        yield solve(rows)
                    key, rows = r[:3], []
                rows.append(r[3:])
        if rows:
            yield solve(rows)
    return run


def top_k(spark: SparkSession, vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every id divisible by ``every``."""
    ws = Workspace(spark, "topk_search")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = ws.save(src.mapInArrow(_quantised, "vec_id long, dims int, raw binary").distinct(), "rows")
    n = rows.groupBy("dims").agg(
        F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("nx"),
        F.ceil(F.sum((F.col("vec_id") % every == 0).cast("long")) / QUERY_BLOCK).cast("int").alias("nq"))
    n = ws.save(n.filter("nq > 0"), "sizes")
    keyed = rows.join(n, "dims")
    queries = (keyed.filter(F.col("vec_id") % every == 0)
               .withColumn("qb", F.pmod(F.xxhash64("vec_id", "raw"), F.col("nq")).cast("int"))
               .withColumn("xb", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))))
    others = (keyed.withColumn("xb", F.pmod(F.xxhash64("raw", "vec_id"), F.col("nx")).cast("int"))
              .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))))
    pick = lambda df, q: df.select("dims", "qb", "xb", F.lit(q).alias("is_query"), "vec_id", "raw")
    blocks = pick(queries, True).unionByName(pick(others, False))
    found = ws.save(blocks.repartition(parts, "dims", "qb", "xb").sortWithinPartitions("dims", "qb", "xb")
                    .mapInArrow(_search(k), "query_id long, vec_id long, score long"), "found")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
