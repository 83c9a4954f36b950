"""Exact top-k retrieval: batching, ties and leave-one-out."""

import numpy as np

from conftest import SF_SMALL
from lumeval.operators.retrieval import top_k_cosine
from lumeval.sources import fixtures as X


def brute(spark, k):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in e])
    m = np.array([r["embedding"] for r in e], dtype=np.float64)
    m = m / np.linalg.norm(m, axis=1)[:, None]
    s = m @ m.T
    np.fill_diagonal(s, -np.inf)
    out = set()
    for i, q in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda j: (-s[i, j], ids[j]))[:k]
        out |= {(int(q), r + 1, int(ids[j])) for r, j in enumerate(order)}
    return out


def test_top_k_equals_brute_force_in_one_or_many_batches(spark):
    q, c = X.rag_queries(spark, SF_SMALL), X.rag_corpus(spark, SF_SMALL)
    exp = brute(spark, 3)
    for max_bytes in (None, 20_000):
        h = top_k_cosine(q, c, 3, exclude_self=True, max_batch_bytes=max_bytes)
        got = {(r["q"], r["rank"], r["chunk_id"]) for r in h.collect()}
        assert got == exp


def test_ties_keep_corpus_order(spark):
    corpus = spark.createDataFrame(
        [(10, 2, [1.0, 0.0]), (11, 1, [1.0, 0.0]), (12, 0, [0.0, 1.0]), (13, 3, [2.0, 0.0])],
        "chunk_id long, pos long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "q long, embedding array<float>")
    h = top_k_cosine(q, corpus, 2).orderBy("rank").collect()
    assert [r["chunk_id"] for r in h] == [11, 10]
