"""Ordered greedy near-duplicate removal equals the sequential loop."""

import pyarrow.parquet as pq

from conftest import SF_SMALL
from lumeval.operators.neardup import near_dup_keep


def sequential(rows, t):
    kept, seen = {}, []
    for seq, text in rows:
        s = set((text or "").lower().split())
        dup = any(len(s | k) > 0 and len(s & k) / len(s | k) > t for k in seen)
        kept[seq] = not dup
        if not dup:
            seen.append(s)
    return kept


def run(spark, rows, t):
    df = spark.createDataFrame(rows, "seq long, text string")
    return {r["seq"]: r["kept"] for r in near_dup_keep(df, "seq", "text", t).collect()}


def test_chain_is_not_connected_components(spark):
    a = " ".join(f"w{i}" for i in range(10))
    b = " ".join(f"w{i}" for i in range(1, 11))   # J(a,b) = 9/11
    c = " ".join(f"w{i}" for i in range(2, 12))   # J(b,c) = 9/11, J(a,c) = 8/12
    rows = [(1, a), (2, b), (3, c), (4, ""), (5, ""), (6, a), (7, a.upper())]
    got = run(spark, rows, 0.8)
    assert got == sequential(rows, 0.8) == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False, 7: False}


def test_strict_threshold_and_edge_thresholds(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k")]  # J = 9/11
    assert run(spark, rows, 9 / 11) == {1: True, 2: True}
    assert run(spark, rows, 0.8) == {1: True, 2: False}
    assert run(spark, rows, 1.0) == {1: True, 2: True}


def test_documents_equal_sequential(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    rows = sorted((r["doc_id"], r["text"]) for r in t)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r["kept"] for r in near_dup_keep(df, "doc_id", "text", 0.9).collect()}
    assert got == sequential(rows, 0.9)
    assert sum(got.values()) < len(got)  # the fixture has near copies to remove


def test_dense_near_copy_cluster_equals_sequential(spark):
    import random
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(1200):
        if i % 3 == 0:   # near copies: base plus one own token (pairwise J = 40/42)
            rows.append((i, " ".join(base + [f"u{i}"])))
        else:
            rows.append((i, " ".join(rnd.sample(base, 20) + [f"v{i}_{k}" for k in range(rnd.randint(0, 6))])))
    assert run(spark, rows, 0.9) == sequential(rows, 0.9)
    assert run(spark, rows, 0.6) == sequential(rows, 0.6)
