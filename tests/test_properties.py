"""Property checks (symmetry, bounds, near-dup invariants) and skewed inputs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumeval.functions.vectors import cosine
from lumeval.operators import scorers as S
from lumeval.operators.curate import EmptyStageError, curate, dedup_exact
from lumeval.operators.neardup import near_dup_keep

words = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), max_size=8).map(" ".join)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=20))
def test_jaccard_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select(S.jaccard_expr(F.col("a"), F.col("b")).alias("x"),
                     S.jaccard_expr(F.col("b"), F.col("a")).alias("y")).collect()
    assert all(r["x"] == r["y"] and 0.0 <= r["x"] <= 1.0 for r in rows)


def test_cosine_symmetric_and_bounded(spark):
    rnd = random.Random(3)
    rows = [([rnd.uniform(-1, 1) for _ in range(8)], [rnd.uniform(-1, 1) for _ in range(8)]) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = df.select(cosine("a", "b").alias("x"), cosine("b", "a").alias("y")).collect()
    assert all(abs(r["x"] - r["y"]) < 1e-12 and -1 - 1e-12 <= r["x"] <= 1 + 1e-12 for r in got)


@settings(max_examples=10, deadline=None)
@given(st.lists(words, min_size=1, max_size=25), st.sampled_from([0.5, 0.6, 0.75, 0.9]))
def test_near_dup_invariants(spark, texts, t):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "seq long, text string")
    kept = {r["seq"]: r["kept"] for r in near_dup_keep(df, "seq", "text", t).collect()}
    sets = {i: set(x.lower().split()) for i, x in rows}

    def sim(i, j):
        u = sets[i] | sets[j]
        return bool(u) and len(sets[i] & sets[j]) / len(u) > t
    ks = [i for i in kept if kept[i]]
    assert not any(sim(i, j) for i in ks for j in ks if i < j)          # kept rows are dissimilar
    for j in kept:
        if not kept[j]:
            assert any(kept[i] and i < j and sim(i, j) for i in kept)   # a kept earlier neighbour


def test_hot_group_of_copies(spark):
    # a third of the rows are copies of one text: collapse, no pair explosion
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(i, base if i % 3 == 0 else f"{base} extra{i} more{i} words{i} here{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "seq long, text string")
    kept = near_dup_keep(df, "seq", "text", 0.9)
    assert kept.filter("kept").count() == 1 + 2000  # first copy + every distinct variant (J = 30/34)
    q = spark.createDataFrame([(i, "same question", "s") for i in range(3000)], "seq long, question string, scenario string")
    assert [r["seq"] for r in dedup_exact(q).collect()] == [0]


def test_stage_gate(spark):
    ex = spark.createDataFrame([(1, "q", "", "a", "s")],
                               "seq long, question string, context string, reference_answer string, scenario string")
    v = spark.createDataFrame([(1, '{"accept": true}')], "id long, accept_raw string")
    with pytest.raises(EmptyStageError):
        curate(ex, v)
