"""BLEU as a plan, boards over scorers of different grain, verdict rules, numbering by range, lineage with cycles."""

import math
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lumeval.functions import verdicts as V
from lumeval.operators.bleu import MAX_ORDER, _ngram_stats, bleu_scores, sentence_bleu, tokenize_13a_py
from lumeval.operators.lineage import ancestors
from lumeval.operators.ordering import range_index
from lumeval.operators.summary import bound_board


def bleu(reference, output):
    if reference is None or output is None:
        return None
    *c, hl, rl = _ngram_stats(tokenize_13a_py(output), tokenize_13a_py(reference))
    total = [max(hl - n, 0) for n in range(MAX_ORDER)]
    if not sum(c):
        return 0.0
    logs, zeros = [], 0
    for k, t in zip(c, total):
        if t:
            zeros += k == 0
            logs.append(math.log(100 * k / t if k else 100 / (2 ** zeros * t)))
    return (math.exp(1 - rl / hl) if hl < rl else 1.0) * math.exp(sum(logs) / len(logs)) / 100


@pytest.fixture(scope="module")
def pairs():
    g = random.Random(2)
    words = ["the", "the", "cat", "sat,", "on", "mat.", "3.5", "it's", "a-b", "&amp;", "\n"]
    texts = [" ".join(g.choices(words, k=g.randrange(1, 30))) for _ in range(40)]
    made = [(i, "v", texts[i], texts[(i * 7) % 40]) for i in range(40)]
    return made + [(50, "v", None, "a"), (51, "v", "a", None), (52, "v", "", "a b"), (53, "v", "a b", ""), (54, "v", "", ""),
                   (55, "v", "the " * 500, "the " * 300), (56, "v", "x y", "x y"), (56, "v", "x y", "z"),
                   (None, "v", "a b c d", "a b c d"), (None, None, "a b c d", "a b c d")]


def test_bleu_plan_equals_definition(spark, pairs):
    df = spark.createDataFrame(pairs, "id long, variant string, reference string, output string").repartition(3)
    got = sorted(((r.id, r.variant, r.bleu) for r in bleu_scores(df, ["id", "variant"]).collect()), key=str)
    want = sorted(((i, v, bleu(r, o)) for i, v, r, o in pairs), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    order = lambda rows: sorted((str(r[:2]), -1.0 if r[2] is None else r[2]) for r in rows)
    for g, w in zip(order(got), order(want)):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1], abs=1e-12)
    column = df.select("id", "variant", sentence_bleu(F.col("reference"), F.col("output")).alias("b")).collect()
    for g, w in zip(order(got), order([tuple(r) for r in column])):
        assert g[1] == pytest.approx(w[1], abs=1e-12)


def test_bleu_plan_shuffles_no_gram(spark, pairs):
    """On pairs that a join has partitioned by id, the aggregates add no exchange."""
    df = spark.createDataFrame(pairs, "id long, variant string, reference string, output string").repartition(4, "id")
    plan = bleu_scores(df, ["id", "variant"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_board_binds_by_key(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "id long, variant string")
    first = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0), (2, "a", None), (9, "a", 50.0), (1, "c", 7.0)],
                                  "id long, variant string, s double")
    second = spark.createDataFrame([(1, "a", True), (2, "a", False)], "id long, variant string, ok boolean")
    board = bound_board(rows, ["id", "variant"], "variant", {
        "first": (first, F.col("s")), "second": (second, F.col("ok").cast("int"))})
    assert sorted(map(tuple, board.collect())) == [("a", 2.0, 0.5, 2), ("b", 0.0, 0.0, 1)]
    empty = bound_board(rows.limit(0), ["id", "variant"], "variant", {"first": (first, F.col("s"))})
    assert empty.count() == 0


def test_metric_board_equals_single_scorers(spark):
    from lumeval.plans import metric_queries as mq
    board = {r.variant: r for r in mq.metric_board(spark, SF_SMALL).collect()}
    assert set(board) == {"echo", "drop", "swap"}
    for name, query in (("bleu", mq.bleu_sentence), ("rouge_l_fmeasure", mq.rouge_l)):
        for r in query(spark, SF_SMALL).groupBy("variant").agg(F.avg(name).alias("m")).collect():
            assert board[r.variant]["bleu" if name == "bleu" else "rouge_l"] == pytest.approx(r.m, abs=2e-6)
    five = {r.variant: r for r in mq.benchmark_board(spark, SF_SMALL).collect()}
    for v, r in five.items():
        assert all(board[v][c] == r[c] for c in r.asDict())


def test_pass_verdict_rules(spark):
    rows = [(1, "q", '{"pass": 1, "score": 5}'), (2, "q", '{"pass": "no", "score": 4}'), (3, "q", '{"pass": true}'),
            (4, None, '{"pass": true, "score": 5, "issues": ["x"]}'), (5, "q", "oops"), (6, "q", '{"pass": 0, "score": 5}'),
            (7, "q", '{"pass": "", "score": 5}'), (8, "q", '{"pass": [], "score": 5}'), (9, "q", None)]
    df = spark.createDataFrame(rows, "id int, question string, raw string")
    p = V.pass_verdict("raw", missing=V.first_missing(["question"]))
    got = {r.id: r.p for r in df.select("id", p.alias("p")).collect()}
    assert [i for i in got if got[i].passed] == [1, 2]
    assert got[4].score == 0.0 and got[4].issues == ["Missing question"]
    assert got[5].issues == got[9].issues == ["Failed to parse judge reply"]


def test_accept_keeps_scores(spark):
    df = spark.createDataFrame([('{"accept": true, "context_quality": 4, "x": "y", "z": null, "w": 2.5}',), ("oops",),
                                (None,), ("[1]",)], "raw string")
    a = df.select(V.accept("raw").alias("a"), V.accept_scores("raw").alias("s")).collect()
    assert a[0].a.accept and a[0].s == {"context_quality": 4.0, "w": 2.5}
    assert not any(r.a.accept for r in a[1:]) and a[1].s == a[2].s == {} and a[3].s is None


@pytest.mark.parametrize("values", [[10**12 * i for i in range(300)], [f"k{i:04d}" for i in range(300)], []])
def test_range_index_of_sparse_keys(spark, values):
    df = spark.createDataFrame([(v, str(v)) for v in values], f"k {'string' if values and isinstance(values[0], str) else 'long'}, t string")
    got = range_index(df.repartition(5), "k", "i").collect()
    assert sorted((r.i, r.k) for r in got) == list(enumerate(sorted(values)))
    assert all(r.t == str(r.k) for r in got)


def test_range_index_of_equal_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).alias("k"), "id")
    got = sorted((r.i, r.k) for r in range_index(df, "k", "i").collect())
    assert [i for i, _ in got] == list(range(1000)) and [k for _, k in got] == [None] * 334 + [7] * 666


def shortest(edges):
    out = {}
    for start in {c for c, _ in edges}:
        depth, level = 0, {start}
        seen = {}
        while level:
            depth += 1
            level = {p for c, p in edges if c in level} - set(seen)
            seen |= {p: depth for p in level}
        out |= {(start, p): d for p, d in seen.items()}
    return sorted((n, a, d) for (n, a), d in out.items())


@pytest.mark.parametrize("edges", [
    [(i, i - 1) for i in range(1, 40)],
    [(i, i - 1) for i in range(1, 10)] + [(0, 0)],
    [(1, 2), (2, 3), (3, 1), (4, 1), (5, 4)],
    [(1, 2), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6)],
    [(1, 1), (2, 1), (3, 2), (8, 9), (9, 8)],
    [(1, 2), (1, 3), (2, 4), (3, 4), (4, 4), (4, 5)],
    [(1, 2), (2, 3), (3, 1), (1, 4), (4, 4)],
], ids=["chain", "root to itself", "cycle with tail", "2-cycle with tail", "mixed forest", "dag", "dag with cycle"])
def test_ancestors_equal_search(spark, edges):
    df = spark.createDataFrame(edges, "child long, parent long")
    assert sorted(map(tuple, ancestors(df).collect())) == shortest(edges)
