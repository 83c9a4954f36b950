"""Rules that must not fail open, loops that must end, and settings that must win."""

import pytest
from pyspark.sql import functions as F

from lumeval.functions import verdicts as V
from lumeval.operators import lineage as L
from lumeval.operators import scorers as S
from lumeval.operators.neardup import _fraction


def test_truthy_flags(spark):
    data = [('{"is_toxic": true}', True), ('{"is_toxic": "true"}', True), ('{"is_toxic": 1}', True),
            ('{"is_toxic": 0.0}', False), ('{"is_toxic": "false"}', True), ('{"is_toxic": ""}', False),
            ('{"is_toxic": null}', False), ('{"is_toxic": []}', False), ('{"is_toxic": [0]}', True),
            ('{"is_toxic": {}}', False), ('{}', False), ('[1]', False), ('not json', False), (None, False)]
    df = spark.createDataFrame(data, "raw string, want boolean")
    assert df.filter(V.toxicity("raw").getField("flagged") != F.col("want")).collect() == []


def test_nan_is_not_the_best_score(spark):
    df = spark.createDataFrame([("nan",), ("5",), ("x",)], "raw string")
    got = [r[0] for r in df.select(V.capped_score("raw")[0]).collect()]
    assert got[0] != got[0] and got[1] == 0.9999 and got[2] is None


def test_carriage_return_does_not_hide_a_pattern(spark):
    df = spark.createDataFrame([("<|a\rb|>",), ("<|a\nb|>",)], "m string")
    got = [r[0] for r in df.select(S.first_injection_match(F.col("m"))).collect()]
    assert got[0] is not None and got[1] is None


@pytest.mark.parametrize("edges,want", [
    ([(1, 2), (2, 1)], {(1, 2, 1), (2, 1, 1), (1, 1, 2), (2, 2, 2)}),
    ([(0, 0)], {(0, 0, 1)}),
    ([(1, 2), (2, 1), (2, 3)], {(1, 2, 1), (2, 1, 1), (1, 1, 2), (2, 2, 2), (2, 3, 1), (1, 3, 2)}),
])
def test_cycles_end(spark, edges, want):
    df = spark.createDataFrame(edges, "child long, parent long")
    assert {tuple(r) for r in L.ancestors(df).collect()} == want


def test_deep_chain_is_complete(spark):
    df = spark.createDataFrame([(i + 1, i) for i in range(40)], "child long, parent long")
    assert L.ancestors(df).count() == 40 * 41 // 2


def test_threshold_is_exact():
    assert _fraction(0.9000001) == (9000001, 10000000)


def test_braces_and_fields_are_read_from_the_left(spark):
    from lumeval.operators.prompts import render_columns
    t = '{{"m": {message}}} {{{who}}} }}{{ {message}'
    df = spark.createDataFrame([(t, "a{who}b", None)], "t string, m string, w string")
    got = df.select(render_columns(F.col("t"), {"message": F.col("m"), "who": F.col("w")})).first()[0]
    assert got == t.format(message="a{who}b", who="")


def test_mean_is_rounded_once(spark):
    import datetime as dt
    from lumeval.operators.timeseries import price_stats
    rows = [(1, dt.datetime(2024, 1, i + 1), p) for i, p in enumerate((10.004, 10.004, 10.009))]
    got = price_stats(spark.createDataFrame(rows, "symbol long, ts timestamp_ntz, close double"), ("max",)).first()
    assert got["average"] == 10.01


def test_retrieval_of_text_ids_nulls_and_id_lists(spark):
    from lumeval.operators import retrieval as R
    q = spark.createDataFrame([("q1", [1.0, 0.0], ["a", "a", "z"]), ("q2", [0.0, 0.0], ["a"]), ("q3", None, None),
                               ("q4", [None, 1.0], [])], "q string, embedding array<double>, relevant_ids array<string>")
    c = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("b", 1, [0.5, 0.5]), ("n", 2, None), ("o", 3, [0.0, 0.0])],
                              "chunk_id string, pos long, embedding array<double>")
    hits = R.top_k_cosine(q, c, 3)
    assert sorted((r["q"], r["rank"], r["chunk_id"]) for r in hits.collect()) == [("q1", 1, "a"), ("q1", 2, "b")]
    got = {r["q"]: tuple(r)[1:] for r in R.scores_by_id_list(hits, q).collect()}
    assert got == {"q1": (0.5, 0.5), "q2": (0.0, 0.0), "q3": (0.0, 1.0), "q4": (0.0, 1.0)}


def test_questions_without_hits_keep_their_row(spark):
    from lumeval.operators import retrieval as R
    q = spark.createDataFrame([(1, [1.0], "x"), (2, [0.0], "x"), (3, [0.0], "y")], "q long, embedding array<double>, label string")
    c = spark.createDataFrame([(7, 0, [1.0], "x")], "chunk_id long, pos long, embedding array<double>, label string")
    counts = spark.createDataFrame([("x", 1)], "_ql string, n_relevant long")
    for carried in ((), ("label",)):
        hits = R.top_k_cosine(q, c, 1, carry=("label",), q_carry=carried)
        got = {r["q"]: tuple(r)[2:] for r in R.retrieval_scores(hits, q, counts).collect()}
        assert got == {1: (1.0, 1.0), 2: (0.0, 0.0), 3: (0.0, 1.0)}
