"""Text metrics in bounded runs, pairs by narrow keys, tables between rounds, cells without copied vectors, whole limits."""

import random

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lumeval.functions.text import WordIds, norm_collapse, text_runs, tok
from lumeval.operators import scorers as S
from lumeval.operators.bleu import _cut_13a, _ngram_stats, _pair_stats, bleu_scores, tokenize_13a, tokenize_13a_py
from lumeval.operators.rouge import rouge_scores
from lumeval.sources import fixtures as X


def _texts(n, seed=4):
    g = random.Random(seed)
    chars = ["a", "B", "7", ".", ",", "-", " ", "\t", "\n", "\x1c", " ", "&quot;", "&", "<skipped>", "é", "(", "..", "5,0", "it's"]
    return ["".join(g.choices(chars, k=g.randrange(0, 40))) for _ in range(n)]


def test_runs_are_bounded_and_whole():
    texts = ["x" * 400, None, "y" * 700, "", "z" * 3000, "w"]
    runs = list(text_runs(texts, limit=1000))
    assert runs == [(0, 3), (3, 5), (5, 6)]


def test_tokens_by_word_equal_the_rules(spark):
    texts = _texts(400)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokenize_13a(F.col("t")).alias("k")).collect()
    for r in rows:
        if "\x1c" not in r.t:  # the end of a text is cut by other rules there
            assert tokenize_13a_py(r.t) == list(r.k)


def test_pair_counts_equal_definition():
    texts = _texts(300)
    outs, refs = texts, texts[150:] + texts[:150]
    got = _pair_stats(outs, refs, WordIds(_cut_13a, limit=50))
    want = [_ngram_stats(tokenize_13a_py(o), tokenize_13a_py(r)) for o, r in zip(outs, refs)]
    assert np.array_equal(got, np.array(want))


def test_scores_make_no_token_rows(spark):
    df = spark.createDataFrame([(1, "a b", "a c")], "id long, reference string, output string")
    for plan in (bleu_scores(df, ["id"]), rouge_scores(df, ["id"])):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not any(k in text for k in ("Exchange", "Generate", "Aggregate", "CoGroup"))


def test_exact_match_and_jaccard_equal_their_expressions(spark):
    g = random.Random(5)
    pool = ["The", "the", " ", "  ", "\n", " ", "\x1d", "cat", "ΑΣ", "İ", "."]
    made = [("".join(g.choices(pool, k=8)), "".join(g.choices(pool, k=8))) for _ in range(200)]
    made += [(a, a.upper()) for a, _ in made[:50]] + [(None, "a"), ("a", None), (" ", "")]
    df = spark.createDataFrame(made, "r string, o string")
    both = F.size(F.array_union(tok("r"), tok("o")))
    rows = df.select(S.exact_match_expr(F.col("r"), F.col("o")).alias("m"), (norm_collapse("o") == norm_collapse("r")).alias("wm"),
                     S.jaccard_expr(F.col("r"), F.col("o")).alias("j"),
                     F.when(both == 0, 0.0).otherwise(F.size(F.array_intersect(tok("r"), tok("o"))) / both).alias("wj")).collect()
    assert all(r.m == r.wm and r.j == r.wj for r in rows)


def test_keys_of_pairs_read_no_text(spark):
    plan = X.eval_pairs(spark, SF_SMALL).select("id", "variant").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan


def test_pairs_of_repeated_ids(spark, tmp_path):
    spark.createDataFrame([(1, "en", "a b c", "s", 5), (1, "en", "d e", "s", 3), (None, "en", "x", "s", 1), (2, "en", None, "s", 0)],
                          "doc_id long, lang string, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    rows = X.eval_pairs(spark, str(tmp_path))
    assert rows.columns == ["id", "variant", "output", "category", "reference"]
    got = sorted((r.reference, r.output) for r in rows.filter("variant = 'swap' and id = 1").collect())
    assert got == [("a b c", "b a c"), ("a b c", "e d"), ("d e", "b a c"), ("d e", "e d")]
    assert rows.count() == 15


def test_rounds_compute_once_and_drop(spark, tmp_path):
    from lumeval.session import Rounds
    seen = spark.sparkContext.accumulator(0)

    def run(it):
        for batch in it:
            seen.add(batch.num_rows)
            yield batch
    rounds = Rounds(spark, "test_rounds")
    out = rounds.save(spark.range(50).mapInArrow(run, "id long"))
    assert sorted(r.id for r in out.collect()) == list(range(50)) and seen.value == 50
    rounds.drop(out)


def test_cell_takes_no_vector_with_the_hits():
    from lumeval.operators.retrieval import _cell_topk
    n, d = 2000, 512
    vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.random.default_rng(2).normal(size=n * d)))
    ids = pa.array(np.arange(n))
    qs = pa.table({"q": ids, "_self": ids.cast(pa.string()), "_vec": vec})
    cs = pa.table({"chunk_id": ids, "_self": ids.cast(pa.string()), "pos": ids, "_vec": vec})
    before = pa.default_memory_pool().max_memory()
    assert _cell_topk(3, True, [], [])(qs, cs).num_rows == 3 * n
    assert pa.default_memory_pool().max_memory() - before < vec.nbytes


def test_language_limits_come_from_all_documents(spark):
    import corpus_pipeline as P
    rows = [(i, "en", "en", 0.80 if i < 10 else 0.99) for i in range(1000)] + [(i, "de", "en", 0.1) for i in range(50)]
    got = P.score_limits(spark.createDataFrame(rows, "doc_id long, lang string, lang_pred string, score double"), ["en", "und"])
    assert got["en"] == 0.80 and set(got) == {"en", "und"}
