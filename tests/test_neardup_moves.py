"""Near-duplicate removal: what is shuffled with tokens, prefixes made in place, bitmaps that lose no pair."""

import random

import numpy as np

from lumeval.operators import neardup as D


def _rows(seed=9):
    g = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(g.choices(words, k=g.randrange(20, 80))) for _ in range(60)]
    near = []
    for t in texts[:30]:
        w = t.split()
        w[g.randrange(len(w))] = "other"
        near.append(" ".join(w))
    all_texts = texts + near + texts[:20] + ["", None]
    return [(i, t) for i, t in enumerate(all_texts)] + [(0, texts[0])]


def _loop(rows, num, den):
    kept, out = [], {}
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        s = set((t or "").lower().split())
        out[i] = not s or not any(den * len(s & k) > num * len(s | k) for k in kept)
        if s and out[i]:
            kept.append(s)
    return out


def test_plans_move_no_row_for_each_token(spark):
    before = max(_runs(spark), default=-1)
    df = spark.createDataFrame(_rows(), "seq long, text string").repartition(3)
    got = D.near_dup_keep(df, "seq", "text", 0.8).collect()
    assert {r.seq: r.kept for r in got} == _loop(_rows(), 4, 5)
    plans = [p for k, p in _runs(spark).items() if k > before]
    assert len(plans) > 5
    # tokens were ranked in a window over (seq, token) rows
    assert not any("Window" in p and "windowspecdefinition(seq" in p for p in plans)
    assert not any("min_by" in p for p in plans)


def _runs(spark):
    """Plans of the last queries, by number: older ones are forgotten."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {runs.apply(i).executionId(): runs.apply(i).physicalPlanDescription() for i in range(runs.size())}


def test_prefixes_are_the_rarest_tokens_in_one_order(spark):
    sets = [["a", "b", "c", "d", "e", "f", "g", "h", "i", "j"], ["a", "b", "c"], ["a"], ["j", "c", "a"]]
    reps = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(sets)], "seq long, toks array<string>, n int")
    got = {r.seq: list(r.prefix) for r in D.set_marks(reps, 9, 10).collect()}
    assert {k: len(v) for k, v in got.items()} == {0: 2, 1: 1, 2: 1, 3: 1}
    assert set(got[0]) <= set("defghi") and got[1] == ["b"] and got[3] == ["j"]
    assert got[2] == ["a"]


def test_bitmaps_differ_in_no_more_bits_than_sets_in_tokens(spark):
    g = random.Random(3)
    words = [f"t{i}" for i in range(150)]
    sets = [g.sample(words, g.randrange(1, 120)) for _ in range(40)]
    reps = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(sets)], "seq long, toks array<string>, n int")
    rows = {r.seq: np.array([r[f"s{i}"] for i in range(D.WORDS)]).view(np.uint64)
            for r in D.set_marks(reps, 9, 10).collect()}
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            assert sum(int(x).bit_count() for x in rows[i] ^ rows[j]) <= len(set(s) ^ set(t))
