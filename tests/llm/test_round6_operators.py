"""Families of the n-gram join and rows that move: published parts, Bloom filters, texts left where they are."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from lumeval.llm import ngram_join as N
from lumeval.llm.common import maybe_among


def _sets(seed=5):
    """Pairs of sets that link, of many sizes: a set and one that differs in as many elements as a link allows."""
    g = np.random.default_rng(seed)
    sets = []
    for n in [*range(1, 60), *range(60, 900, 37)]:
        a = np.unique(g.integers(0, 1 << 64, n, np.uint64))
        off = int(len(a) * (1 - N.NUM / N.DEN) * g.random())
        b = a[off:]
        swap = int((len(a) * N.NUM / N.DEN - len(b) * 1.0) < 0 and (len(b) * (N.DEN - N.NUM) // (N.DEN + N.NUM)))
        c = np.unique(np.concatenate([a[swap:], g.integers(0, 1 << 64, swap, np.uint64)]))
        sets += [a, b, c]
    return sets


def test_linked_sets_publish_an_equal_part():
    sets = _sets()
    sig, row = N.parts_of(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    parts = [set(sig[row == i].tolist()) for i in range(len(sets))]
    linked = 0
    for i in range(0, len(sets), 3):
        for j in (i + 1, i + 2):
            both = len(np.intersect1d(sets[i], sets[j]))
            if N.DEN * both >= N.NUM * (len(sets[i]) + len(sets[j]) - both):
                linked += 1
                assert parts[i] & parts[j], (len(sets[i]), len(sets[j]))
    assert linked > 100


def test_published_parts_hold_several_elements():
    """Sets that share a tenth of their elements, as boilerplate: hardly any two publish an equal part."""
    g = np.random.default_rng(6)
    shared = g.integers(0, 1 << 64, 20, np.uint64)
    sets = [np.unique(np.concatenate([shared, g.integers(0, 1 << 64, 180, np.uint64)])) for _ in range(400)]
    sig, row = N.parts_of(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    owners = {}
    for s, r in zip(sig.tolist(), row.tolist()):
        owners.setdefault(s, set()).add(r)
    met = set().union(*[o for o in owners.values() if len(o) > 1])
    assert len(met) < 50, len(met)  # of 400; 161 when parts of one element were published


def test_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    among = maybe_among(spark, keys, "k")
    rows = spark.range(40_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    got = rows.filter(among(F.col("k"))).agg(F.count("*"), F.sum((F.coalesce("k", F.lit(0)) % 2 == 0).cast("int"))).first()
    assert got[1] == 20_000 and got[0] < 21_000
    tight = maybe_among(spark, keys, "k", most_bits=1 << 10)  # too small: more pass, none is lost
    assert rows.filter(tight(F.col("k"))).filter("coalesce(k, 0) % 2 = 0").count() == 20_000
    assert rows.filter(maybe_among(spark, keys.limit(0), "k")(F.col("k"))).count() == 0


def test_texts_without_copies_are_not_shuffled(spark, tmp_path, monkeypatch):
    g = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(g.choices(words, k=g.randrange(3, 60))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(300 + i, texts[i]) for i in range(20)]
    rows += [(None, texts[30]), (None, "only here and nowhere else"), (5, "an id that comes twice"), (7, ""), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, "
                               "source string, n_chars long").repartition(3)
    moved, profile = [], P.shingle_profile
    monkeypatch.setattr(P, "shingle_profile", lambda d, keep: (moved.append(d.count()), profile(d, keep))[1])
    got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, df, str(tmp_path)).collect()), key=str)
    want = [r for r in rows if not (r[0] or 0) >= 300 and not (r[0] is None and r[1] == texts[30])]
    assert got == sorted(want, key=str)
    assert 41 <= moved[0] < 60  # the copies, their originals and one more row with no id; all 325 rows before
