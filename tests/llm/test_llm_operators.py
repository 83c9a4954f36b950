"""The ten operators against brute force on small fixtures: nulls, empty and long texts, ties,
repeated rows, empty tables, and extra columns whose names clash with the operators' own."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumeval.llm import (embedding_dedup, html_extract, language_id, lm_score, ngram_join, packing, piece_codec,
                         quality_kn, suffix_dedup, topk_search)

WORDS = "the and river of stone light under grey water house by morning old road to hill tree bird is a".split()
MOTS = "le et rivière de pierre lumière sous grise eau maison par matin vieille route à colline été où ça".split()


def text(seed, n, words=WORDS):
    g = random.Random(seed)
    return " ".join(g.choice(words) for _ in range(n))


def rows():
    long = text(1, 400)
    near = long.split()
    near[200] = "altered"
    out = [(1, long, "en"), (2, " ".join(near), "en"), (3, long, "en"), (4, None, "en"), (5, "", None),
           (6, "one two", "en"), (6, "one two", "en"), (7, "ONE two", "fr"), (8, " \t\n", "en"), (None, text(9, 50), "en"),
           (None, None, None), (9, "x" * 700, "en"), (10, text(10, 6000), "en"), (11, "123 456!", "fr"),
           (12, text(12, 60, MOTS), "fr")]
    out += [(100 + i, text(100 + i, 60), "en") for i in range(12)]
    out += [(200 + i, text(200 + i, 60, MOTS), "fr") for i in range(12)]
    return out


SCHEMA = "doc_id long, text string, lang string"
EXTRA = ("cls", "n", "anchor", "tkey", "shard", "g", "t", "k0", "c", "window", "z", "held_out", "score", "sig", "label")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.withColumns({c: F.lit(c) for c in EXTRA}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


def test_suffix_dedup_equals_brute_force(spark, docs, empty):
    raw = [(i, (t or "").encode()) for i, t, _ in rows()]
    seen = collections.Counter(b[k:k + 200] for _, b in raw for k in range(len(b) - 199))
    want = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((i, len(b), int(gone.sum()), len(suffix_dedup.runs_of(gone)), hashlib.sha256(rest).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.remove_repeats(spark, docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert suffix_dedup.remove_repeats(spark, empty).collect() == []


@pytest.mark.parametrize("limit", [2, 8192])
def test_suffix_dedup_with_crowded_anchors(spark, monkeypatch, limit):
    """Many texts share one passage; small group limits force the finer cuts, with equal results."""
    monkeypatch.setattr(suffix_dedup, "GROUP_PIECES", limit)
    passage = text(5, 80)
    data = [(i, f"{text(300 + i, 40)} {passage} {text(400 + i, 40)}") for i in range(9)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    seen = collections.Counter(t[k:k + 200] for _, t in data for k in range(len(t) - 199))
    for r in suffix_dedup.remove_repeats(spark, df).collect():
        t = data[r.doc_id][1]
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                gone[k:k + 200] = True
        assert r.n_removed == gone.sum() and r.n_removed >= len(passage)


def test_interval_expansion_equals_counting():
    g = np.random.default_rng(2)
    for _ in range(40):
        n = int(g.integers(3, 9))
        base = g.integers(0, 3, 60).astype(np.uint8)
        pieces = [base[a:a + int(g.integers(n, 25))].copy() for a in g.integers(0, 35, int(g.integers(1, 7)))]
        pieces = [p for p in pieces if len(p) >= n]
        weights = g.integers(1, 3, len(pieces))
        seen = collections.Counter()
        for p, w in zip(pieces, weights):
            for i in range(len(p) - n + 1):
                seen[p[i:i + n].tobytes()] += w
        want = [[seen[p[i:i + n].tobytes()] >= 2 for i in range(len(p) - n + 1)] for p in pieces]
        assert [h.tolist() for h in suffix_dedup.repeated_starts(pieces, weights, n)] == want


def brute_components(items):
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    return parent, root


def test_ngram_join_equals_brute_force(spark, docs, empty):
    data = rows()
    sets = []
    for _, t, _ in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    parent, root = brute_components(data)
    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = collections.defaultdict(list)
    for i, r in enumerate(data):
        if r[0] is not None:
            ids[root(i)].append(r[0])
    want = [(r[0], len(sets[i]), min(ids[root(i)], default=None)) for i, r in enumerate(data)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark, docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert ngram_join.jaccard_components(spark, empty).collect() == []


def test_language_id(spark, docs, empty):
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got}
    for i in (4, 5, 8, 11):
        assert by[i].lang_pred == "und" and by[i].score == 0
    right = [r.lang_pred == ("en" if r.doc_id < 200 else "fr") for r in got if r.doc_id and r.doc_id >= 100]
    assert sum(right) >= 22
    assert all(0 <= r.score <= 1 for r in got)
    assert by[100].held_out == (zlib.crc32(b"100") % 5 == 0)
    assert language_id.identify(empty).collect() == []


def test_network_gradients():
    net = language_id.Network(3, hidden=4)
    g = np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = g.integers(0, 256, (5, 9)).astype(np.uint8)
    mask = np.ones((5, 9))
    mask[2, 6:] = 0
    y = np.array([0, 1, 2, 1, 0])
    _, grads = net.loss_and_grads(x, mask, y)
    for k in net.p:
        at = (x[1, 3], 2) if k[0] == "X" else tuple(0 for _ in net.p[k].shape)
        net.p[k][at] += 1e-5
        up, _ = net.loss_and_grads(x, mask, y)
        net.p[k][at] -= 2e-5
        down, _ = net.loss_and_grads(x, mask, y)
        net.p[k][at] += 1e-5
        assert math.isclose(grads[k][at], (up - down) / 2e-5, rel_tol=1e-4, abs_tol=1e-8)


def test_packing(spark, docs, empty):
    from lumeval.llm.tokens import WordIds
    tokens = WordIds()
    got = packing.pack(spark, docs, with_ids=True).collect()
    want = sorted(tokens.ids(t) + (1).to_bytes(4, "little") for _, t, _ in rows())
    # per document: ids in order give each text back; repeated rows are told apart by their pieces' sequences
    assert sum(r.length for r in got) == sum(len(w) // 4 for w in want)
    for r in got:
        assert zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) == r.ids_crc32 and len(r.ids) == r.length
    singles = collections.Counter(r[0] for r in rows())
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, t, _ in rows():
        if i is not None and singles[i] == 1:
            parts = sorted(by[i], key=lambda r: r.start)
            raw = b"".join(struct.pack(f"<{len(p.ids)}I", *p.ids) for p in parts)
            assert raw == tokens.ids(t) + (1).to_bytes(4, "little") and parts[0].doc_tokens == len(raw) // 4
    fill = collections.defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for spans in fill.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= packing.LENGTH
    assert packing.pack(spark, empty).collect() == []


def test_word_ids_equal_the_tokenizer():
    from lumeval.llm.tokens import WordIds
    tokens = WordIds()
    for t in ["a b c", "x\x1cy", "<|startoftext|> hi<|endoftext|>", "ΟΔΟΣ Σ", "é ́a it's DON'T 3a4", "", "日本　x\x01y"]:
        ids = tokens.tokenizer.encode(t, add_special_tokens=False).ids
        assert tokens.ids(t) == struct.pack(f"<{len(ids)}I", *ids)


def test_quality_perplexity_equals_direct_model(spark, docs, empty):
    labels = spark.createDataFrame([(100 + i, 1) for i in range(12)] + [(200, 1), (201, 1), (5, 0), (None, 1)],
                                   "doc_id long, quality int")
    got = quality_kn.classify(spark, docs, labels).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got}
    assert not by[4].kept and by[4].perplexity is None and not by[5].kept
    assert all(by[100 + i].kept for i in range(12)) and not by[9].kept
    assert by[9].perplexity > by[103].perplexity
    none = quality_kn.classify(spark, docs, labels.filter("quality = 7")).collect()
    assert all(r.kept == (r.perplexity is not None) for r in none)
    assert quality_kn.classify(spark, empty, labels).collect() == []


def test_kneser_ney_sums_to_one(spark):
    from lumeval.llm.common import Workspace
    df = spark.createDataFrame([(1, text(1, 80), "en"), (2, text(2, 50), "en")], SCHEMA)
    model = quality_kn.train(spark, Workspace(spark, "t"), df, "text", "lang")
    letters = [r.d for r in model["seen1"].select("d").collect()]
    pack = lambda a, b: (ord(a) << 21) | ord(b)
    for h in ("the", "zqx", "e s"):
        grams = spark.createDataFrame([("en", pack(h[0], h[1]), (ord(h[2]) << 21) | d) for d in letters],
                                      "g string, hi long, lo long")
        total = quality_kn.log_probs(model, grams).select(F.sum(F.pow(F.lit(10.0), F.col("lp")))).first()[0]
        assert 0.9 < total <= 1.0 + 1e-9  # the rest belongs to characters never seen


def vectors():
    g = np.random.default_rng(4)
    base = g.normal(size=(40, 16))
    out = []
    for i in range(300):
        v = base[i % 40] + g.normal(size=16) * (0.02 if i % 3 else 0.25)
        out.append((i, v.tolist(), int(i % 4)))
    out += [(300, out[0][1], 0), (300, out[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [math.nan] + [1.0] * 15, 1),
            (304, [None] + [1.0] * 15, 1), (305, [1.0, 2.0], 1), (306, out[1][1], None), (400, out[5][1], 2), (307, [], 1)]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit(c) for c in ("key", "raw", "cls", "n", "score")}).repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and None not in v and all(map(math.isfinite, v))


def test_embedding_dedup_equals_brute_force(spark, table):
    data = vectors()
    parent, root = brute_components(data)
    links = [0] * len(data)
    for a in range(len(data)):
        for b in range(len(data)):
            (_, u, la), (_, v, lb) = data[a], data[b]
            if a != b and la is not None and la == lb and usable(u) and usable(v) and len(u) == len(v) and any(u) and any(v):
                u, v = np.array(u), np.array(v)
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                    links[a] += 1
                    parent[root(a)] = root(b)
    low = collections.defaultdict(lambda: 10 ** 9)
    for i, r in enumerate(data):
        low[root(i)] = min(low[root(i)], r[0])
    want = [(r[0], links[i], low[root(i)], r[0] == low[root(i)]) for i, r in enumerate(data)]
    got = [tuple(r) for r in embedding_dedup.near_duplicates(spark, table).collect()]
    assert sorted(got) == sorted(want)
    assert embedding_dedup.near_duplicates(spark, table.limit(0)).collect() == []


def test_topk_equals_brute_force(spark, table):
    data = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v, _ in vectors() if usable(v)})
    want = []
    for i, q in data:
        if i % 100 == 0:
            score = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in data
                            if (j, v) != (i, q) and len(v) == len(q)))[:10]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(score)]
    got = [tuple(r) for r in topk_search.top_k(spark, table).collect()]
    assert sorted(got) == sorted(want)
    assert topk_search.top_k(spark, table.limit(0)).collect() == []


def test_lm_score_baseline_and_model(spark, docs, empty):
    data = rows()
    words = [re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) for _, t, _ in data]
    count = collections.Counter()
    for (i, _, _), w in zip(data, words):
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(w + [None])
    n, v = sum(count.values()), len(count)
    want = []
    for (i, _, _), w in zip(data, words):
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w + [None])
        want.append((i, len(w) + 1, sum(count[x] > 0 for x in w + [None]), n, round(base, 6)))
    got = lm_score.score_texts(spark, docs).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got),
                  key=key) == sorted(want, key=key)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_score.score_texts(spark, empty).collect() == []


def test_attention_gradients_and_windows():
    net = lm_score.Attention(4)
    g = np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = g.integers(0, 5, (3, lm_score.SPAN)), g.integers(0, 4, (3, lm_score.SPAN))
    on = np.ones_like(x, dtype=float)
    on[1, 7:] = 0
    _, grads = net.grads(x, y, on)
    for k in net.p:
        at = (x[0, 0], 1) if k in "QKVS" else tuple(0 for _ in net.p[k].shape)
        net.p[k][at] += 1e-5
        up, _ = net.grads(x, y, on)
        net.p[k][at] -= 2e-5
        down, _ = net.grads(x, y, on)
        net.p[k][at] += 1e-5
        assert math.isclose(grads[k][at], (up - down) / 2e-5, rel_tol=1e-3, abs_tol=1e-7)
    off = np.array([0, 1, 18, 60])
    _, _, at, whole, valid = lm_score.windows(np.zeros(60, int), off, 4)
    new = valid.copy()
    new[~whole, :lm_score.CONTEXT] = False
    assert sorted(at[new]) == list(range(60))  # every token is scored once


def test_piece_codec(spark, docs, empty):
    codec = piece_codec.Codec()
    g = random.Random(0)
    words = sorted({"▁" + "".join(g.choice("abcdeé日🙂") for _ in range(g.randint(1, 9))) for _ in range(300)})
    found = codec.search(words)
    for w in words:  # plain Viterbi, word by word
        best = [0.0] + [-1e18] * len(w)
        for j in range(1, len(w) + 1):
            best[j] = max([best[i] + codec.score[w[i:j]][0] for i in range(j) if w[i:j] in codec.score]
                          + [best[j - 1] + codec.penalty])
        ids, total, at = np.frombuffer(found[w], "<u4").tolist(), 0.0, 0
        pieces = b"".join(codec.raw[i] for i in ids).decode().replace(" ", "▁")
        assert pieces == w
        score = {i: s for s, i in codec.score.values()}
        k = 0
        while k < len(ids):
            if ids[k] in score:
                total += score[ids[k]]
                k += 1
            else:
                first = codec.raw[ids[k]][0]
                total += codec.penalty
                k += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        assert total == best[-1]
        del at
    got = piece_codec.encode(docs)
    assert got.filter("not round_trip").count() == 0
    back = piece_codec.decode(got).collect()
    assert sorted((r.text for r in back)) == sorted((t or "") for _, t, _ in rows())
    odd = ["a▁b  c\n\n d\t", "▁", " ", "\n", "x\x00y", "\x00▁"]
    assert [codec.decode(np.frombuffer(r, "<u4")) for r in codec.encode(odd)] == odd
    assert piece_codec.encode(empty).collect() == []


def test_html_extract(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
            "<div class='share'>Promo {i}</div><!-- c --><article><h1>Head {i}</h1><p><b>One &amp; two<br>three {i}"
            "<p>Four   five {i}<div class='box'>Same box</div><section id='comments'><p>Reader {i}</p></section></article>"
            "<footer>&copy; x</footer>")
    data = [(i, f"http://h.example/{i}", page.replace("{i}", str(i))) for i in range(12)]
    data += [(50, None, None), (51, "http://h.example/e", ""), (52, "u", "plain  text &lt;x&gt;"), (0, data[0][1], data[0][2])]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumns(
        {c: F.lit(c) for c in ("host", "low", "node", "text")})
    got = html_extract.extract(spark, df).collect()
    assert len(got) == len(data)
    by = {r.page_id: r.text for r in got}
    for i in range(12):
        assert by[i] == f"Head {i}\nOne & two three {i}\nFour five {i}"  # the box is the same on all pages
    assert by[50] == "" and by[51] == "" and by[52] == "plain text <x>"
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(spark, df.limit(0)).collect() == []


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    import corpus_pipeline as P
    data = [(i, t, l, "s", len(t or "")) for i, t, l in rows()]
    spark.createDataFrame(data, SCHEMA + ", source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(100 + i, 1, 0) for i in range(12)] + [(200 + i, 1, 0) for i in range(12)],
                          "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"s{i}"))
        docs = spark.read.parquet(str(tmp_path / f"s{i}"))
        assert docs.columns == P.COLUMNS
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = {100 + i for i in range(12)} | {200 + i for i in range(12)}
    assert all(clean <= s for s in ids[:3]) and 4 not in ids[0] and 11 not in ids[0]
    assert not {2, 3} & ids[2]
    assert P.packing(spark, docs, str(tmp_path)).count() > 0


def test_pipeline_keeps_unrelated_rows_of_null_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline as P
    good = {100 + i: text(100 + i, 60) for i in range(12)}
    same = text(920, 60)
    data = [*good.items(), (None, text(900, 60)), (None, text(901, 60)), (None, text(902, 60)), (None, "qzx7" * 60),
            (5, text(910, 60)), (5, text(911, 60)), (5, "zq#9" * 60), (8, same), (7, same), (None, same), (7, same)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], SCHEMA + ", source string, n_chars long")
    spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    junk = {"qzx7" * 60, "zq#9" * 60}
    got = sorted(((r.doc_id, r.text) for r in P.quality(spark, df, str(tmp_path)).collect()), key=key)
    assert got == sorted((r for r in data if r[1] not in junk), key=key)
    got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, df, str(tmp_path)).collect()), key=key)
    assert got == sorted([r for r in data if r[1] != same] + [(7, same)], key=key)


def test_lm_score_of_spaceless_text_grows_with_it(spark):
    g = random.Random(3)
    run = "".join(g.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(4000))
    a, b, c = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]  # held out: words not seen
    data = [(i, text(i, 60), "en") for i in range(100, 112)] + [(a, run[:2000], "en"), (b, run, "en"), (c, run[::-1], "en")]
    by = {r.doc_id: r.score for r in lm_score.score_texts(spark, spark.createDataFrame(data, SCHEMA)).collect()}
    assert 1.7 < by[b] / by[a] < 2.3 and by[b] < -1000 and by[b] != by[c]


def test_lm_sample_holds_a_copied_text_once(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SAMPLE_TEXTS", 40)
    monkeypatch.setattr(lm_score, "Model", lambda texts, *_: texts)
    for k in range(4):  # whichever text is the hot one
        data = [(text(k, 30),)] * 300 + [(text(50 + i, 30),) for i in range(60)]
        got = lm_score.fit(spark.createDataFrame(data, "text string"))
        assert len(got) == len(set(got)) == 40


def test_lm_counts_cover_all_training_texts(spark, monkeypatch):
    """Pairs of ids are counted in texts outside the network's sample, and beyond its window."""
    from lumeval.llm.tokens import WordIds
    monkeypatch.setattr(lm_score, "SAMPLE_TEXTS", 2)
    monkeypatch.setattr(lm_score, "SAMPLE_CHARS", 40)
    made, fit = [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda *a: made.append(fit(*a)) or made[0])
    data = [(i, text(i, 80), "en") for i in range(100, 130)]
    lm_score.score_texts(spark, spark.createDataFrame(data, SCHEMA)).collect()
    learned = [t for i, t, _ in data if zlib.crc32(str(i).encode()) % 5 != 1]
    ids, off, _ = lm_score.id_arrays(WordIds(), learned)
    want = np.bincount(lm_score.before(ids, off), minlength=lm_score.VOCABULARY)
    assert (made[0].total == want).all() and lm_score.SPAN - lm_score.CONTEXT >= 32


def test_pipeline_rejects_unlearned_languages_and_noise(spark):
    import corpus_pipeline as P
    g = random.Random(8)
    clean = [(i, text(i, 60, MOTS if i % 2 else WORDS), "fr" if i % 2 else "en") for i in range(1600)]
    polish = "stary most przechodzi przez rzekę obok domu w którym mieszkają dziadkowie dziewczyny która codziennie".split()
    other = [(5000 + i, text(i, 60, polish), None) for i in range(30)]
    noise = [(6000 + i, "".join(g.choice("bcdfghjklmnpqrstvwxz ") for _ in range(300)), None) for i in range(30)]
    df = spark.createDataFrame([(i, t, l, "s", len(t)) for i, t, l in clean + other + noise],
                               SCHEMA + ", source string, n_chars long")
    ids = [r.doc_id for r in P.language(spark, df, None).select("doc_id").collect()]
    assert sum(i < 5000 for i in ids) >= 0.98 * len(clean)
    assert sum(5000 <= i < 6000 for i in ids) <= 3 and sum(i >= 6000 for i in ids) <= 3


def test_language_training_draws_every_class():
    net, seen = language_id.Network(130, hidden=2), set()
    grads = net.loss_and_grads
    net.loss_and_grads = lambda x, mask, y: seen.update(y.tolist()) or grads(x, mask, y)
    net.train([(b"abc", k) for k in range(130)], steps=2)
    assert len(seen) == 130
