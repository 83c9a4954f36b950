"""Token alignment, fill-in-the-middle and sharding against direct computations on small fixtures: nulls, empty and
long texts, odd white space, repeated rows and ids, empty tables, and extra columns whose names clash."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumeval.llm import common, lm_score
from lumeval.llm import fill_in_middle as M
from lumeval.llm import sharding as S
from lumeval.llm import token_alignment as T

ODD = [(1, None), (2, ""), (3, "a"), (4, "  two  blanks "), (5, "end "), (6, " "), (7, "\n"), (8, "a\n b\t c  d"),
       (9, "x▁y"), (10, "<|endoftext|> <s> </s>"), (11, "日本語 テキスト 😀"), (12, "a\x00b"), (13, "a\x1c b"),
       (14, "don't  stop\r\n\r\n now"), (15, "x" * 5000), (16, "}\r });\r x"), (17, "a​ b"),
       (18, "the the the cat"), (18, "the the the cat"), (None, "the dog"), (None, None), (19, "   "), (20, "﻿a b"),
       (21, "has <P> mark"), (22, "a<S>"), (23, "<M>"), (24, "<<P > S>"), (-5, "négatif id"), (2**62, "large id")]
EXTRA = ("container", "a", "b", "n", "form", "output", "id", "size", "p", "cell", "plane", "doc", "__l", "at")


@pytest.fixture(scope="module")
def rows():
    g = random.Random(3)
    words = "the river of stone, under grey water. 12 été où ça house's".split()
    made = [(100 + i, "".join(g.choice(words) + g.choice([" ", " ", " ", "  ", "\n", "\t "]) for _ in range(g.randrange(40))))
            for i in range(120)]
    return ODD + made + [(300, "again " * 30_000)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(c) for c in EXTRA}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def ordered(found):
    return sorted((tuple(r) for r in found), key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


# --- token alignment

@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path(T.MODEL_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.MODEL_B)), T.Aligner()


def aligned(texts):
    """Groups of each text from both libraries on the whole text."""
    a, b, _ = libraries()
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in shown}
    byte |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    out = []
    for text in texts:
        groups = []
        if text:
            raw = (" " + text).encode()
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in left]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
                       else b.id_to_piece(i).replace("▁", " ").encode() for i in right]
            if b"".join(bytes_a) == raw == b"".join(bytes_b):
                ends = [{}, {}]
                for k, parts in enumerate((bytes_a, bytes_b)):
                    at = 0
                    for i, p in enumerate(parts):
                        at += len(p)
                        ends[k][at] = i + 1
                i = j = 0
                for cut in sorted(ends[0].keys() & ends[1].keys()):
                    groups.append((left[i:ends[0][cut]], right[j:ends[1][cut]]))
                    i, j = ends[0][cut], ends[1][cut]
        out.append(groups)
    return out


def alignment(rows):
    per_doc = aligned([t for _, t in rows])
    count = collections.Counter()
    for groups in per_doc:
        count.update({(x, y) for a, b in groups for x in a for y in b})
    top = collections.Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), groups in zip(rows, per_doc):
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    return out


def test_alignment_equals_brute_force(spark, docs, rows, empty):
    found = T.align(spark, docs, with_groups=True).collect()
    assert ordered(found) == ordered(alignment(rows))
    assert T.align(spark, empty).count() == 0


def test_alignment_does_not_depend_on_containers(spark, rows):
    """Small containers: many bitmaps of a pair, cut anywhere."""
    want = ordered(r[:-1] for r in alignment(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for limits in ((7, 1 << 20), (64, 200)):
        assert ordered(T.align(spark, df, limits=limits).collect()) == want


def groups_of(texts):
    return [";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g) for g in aligned(texts)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab' .\n\t\r  　▁é日😀\x1c0<>")), max_size=30), max_size=4))
def test_any_batch_of_texts(texts):
    aligner = libraries()[2]
    numbers, groups, keys, links = aligner.align(texts)
    assert groups.to_pylist() == groups_of(texts)
    assert numbers[:, 3].sum() == links.sum() and len(set(keys.tolist())) == len(keys)


def test_wide_groups_equal_narrow_ones(rows, monkeypatch):
    """Groups whose tokens are counted before they are linked give the same links."""
    texts = [t for _, t in rows]
    want = libraries()[2].align(texts)
    monkeypatch.setattr(T, "WIDE", 1)
    got = libraries()[2].align(texts)
    assert want[2].tolist() == got[2].tolist() and want[3].tolist() == got[3].tolist()


def test_bitmaps_round_trip():
    g = random.Random(5)
    np = T.np
    marks = sorted({(g.randrange(5) << 32 | g.randrange(3), g.choice([g.randrange(900), g.randrange(30)]))
                    for _ in range(3000)})
    pair, doc = np.array([p for p, _ in marks]), np.array([d for _, d in marks])
    ids, count, dense, bits = T.posting(pair, doc, 900)
    assert dense.any() and count.sum() == len(marks)
    thin = T.posting(pair[:5], doc[:5], 900)
    assert not thin[2].any()
    for p, d, f, b in ((pair, doc, dense, bits), (pair[:5], doc[:5], thin[2], thin[3])):
        row, found = T.documents_of(f, b)
        names = np.unique(p)
        assert sorted(zip(names[row].tolist(), found.tolist())) == list(zip(p.tolist(), d.tolist()))


# --- fill in the middle

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def middled(rows):
    out = []
    for i, text in rows:
        text = text or ""
        units = UNIT.findall(text)
        n = len(units)
        h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
            out.append((i, n, "plain", None, None, text))
        elif h4 % 100 < 80:
            out.append((i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return out


def test_middles_equal_brute_force_and_go_back(spark, docs, rows, empty):
    done = M.transform(docs, keep=["doc_id", "text", "form"]).toDF("doc_id", "text", "form0", "n", "form", "p", "m", "output")
    found = done.withColumn("back", M.restore("output", "form")).collect()
    assert ordered((r.doc_id, r.n, r.form, r.p, r.m, r.output) for r in found) == ordered(middled(rows))
    assert all(r.back == (r.text or "") and r.form0 == "form" for r in found)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    assert M.transform(empty).count() == 0


def test_units_may_hold_half_marks(spark):
    """Cuts beside pieces of marks: the text comes back whole."""
    texts = [(i, " ".join(random.Random(i).choices(["<", "<P", "P>", ">", "<S", "S>", "<M", "M>", "x"], k=12)))
             for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = M.transform(df, keep=["doc_id", "text"], rate=100, spm=50).withColumn("back", M.restore("output", "form"))
    rows = out.collect()
    assert all(r.back == r.text for r in rows) and {r.form for r in rows} == {"spm", "psm"}


# --- sharding

def test_sharding_by_definition(spark, docs, rows, empty):
    found = S.shard(spark, docs).collect()
    n = len(rows)
    want = sorted(((i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows))
    got = sorted((r.row_number, (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32)) for r in found)
    assert [k for k, _ in got] == list(range(n)) and [v for _, v in got] == want
    counts = collections.Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(40))
    for s in counts:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    for r in found:
        assert (r.shard, r.slot) == S.locate(r.row_number, n) and S.row_at(r.shard, r.slot, n) == r.row_number
        assert r.law == "rows" and r.grown_shard is None
    assert S.shard(spark, empty).count() == 0


def test_sharding_does_not_depend_on_the_layout(spark, docs):
    one = ordered(S.shard(spark, docs.coalesce(1).orderBy(F.desc("text"))).collect())
    assert one == ordered(S.shard(spark, docs.repartition(5)).collect())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 39, 40, 41, 1000, 4099])
def test_network_is_a_permutation(spark, n):
    places = [S.locate(i, n) for i in range(n)]
    assert len(set(places)) == n and {s + 40 * k for s, k in places} == set(range(n))
    (a, b), keys = S.sides(n), S.round_keys()
    cells = S.network(spark.range(a * b), "id", a, b, keys, "to").collect()
    assert sorted(r["to"] for r in cells) == list(range(a * b))
    assert a * b - n < a


def test_large_row_numbers():
    """The plan's arithmetic stays within 64 bits at the largest sides; order looks like chance at a small size."""
    n = 3 * 10**18
    assert all(S.row_at(*S.locate(i, n), n) == i for i in (0, 1, n // 2, n - 1))
    places = [s + 40 * k for s, k in (S.locate(i, 4000) for i in range(4000))]
    rising = sum(x < y for x, y in zip(places, places[1:]))
    assert 1850 < rising < 2150
    assert S.locate(7, 4000, seed=1) != S.locate(7, 4000, seed=2)


def test_vectors_of_any_finite_length_are_linked(spark):
    """Squares that overflow or underflow: the cosine decides."""
    from lumeval.llm import embedding_dedup
    rows = [(1, "a", [1e200, 1e200]), (2, "a", [1e200, 1e200]), (3, "a", [1e-200, 1e-200]), (4, "a", [3.0, 3.0]),
            (5, "a", [1e300, -1e300]), (6, "a", [5e-324, 0.0]), (7, "a", [2.0, 0.0]), (8, "a", [0.0, 0.0]),
            (9, "b", [1.0, 1.0]), (10, "a", [-1e-300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark, df).collect()}
    assert got == {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 4: (3, 1, False), 5: (0, 5, True), 6: (1, 6, True),
                   7: (1, 6, False), 8: (0, 8, True), 9: (0, 9, True), 10: (0, 10, True)}


def test_lm_log_probs_equal_forward_with_small_and_large_weights():
    g = np.random.default_rng(4)
    x, y = g.integers(0, 7, (5, lm_score.SPAN)), g.integers(0, 6, (5, lm_score.SPAN))
    for times in (1, 16):  # 16: logits far beyond SAFE, of which 32-bit floats keep fewer decimals
        net = lm_score.Attention(6)
        net.p = {k: w * np.float32(times) for k, w in net.p.items()}
        for first in (0, lm_score.CONTEXT):
            want = np.take_along_axis(net.forward(x, first)[0], y[:, first:, None], 2)[..., 0]
            assert np.allclose(net.log_probs(x, y, first), want, rtol=1e-3, atol=1e-3)


def test_lm_shard_counts_equal_direct_ones(spark, monkeypatch):
    monkeypatch.setattr(common, "batches", lambda it, c: (b.slice(i, 2) for b in it for i in range(0, b.num_rows, 2)))
    texts = ["a b  a b", None, "", "Hello, world\nhello", "z" * 3000, "a b", " "]
    direct = lm_score.id_arrays(lm_score.WordIds(), texts)
    rows = [(i, i % 2 == 0, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, learn boolean, text string").selectExpr(
        "doc_id", "false AS held_out", "int(learn) AS learn", "text").coalesce(1)
    made = common.blocks(docs, "text", 64)
    got = {}
    for r in made.mapInArrow(lm_score._shard_counts(None), "shard long, kind int, word long, c long").collect():
        got[r.kind, r.word] = got.get((r.kind, r.word), 0) + r.c
    ids, off, _ = direct
    pairs, learn = lm_score.before(ids, off) * lm_score.VOCABULARY + ids, np.repeat([r[1] for r in rows], np.diff(off))
    want = {}
    for k, on in zip(pairs.tolist(), learn.tolist()):
        want[k] = want.get(k, 0) + on
    assert {w: c for (kind, w), c in got.items() if kind == 1} == want
    assert sum(c for (kind, _), c in got.items() if kind == 0) == sum(len((t or "").split()) for _, on, t in rows if on)
