"""Quality filter: interpolated modified Kneser-Ney model over characters, trained on trusted text.

One model per language.  Every text is padded with ``ORDER - 1`` start marks and one end mark;
its n-grams of ``ORDER`` code points are counted.  Counts of the highest order are plain counts over all
trusted text, lower orders are continuation counts; each order has the three discounts of
modified Kneser-Ney.  The corpus' distinct n-grams get their probability by joins against the
count tables; shards of texts then join the probabilities of the n-grams that occur in them and
sum them into a perplexity per document.  A document is kept when its perplexity is
at most the language's quantile of the trusted texts' perplexity, times ``SLACK``.

Defined results: a null or empty text has no n-gram but the end mark, perplexity null, and is rejected; a
language without trusted text has no threshold and keeps its texts (nothing speaks against them);
null languages form one group of their own; repeated rows get a row each; other columns are
never read.  Without any trusted row every non-empty text is kept.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, batches

ORDER = 4
QUANTILE = 0.99
SLACK = 1.3
SHARD_BYTES = 16 << 20  # text of a shard, whose distinct n-grams are looked up once
ROUNDS = 2                # parts of the shards that are scored one after the other
#: Spark's own filter of a join's large side by a bounded Bloom filter of the other, however small the scan.
BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
         "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
HELD_GRAMS = 400_000      # distinct n-grams that a task adds up before it passes them on
START, END = 0x02, 0x03
MASK21 = (1 << 21) - 1


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """High and low 42 bits (two code points each) of every padded 4-gram, and its text's index."""
    parts = []
    for t in texts:
        parts.append("\x02" * (ORDER - 1) + t + "\x03")
    sizes = np.array([len(p) for p in parts])
    cps = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    pair = (cps[:-1] << 21) | cps[1:]
    ends = np.cumsum(sizes)
    ok = np.ones(len(cps) - (ORDER - 1), bool)
    for k in range(1, ORDER):  # n-grams never cross two texts
        at = ends[:-1] - k
        ok[at[at < len(ok)]] = False
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(ok)]
    return pair[:-2][ok], pair[2:][ok], owner[ok]


def _unique(hi: np.ndarray, lo: np.ndarray):
    """Distinct pairs, and for every row the index of its pair."""
    order = np.lexsort((lo, hi))
    h, l = hi[order], lo[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return h[new], l[new], inverse


class _Tally:
    """Sorted 4-gram counts of one group, added to text by text."""

    def __init__(self):
        self.h = self.l = self.c = np.zeros(0, np.int64)

    def add(self, texts: list[str]) -> None:
        hi, lo, _ = _grams(texts)
        h, l, inv = _unique(hi, lo)
        c = np.bincount(inv).astype(np.int64)
        self.h, self.l, inv = _unique(np.concatenate([self.h, h]), np.concatenate([self.l, l]))
        self.c = np.bincount(inv, np.concatenate([self.c, c])).astype(np.int64)


def _tallied(parts, names: list[str], types: list):
    """``parts``: (key, texts) pairs -> batches (key.., hi, lo, c), one for each key unless it grows large."""
    held: dict[tuple, _Tally] = {}

    def give(key):
        t = held.pop(key)
        cols = [pa.array([k] * len(t.h), kind) for k, kind in zip(key, types)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(t.h), pa.array(t.l), pa.array(t.c)],
                                          names=[*names, "hi", "lo", "c"])
    last = None
    for key, texts in parts:
        if last is not None and key[:-1] != last:  # a shard's texts stand together
            for k in list(held):
                yield give(k)
        last = key[:-1]
        held.setdefault(key, _Tally()).add(texts)
        if len(held[key].h) > HELD_GRAMS:
            yield give(key)
    for k in list(held):
        yield give(k)


def _by_group(langs, texts):
    groups: dict = {}
    for g, t in zip(langs, texts):
        groups.setdefault(g, []).append(t or "")
    return groups.items()


def _trusted_counts(df: DataFrame) -> DataFrame:
    """(g, t) -> (g, hi, lo, c), added up within each task."""
    def run(it):
        parts = (((g,), texts) for batch in batches(it, "t")
                 for g, texts in _by_group(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        yield from _tallied(parts, ["g"], [pa.string()])
    return df.mapInArrow(run, "g string, hi long, lo long, c long")


def _blocks(df: DataFrame) -> DataFrame:
    """Rows as compressed blocks (shard, block) of about 1 MiB of text; a shard is a run of blocks of one task."""
    def run(it):
        part, size = TaskContext.get().partitionId(), 0
        z = zstandard.ZstdCompressor(level=6)
        for batch in batches(it, "t"):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as writer:
                writer.write_batch(batch)
            raw = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_arrays([pa.array([(part << 24) | (size // SHARD_BYTES)], pa.int64()),
                                              pa.array([z.compress(raw)], pa.binary())], names=["shard", "block"])
            size += len(raw)
    return df.mapInArrow(run, "shard long, block binary")


def _open(block: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block)) as reader:
        return reader.read_all().combine_chunks().to_batches()[0]


def _shard_grams(blocks: DataFrame) -> DataFrame:
    """(shard, g, hi, lo, c) of every block, added up within a shard."""
    def run(it):
        def parts():
            for batch in it:
                for shard, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                    rows = _open(block.as_py())
                    for g, texts in _by_group(rows.column(rows.num_columns - 2).to_pylist(),
                                              rows.column(rows.num_columns - 1).to_pylist()):
                        yield (shard, g), texts
        yield from _tallied(parts(), ["shard", "g"], [pa.int64(), pa.string()])
    return blocks.mapInArrow(run, "shard long, g string, hi long, lo long, c long")


def train(spark: SparkSession, ws: Workspace, trusted: DataFrame, text: str, lang: str) -> dict[str, DataFrame]:
    """Tables of the model: seen{k} (g, gram keys, p) for k = 1..4 and back{k} (g, history, gamma).

    Grams are keyed by packed code points: order 4 (hi, lo), order 3 (b, lo), order 2 (lo),
    order 1 (d), where hi holds code points a, b and lo holds c, d.
    """
    src = trusted.select(F.coalesce(lang, F.lit("")).alias("g"), F.col(text).alias("t"))
    c4 = ws.save(_trusted_counts(src).groupBy("g", "hi", "lo").agg(F.sum("c").alias("c")), "c4", BLOOM)
    b = F.col("hi").bitwiseAND(F.lit(MASK21)).alias("b")
    c3 = ws.save(c4.groupBy("g", b, "lo").agg(F.count("*").alias("c")), "c3")
    c2 = ws.save(c3.groupBy("g", "lo").agg(F.count("*").alias("c")), "c2")
    c1 = ws.save(c2.groupBy("g", F.col("lo").bitwiseAND(F.lit(MASK21)).alias("d"))
                 .agg(F.count("*").alias("c")), "c1")
    hist = {4: ["hi", F.shiftright("lo", 21).alias("x")], 3: ["b", F.shiftright("lo", 21).alias("x")],
            2: [F.shiftright("lo", 21).alias("x")], 1: []}
    out = {}
    lower = None
    for k, t in ((1, c1), (2, c2), (3, c3), (4, c4)):
        n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

        def disc(i):
            raw = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
            # too little text for the estimate: the usual constant discounts
            return F.coalesce(F.when((raw > 0) & (raw < i), raw), F.lit(0.25 + 0.25 * i)).alias(f"d{i}")
        discounts = t.groupBy("g").agg(*n).select("g", disc(1), disc(2), disc(3))
        hcols = hist[k]
        names = [c if isinstance(c, str) else "x" for c in hcols]
        rows = t.withColumns({"x": hcols[-1]} if hcols else {})
        stats = (rows.groupBy("g", *names).agg(
            F.sum("c").alias("total"), F.sum((F.col("c") == 1).cast("long")).alias("m1"),
            F.sum((F.col("c") == 2).cast("long")).alias("m2"), F.sum((F.col("c") > 2).cast("long")).alias("m3"))
            .join(discounts, "g")
            .withColumn("gamma", (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3"))
                        / F.col("total")))
        stats = ws.save(stats, f"stats{k}")
        own = (F.col("c") - F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2"))
               .otherwise(F.col("d3"))) / F.col("total")
        seen = rows.join(stats.drop("m1", "m2", "m3"), ["g", *names])
        if k == 1:
            # the lowest order interpolates with the uniform distribution over the seen alphabet and one unknown
            size = t.groupBy("g").agg((F.count("*") + 1).alias("alphabet"))
            seen = seen.join(size, "g").withColumn("p", own + F.col("gamma") / F.col("alphabet"))
            back = stats.join(size, "g").select("g", (F.col("gamma") / F.col("alphabet")).alias("unknown"))
        else:
            if k == 2:
                seen = seen.withColumn("d", F.col("lo").bitwiseAND(F.lit(MASK21)))
                key = ["g", "d"]
            elif k == 3:
                key = ["g", "lo"]
            else:
                seen = seen.withColumn("b", F.col("hi").bitwiseAND(F.lit(MASK21)))
                key = ["g", "b", "lo"]
            seen = (seen.join(lower.select(*key, F.col("p").alias("q")), key)
                    .withColumn("p", own + F.col("gamma") * F.col("q")))
            back = stats.select("g", *names, "gamma")
        grams = {1: ["d"], 2: ["lo"], 3: ["b", "lo"], 4: ["hi", "lo"]}[k]
        lower = ws.save(seen.select("g", *grams, "p"), f"seen{k}")
        out[f"seen{k}"], out[f"back{k}"] = lower, back
    return out


def log_probs(model: dict[str, DataFrame], grams: DataFrame) -> DataFrame:
    """(g, hi, lo, lp): log10 probability of the last code point of each distinct 4-gram.

    Lower orders are looked up for the distinct shorter grams alone, of which there are far fewer: a 4-gram
    travels for its own order, its history and its 3-gram only.  ``grams`` is read three times: pass a saved table.
    """
    x, d = F.shiftright("lo", 21).alias("x"), F.col("lo").bitwiseAND(F.lit(MASK21)).alias("d")
    b = F.col("hi").bitwiseAND(F.lit(MASK21)).alias("b")

    def order(df, k, key, history, lower):
        """``lower``: probability of the gram without its first code point, where the gram itself was not seen."""
        df = (df.join(model[f"seen{k}"].withColumnRenamed("p", "own"), key, "left")
              .join(model[f"back{k}"], history, "left"))
        return df.withColumn("p", F.coalesce("own", F.coalesce("gamma", F.lit(1.0)) * lower))
    one = (grams.select("g", "lo").distinct().select("g", "lo", x, d)
           .join(model["seen1"].withColumnRenamed("p", "p1"), ["g", "d"], "left").join(model["back1"], "g", "left")
           .select("g", "lo", "x", F.coalesce("p1", "unknown").alias("q")))
    two = order(one, 2, ["g", "lo"], ["g", "x"], F.col("q")).select("g", "lo", F.col("p").alias("q"))
    three = (order(grams.select("g", b, "lo").distinct().select("g", "b", "lo", x).join(two, ["g", "lo"]),
                   3, ["g", "b", "lo"], ["g", "b", "x"], F.col("q")).select("g", "b", "lo", F.col("p").alias("q")))
    four = order(grams.select("g", "hi", "lo", x, b).join(three, ["g", "b", "lo"]),
                 4, ["g", "hi", "lo"], ["g", "hi", "x"], F.col("q"))
    return four.select("g", "hi", "lo", F.log10("p").alias("lp"))


def _find(store, uh: np.ndarray, ul: np.ndarray) -> np.ndarray:
    """Log probabilities of sorted pairs (uh, ul) among the stored ones, sorted too."""
    h, l, lp = store
    left, right = np.searchsorted(h, uh, "left"), np.searchsorted(h, uh, "right")
    while True:
        go = left < right
        if not go.any():
            return lp[left]
        mid = (left + right) // 2
        less = go & (l[np.minimum(mid, len(l) - 1)] < ul)
        left, right = np.where(less, mid + 1, left), np.where(go & ~less, mid, right)


def _score(keep: list[str]):
    """Rows of both kinds, dealt by shard and sorted: first a shard's probabilities, then its blocks."""
    def run(it):
        current, store = None, {}
        for batch in it:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            shard, kind = col["shard"].to_numpy(False), col["kind"].to_numpy(False)
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(shard)]):
                if i == j:
                    continue
                if shard[i] != current:
                    current, store = shard[i], {}
                if kind[i] == 0:
                    part = [col[c].slice(i, j - i) for c in ("g", "hi", "lo", "lp")]
                    langs = part[0].to_pandas().to_numpy()
                    h, l, lp = (p.to_numpy(False) for p in part[1:])
                    for g in set(langs):
                        m = langs == g
                        store.setdefault(g, []).append((h[m], l[m], lp[m]))
                    continue
                for g, v in store.items():
                    if isinstance(v, list):
                        h, l, lp = (np.concatenate([a[i] for a in v]) for i in range(3))
                        order = np.lexsort((l, h))
                        store[g] = (h[order], l[order], lp[order])
                for block in col["block"].slice(i, j - i):
                    rows = _open(block.as_py())
                    langs = np.array(rows.column(rows.num_columns - 2).to_pylist(), object)
                    texts = rows.column(rows.num_columns - 1).to_pylist()
                    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                    for g in set(langs):
                        some = np.flatnonzero(langs == g)
                        hi, lo, owner = _grams([texts[r] or "" for r in some])
                        uh, ul, inv = _unique(hi, lo)
                        total[some] = np.bincount(owner, _find(store[g], uh, ul)[inv], len(some))
                        count[some] = np.bincount(owner, minlength=len(some))
                    out = [rows.column(k) for k in range(rows.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*out, pa.array(count), pa.array(total)],
                                                     names=[*keep, "g", "n_grams", "log10_prob"])
    return run


def perplexities(spark: SparkSession, docs: DataFrame, trusted: DataFrame, text: str = "text", lang: str = "lang",
                 keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang, n_grams, log10_prob, perplexity of every row of ``docs``.

    ``trusted``: rows (text, lang) that the model learns from.
    """
    ws = Workspace(spark, "quality")
    model = train(spark, ws, trusted, text, lang)
    ks = [f"k{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, ks)], F.coalesce(lang, F.lit("")).alias("g"),
                      F.col(text).alias("t"))
    blocks = ws.save(_blocks(src), "blocks")
    local = ws.save(_shard_grams(blocks).select("shard", "g", "hi", "lo").distinct(), "grams")
    ws.drop("c4", "c3", "c2")
    lps = ws.save(log_probs(model, ws.save(local.select("g", "hi", "lo").distinct(), "distinct")), "log_probs")
    ws.drop("distinct", "c1", *[f"{a}{k}" for a in ("stats", "seen") for k in (1, 2, 3, 4)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = src.select(*ks, "g").schema.add("n_grams", "long").add("log10_prob", "double")
    scored = []
    for k in range(ROUNDS):  # only one part's blocks and probabilities lie in shuffle files at a time
        mine = F.pmod(F.xxhash64("shard"), F.lit(ROUNDS)) == k
        found = local.filter(mine).join(lps, ["g", "hi", "lo"])
        left = found.select("shard", F.lit(0).alias("kind"), "g", "hi", "lo", "lp",
                            F.lit(None).cast("binary").alias("block"))
        right = blocks.filter(mine).select(
            "shard", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("g"), F.lit(None).cast("long").alias("hi"),
            F.lit(None).cast("long").alias("lo"), F.lit(None).cast("double").alias("lp"), "block")
        both = left.unionByName(right).repartition(parts, "shard").sortWithinPartitions("shard", "kind")
        scored.append(ws.save(both.mapInArrow(_score([*ks]), schema), f"scored_{k}"))
    scored = reduce(DataFrame.unionByName, scored)
    ws.drop("blocks", "grams", "log_probs")
    empty = F.col("n_grams") <= 1
    return scored.select(
        *[F.col(k).alias(c) for k, c in zip(ks, keep)], F.col("g").alias("lang_group"), "n_grams",
        F.when(~empty, F.col("log10_prob")).alias("log10_prob"),
        F.when(~empty, F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_grams"))).alias("perplexity"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
             slack: float = SLACK, keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns (doc_id among them), lang, n_chars_scored, perplexity, threshold, kept for every row of ``docs``.

    Trusted text: documents that ``labels`` gives quality 1; the threshold of a language is the
    ``quantile`` of its trusted documents' perplexity times ``slack``.
    """
    good = labels.filter("quality = 1").select("doc_id")
    trusted = docs.select("doc_id", "text", "lang").join(good, "doc_id", "left_semi")
    scores = perplexities(spark, docs.select(*keep, "text", "lang"), trusted, keep=keep)
    marks = (scores.filter("perplexity is not null").join(good, "doc_id", "left_semi").groupBy("lang_group")
             .agg((F.percentile_approx("perplexity", quantile, 10000) * slack).alias("threshold")))
    return (scores.join(marks, "lang_group", "left")
            .select(*keep, F.col("lang_group").alias("lang"), (F.col("n_grams") - 1).alias("n_chars_scored"),
                    "perplexity", "threshold",
                    F.coalesce((F.col("perplexity") <= F.col("threshold"))
                               | (F.col("threshold").isNull() & F.col("perplexity").isNotNull()),
                               F.lit(False)).alias("kept")))
