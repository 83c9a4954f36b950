"""Ordered greedy near-duplicate removal.

Semantics: walk rows in ``order_col`` order and drop a row whose token-set
Jaccard with any *already kept* row is strictly above ``threshold``; rows
with an empty token set never match.  This is the lexicographically first
maximal independent set of the similarity graph -- not connected
components (A~B, B~C, A!~C keeps A and C).

Plan:

1. Token sets, then identical sets collapse to their first row with a
   partial aggregate of digests; only rows that may have a copy are shuffled
   with their tokens.  Every later copy is always dropped (Jaccard 1 with a
   row that is kept, or with one dropped by a kept row that also covers the
   copy), so a group of copies holding a third of all rows costs one
   aggregate, not a quadratic pair set.
2. Prefix filtering (PPJoin, Xiao et al. 2008): tokens ordered by global
   rarity (counted in a bounded number of hash buckets, so that each row finds its prefix
   where it is; any order common to all rows is right), each set keeps its first ``|x| - ceil(t|x|) + 1`` tokens; two sets
   can only be similar if they share a prefix token and their sizes satisfy
   ``t|x| <= |y| <= |x|/t``.  All bounds are exact integer arithmetic on the
   threshold's fraction.
3. Rounds (``resolve_front_rounds``) compare undecided rows only with rows
   kept in the previous round and with the first ``front`` undecided rows of
   each shared prefix-token group.  A candidate pair first meets by bitmaps of its sets
   (64 bytes each: a bit is the parity of the tokens dealt to it, so two bitmaps differ in no more
   bits than the sets in tokens), and what remains is verified exactly
   (``den * |x & y| > num * |x | y|``), so pairs travel with tokens only if they are likely similar.  A row with a kept similar row is
   dropped; a row whose earlier candidates were all compared and none is
   similar is kept.  The similarity graph is never materialised, so a dense
   cluster of near copies costs ``front^2`` plus its size in comparisons.
   Each round is written once to the shared checkpoint folder, and the one before removed.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tok
from ..session import Rounds, bound_batches
from .joins import maybe_among

RARITY_BUCKETS = 1 << 20  # of token counts: 8 MB
WORDS = 8  # 64-bit words of a set's bitmap


def _fraction(threshold: float) -> tuple[int, int]:
    f = Fraction(str(threshold))
    return f.numerator, f.denominator


def token_sets(df: DataFrame, order_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(order_col).alias("seq"),
                     F.array_distinct(tok(F.coalesce(F.col(text_col), F.lit("")))).alias("toks")) \
        .withColumn("n", F.size("toks"))


LAST_ROUNDS = 0  # rounds used by the last resolution (diagnostics)


def _rarity(reps: DataFrame) -> np.ndarray:
    """Number of sets that hold a token of each hash bucket."""
    rows = (reps.select(F.explode("toks").alias("t")).groupBy((F.xxhash64("t").bitwiseAND(RARITY_BUCKETS - 1)).alias("b"))
            .agg(F.count(F.lit(1)).alias("df")).toArrow())
    out = np.zeros(RARITY_BUCKETS, np.int64)
    out[rows.column("b").to_numpy()] = rows.column("df").to_numpy()
    return out


def set_marks(reps: DataFrame, num: int, den: int) -> DataFrame:
    """``(seq, n, prefix, s0 ..)`` of every set: its prefix tokens (rarest first) and its bitmap."""
    held = reps.sparkSession.sparkContext.broadcast(_rarity(reps))
    words = [f"s{i}" for i in range(WORDS)]

    def run(it):
        for batch in it:
            toks, h = (c.flatten() for c in batch.columns[2:4])
            h = h.to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            df = held.value[h & (RARITY_BUCKETS - 1)]
            order = np.lexsort((h, df, row))
            same = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
            if same.any():  # two tokens of a set with one hash: ordered by themselves
                order = pc.sort_indices(pa.table({"row": row, "df": df, "h": h, "t": toks}), sort_keys=[
                    (k, "ascending") for k in ("row", "df", "h", "t")]).to_numpy()
            first = np.cumsum(n) - n
            plen = n - (n * num + (den - 1)) // den + 1
            kept = order[np.arange(len(row)) - first[row] < plen[row]]
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.minimum(plen, n))]), pa.int32()),
                                              toks.take(pa.array(kept)))
            bit = (h >> 40) & (64 * WORDS - 1)
            odd = np.bincount(row * (64 * WORDS) + bit, minlength=len(n) * 64 * WORDS) & 1
            bits = np.packbits(odd.astype(np.uint8).reshape(len(n), -1), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prefix,
                                              *[pa.array(bits[:, i]) for i in range(WORDS)]],
                                             names=["seq", "n", "prefix", *words])

    src = reps.select("seq", F.col("n").cast("int").alias("n"), "toks", F.transform("toks", lambda t: F.xxhash64(t)).alias("h"))
    schema = reps.select("seq", F.col("n").cast("int").alias("n"), F.col("toks").alias("prefix")).schema
    for w in words:
        schema = schema.add(w, "long")
    return src.mapInArrow(run, schema)


def prefix_rows(reps: DataFrame, num: int, den: int) -> DataFrame:
    """``(seq, n, token)`` for the prefix tokens of every set (rarest first)."""
    return set_marks(reps, num, den).select("seq", "n", F.explode("prefix").alias("token"))


def resolve_front_rounds(reps: DataFrame, num: int, den: int, front: int = 256) -> DataFrame:
    """Ordered greedy resolution without materialising the similarity graph.

    Each round compares an undecided row ``b`` only with
    (1) rows kept in the previous round that share a prefix token with it
        (each kept row meets each later row once), and
    (2) the first ``front`` undecided rows, by order, of each of its prefix
        token groups (a partial window limit, so a hot token costs
        ``front`` rows per map task).
    ``b`` is dropped when a verified kept neighbour exists; it is kept when
    it is inside the front of every one of its prefix groups (so every
    earlier row that could be similar was compared) and none is similar;
    otherwise it waits.  The first undecided row is always decided, and a
    dense cluster of near copies costs ``front^2`` + cluster size
    comparisons instead of all its pairs.
    """
    UNDECIDED, KEPT, NEW_KEPT, DROPPED = 0, 1, 2, 3
    rounds = Rounds(reps.sparkSession, "neardup")
    bound_batches(reps.sparkSession)
    marks = rounds.save(set_marks(reps, num, den))
    pre = marks.select("seq", "n", F.explode("prefix").alias("token"))
    plen = marks.select("seq", F.size("prefix").alias("plen"))
    bits = [f"s{i}" for i in range(WORDS)]
    sets = reps.select("seq", "toks")
    status = rounds.save(reps.select("seq", F.lit(UNDECIDED).alias("st")))
    len_ok = ((F.col("nb") * den >= F.col("na") * num) & (F.col("na") * den >= F.col("nb") * num))
    global LAST_ROUNDS
    LAST_ROUNDS = 0
    while True:  # the first undecided row is decided in every round
        LAST_ROUNDS += 1
        # only undecided rows and rows kept in the previous round take part
        ps = pre.join(status.filter(F.col("st").isin(UNDECIDED, NEW_KEPT)), "seq")
        und = ps.filter(F.col("st") == UNDECIDED)
        fr = und.withColumn("_r", F.row_number().over(Window.partitionBy("token").orderBy("seq"))) \
            .filter(F.col("_r") <= front).select("seq", "n", "token")
        complete = fr.groupBy("seq").agg(F.count(F.lit(1)).alias("_in")).join(plen, "seq") \
            .select("seq", (F.col("_in") == F.col("plen")).alias("complete"))
        b_und = und.select(F.col("seq").alias("b"), F.col("n").alias("nb"), "token")
        a_new = ps.filter(F.col("st") == NEW_KEPT).select(F.col("seq").alias("a"), F.col("n").alias("na"), "token")
        a_fr = fr.select(F.col("seq").alias("a"), F.col("n").alias("na"), "token")
        b_fr = fr.select(F.col("seq").alias("b"), F.col("n").alias("nb"), "token")
        kept_pairs = a_new.join(b_und, "token").filter((F.col("a") < F.col("b")) & len_ok).select("a", "b", "na", "nb")
        front_pairs = a_fr.join(b_fr, "token").filter((F.col("a") < F.col("b")) & len_ok).select("a", "b", "na", "nb")
        cand = kept_pairs.unionByName(front_pairs).distinct()
        for side in ("a", "b"):
            cand = cand.join(marks.select(F.col("seq").alias(side), *[F.col(w).alias(side + w) for w in bits]), side)
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col("a" + w).bitwiseXOR(F.col("b" + w))) for w in bits])
        cand = rounds.save(cand.filter(apart * (den + num) < (F.col("na") + F.col("nb")) * (den - num)).select("a", "b"))
        ends = cand.select(F.explode(F.array("a", "b")).alias("seq"))
        near = sets.filter(maybe_among(reps.sparkSession, ends, "seq")(F.col("seq")))
        sa = near.select(F.col("seq").alias("a"), F.col("toks").alias("ta"))
        sb = near.select(F.col("seq").alias("b"), F.col("toks").alias("tb"))
        inter = F.size(F.array_intersect("ta", "tb"))
        union = F.size(F.array_union("ta", "tb"))
        sim = cand.join(sa, "a").join(sb, "b").filter(inter * den > union * num).select("a", "b")
        sim = rounds.save(sim.join(status.select(F.col("seq").alias("a"), F.col("st").alias("sa")), "a"))  # read twice
        nb = sim.groupBy(F.col("b").alias("seq")).agg(
            F.max(F.col("sa").isin(KEPT, NEW_KEPT).cast("int")).alias("has_kept"),
            F.max((F.col("sa") == UNDECIDED).cast("int")).alias("has_open"))
        st1 = rounds.save(status.join(nb, "seq", "left").join(complete, "seq", "left").select(
            "seq",
            F.when(F.col("st") == NEW_KEPT, F.lit(KEPT))
            .when(F.col("st") != UNDECIDED, F.col("st"))
            .when(F.coalesce(F.col("has_kept"), F.lit(0)) == 1, F.lit(DROPPED))
            .when(F.coalesce(F.col("complete"), F.lit(False)) & (F.coalesce(F.col("has_open"), F.lit(0)) == 0),
                  F.lit(NEW_KEPT))
            .otherwise(F.lit(UNDECIDED)).alias("st")))
        # same-round propagation: a row similar to a row kept in this round is
        # dropped now instead of one round later
        now_kept = st1.filter(F.col("st") == NEW_KEPT).select(F.col("seq").alias("a"))
        hit = sim.join(now_kept, "a").select(F.col("b").alias("seq")).distinct() \
            .withColumn("_hit", F.lit(True))
        last, status = status, rounds.save(st1.join(hit, "seq", "left").select(
            "seq", F.when(F.col("_hit") & (F.col("st") == UNDECIDED), F.lit(DROPPED))
            .otherwise(F.col("st")).alias("st")))
        rounds.drop(last, st1, sim, cand)
        if status.filter(F.col("st") == UNDECIDED).isEmpty():
            break
    return status.select("seq", F.col("st").isin(KEPT, NEW_KEPT).alias("kept"))


def near_dup_keep(df: DataFrame, order_col: str = "seq", text_col: str = "text",
                  threshold: float = 0.9, front: int = 256) -> DataFrame:
    """``(order_col, kept)`` for every row of ``df``."""
    num, den = _fraction(threshold)
    if num >= den:  # Jaccard never exceeds 1: nothing is a duplicate
        return df.select(order_col, F.lit(True).alias("kept"))
    rounds = Rounds(df.sparkSession, "neardup")

    def keyed(rows):
        digest = F.unhex(F.sha2(F.array_join(F.array_sort("toks"), "\u0001"), 256))
        return token_sets(rows, order_col, text_col).withColumn("_key", digest)
    every = rounds.save(keyed(df).select("seq", "n", "_key"))
    keys = every.filter((F.col("n") > 0) & F.col("seq").isNotNull()).select("_key", "seq")
    first = rounds.save(keys.groupBy("_key").agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
                        .filter("_rows > 1").select("_key", "_first"))
    # only rows that may have a copy are shuffled with their tokens
    copies = rounds.save(keys.join(first, "_key", "left_semi").select("seq"))
    copied = maybe_among(df.sparkSession, copies, "seq")(F.col(order_col))
    d = df.filter(F.col(order_col).isNotNull())
    moved = keyed(d.filter(copied)).filter("n > 0").join(first, "_key", "left")
    reps = rounds.save(token_sets(d.filter(~copied), order_col, text_col).filter("n > 0").unionByName(
        moved.filter("_first is null or _first = seq").dropDuplicates(["_key"]).select("seq", "toks", "n")))
    rounds.drop(copies)
    rep_status = resolve_front_rounds(reps, num, den, front)
    out = every.select("seq").join(rep_status, "seq", "left") \
        .join(every.filter(F.col("n") == 0).select("seq", F.lit(True).alias("_empty")), "seq", "left")
    kept = F.coalesce(F.col("_empty"), F.col("kept"), F.lit(False))
    return out.select(F.col("seq").alias(order_col), kept.alias("kept"))
