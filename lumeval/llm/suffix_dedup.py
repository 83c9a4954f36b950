"""Removal of repeated 200-byte strings by threshold-bounded interval expansion on a BWT.

A byte goes when a 200-byte string that covers it also starts anywhere else, in the same or in
another text; strings are judged on the input.  Every text is UTF-8 bytes, matches never cross texts.

1. Every 200-byte window has an anchor, the smallest hash of its 32-byte substrings.  A run
   of windows with the same anchor is a piece; equal windows have equal anchors, so all starts
   of a string lie in pieces of one anchor, and every start lies in exactly one piece.
2. Equal pieces are counted before the shuffle; anchors met once are done.  The text of each remaining
   distinct piece is fetched once and dealt by anchor.
3. In a task, ``repeated_starts`` sorts the suffixes of the pieces, forms the Burrows-Wheeler transform
   and expands intervals breadth first by backward extension: level l sets all common
   prefixes of length l.  It stops at the minimum length, so what is still unset is an interval of
   suffixes that share 200 bytes; it is repeated if its pieces occur at least twice in all.
4. An anchor with very many distinct pieces (the rim of a frequent passage) is not one group:
   its pieces are cut into runs of 8 starts, dealt by the bytes that all 8 windows share, and, where that is still
   too many, into single windows.  The same search runs on these groups.

Defined results: null and empty texts give n_bytes 0 and the digest of nothing; texts under 200 bytes
lose nothing unless nothing is what they have; repeated rows are copies of each other and lose every window;
ids may be null or repeat, each row gets a row; other columns are never read.  Equality of anchors and
pieces is equality of 64-bit hashes each, taken together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, Workspace, batches, mix64, span_hash, text_bytes

LENGTH = 200
GRAM = 32
GROUP_PIECES = 8192  # distinct pieces of one anchor that may meet in one group
CHUNK_BYTES = 1 << 20
RUN = 8


def _sliding(a: np.ndarray, w: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of every ``w`` consecutive values."""
    k = 1
    while 2 * k <= w:
        a = take(a[:-k], a[k:])
        k *= 2
    return take(a[:len(a) - (w - k)], a[w - k:]) if w > k else a


def anchors(h: np.ndarray) -> np.ndarray:
    """Smallest of the substring hashes ``h`` in each window of one text."""
    return _sliding(h, LENGTH - GRAM + 1, np.minimum)


def _met_again(h: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Anchors that stand at two near places of one text, so that a piece may repeat a window itself."""
    w = LENGTH - GRAM + 1
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([pad, a, pad]), w, np.maximum) == h)
    return h[at[1:]][h[at[1:]] == h[at[:-1]]]


def pieces_of(data: np.ndarray, off: np.ndarray):
    """(row, start, end, anchor, met) of the pieces of all texts; windows start at start .. end - LENGTH.

    ``met`` is 2 where the piece may hold a window twice, else 1.
    """
    rows, starts, ends, keys, met = [], [], [], [], []
    for r in np.flatnonzero(np.diff(off) >= LENGTH):
        h = _gram_hashes(data[off[r]:off[r + 1]])
        a = anchors(h)
        cut = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
        rows.append(np.full(len(cut), r))
        starts.append(cut)
        ends.append(np.concatenate([cut[1:], [len(a)]]) + LENGTH - 1)
        keys.append(a[cut])
        twice = _met_again(h, a)
        met.append(1 + np.isin(a[cut], twice) if len(twice) else np.ones(len(cut), np.int64))
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), z
    return tuple(np.concatenate(x) for x in (rows, starts, ends, keys, met))


def suffix_classes(text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (cyclic) sorted by their first ``width`` or more symbols, and each one's class."""
    n = len(text)
    wide = np.concatenate([text, text[:8] if n >= 8 else np.resize(text, 8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(7):  # seven symbols of up to nine bits
        key = (key << np.uint64(9)) | wide[i:i + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    del key, sorted_key, wide
    order, start = order.astype(np.int32), start.astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = start
    have = 7
    while have < width:
        tied = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))  # only classes of several suffixes
        if not len(tied):
            break
        who = order[tied]
        two = rank[(who + have) % n]
        key = start[tied].astype(np.int64) * n + two
        by = np.argsort(key, kind="stable")
        order[tied] = who[by]
        key = key[by]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] = fresh
        start = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        rank[order] = start
        have *= 2
    return order, rank


def repeated_starts(pieces: list[np.ndarray], weights: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, which of its windows occur at least twice, a piece counting ``weight`` times."""
    sizes = np.array([len(p) for p in pieces])
    off = np.concatenate([[0], np.cumsum(sizes + 1)])
    n = int(off[-1])
    text = np.zeros(n, np.int16)  # 0 separates the pieces
    for p, o in zip(pieces, off):
        text[o:o + len(p)] = p
        text[o:o + len(p)] += 1
    order, rank = suffix_classes(text, length + 1)
    last = np.ones(n, bool)  # last position of each class of suffixes
    in_order = rank[order]
    last[:-1] = in_order[1:] != in_order[:-1]
    class_end = np.minimum.accumulate(np.where(last, np.arange(n, dtype=np.int32), n)[::-1])[::-1]
    before = order - 1  # cyclic
    bwt = text[before]
    to_first = rank[before]          # LF: start of the class of the preceding suffix
    to_last = class_end[to_first]
    by = np.argsort(bwt, kind="stable").astype(np.int32)
    following = np.full(n, n, np.int32)
    same = bwt[by[1:]] == bwt[by[:-1]]
    following[by[:-1][same]] = by[1:][same]
    preceding = np.full(n, -1, np.int32)
    preceding[by[1:][same]] = by[:-1][same]
    defined = np.zeros(n + 1, bool)  # boundary between suffixes i - 1 and i: a common prefix below ``length``
    defined[0] = defined[n] = True
    low, high = np.array([0]), np.array([n - 1])
    for level in range(length):
        if not len(low):
            break
        span = high - low + 1
        base = np.cumsum(span) - span
        pos = np.repeat(low - base, span) + np.arange(int(span.sum()))
        ends_here = following[pos] > np.repeat(high, span)
        starts_here = preceding[pos] < np.repeat(low, span)
        if level:  # strings that go on beyond a separator are no windows
            real = bwt[pos] > 0
            ends_here &= real
            starts_here &= real
        hi = np.sort(to_last[pos[ends_here]])
        lo = np.sort(to_first[pos[starts_here]])
        fresh = ~defined[hi + 1]
        defined[hi + 1] = True
        low, high = lo[fresh], hi[fresh]
    group = np.cumsum(defined[:n]) - 1
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    inside = np.arange(n) - off[:-1][owner] <= (sizes - length)[owner]  # a whole window starts here
    weight = np.where(inside, weights[owner], 0)[order]
    total = np.bincount(group, weight)
    hit = np.zeros(n, bool)
    hit[order] = (total >= 2)[group]
    hit &= inside
    return [hit[o:o + max(0, s - length + 1)] for o, s in zip(off, sizes)]


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of set positions."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _piece_rows(docs: DataFrame) -> DataFrame:
    """(anchor, dig, tkey, start, size, met): the pieces of every row."""
    def run(it):
        for batch in batches(it, "text", 2 << 20):
            data, off = text_bytes(batch.column(1))
            row, start, end, key, met = pieces_of(data, off)
            dig = span_hash(data, off[row] + start, off[row] + end).astype(np.int64)
            key, tkey = key.astype(np.int64), batch.column(0).to_numpy(False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(dig), pa.array(tkey), pa.array(start.astype(np.int32)),
                 pa.array((end - start).astype(np.int32)), pa.array(met.astype(np.int8))],
                names=["anchor", "dig", "tkey", "start", "size", "met"])

    return docs.select("tkey", "text").mapInArrow(run, "anchor long, dig long, tkey long, start int, size int, met byte")


def _zip(df: DataFrame) -> DataFrame:
    @F.pandas_udf("binary")
    def pack(s: pd.Series) -> pd.Series:
        z = zstandard.ZstdCompressor(level=1)
        return s.map(lambda t: z.compress(t.encode("utf-8", "surrogatepass")) if t else None)
    return df.withColumn("z", pack(F.col("text"))).drop("text")


def _fetch(it):
    """Texts with the pieces wanted from them -> (anchor, dig, n, many, bytes)."""
    unzip = zstandard.ZstdDecompressor()
    for batch in it:
        out = [[], [], [], [], []]
        for z, want in zip(batch.column(0), batch.column(1)):
            text = unzip.decompress(z.as_py())
            for w in want.as_py():
                for k, v in enumerate((w["anchor"], w["dig"], w["n"], w["many"],
                                       text[w["start"]:w["start"] + w["size"]])):
                    out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.bool_()), pa.array(out[4], pa.binary())],
            names=["anchor", "dig", "n", "many", "bytes"])


def _expand(it):
    """Rows (anchor, dig, n, bytes) sorted by anchor -> (anchor, dig, a, b): runs of repeated starts."""
    names = ["anchor", "dig", "a", "b"]

    def solve(rows):
        out = [[], [], [], []]
        seen, uniq = set(), []
        for r in rows:  # a text fetched twice brings its pieces twice
            if (r[0], r[1]) not in seen:
                seen.add((r[0], r[1]))
                uniq.append(r)
        hits = repeated_starts([np.frombuffer(r[3], np.uint8) for r in uniq], np.array([r[2] for r in uniq]))
        for r, hit in zip(uniq, hits):
            for a, b in runs_of(hit):
                for k, v in enumerate((r[0], r[1], a, b)):
                    out[k].append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                           pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=names)

    rows, size, last = [], 0, None
    for batch in it:
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for r in zip(*cols):
            if size >= CHUNK_BYTES and r[0] != last:
                yield solve(rows)
                rows, size = [], 0
            rows.append(r)
            size += len(r[3]) + 1
            last = r[0]
    if rows:
        yield solve(rows)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each GRAM-byte substring."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint64) + np.uint64(1)
        p, k = int(BASE), 1
        while k < GRAM:
            h = h[:-k] * np.uint64(p) + h[k:]
            p, k = p * p % (1 << 64), 2 * k
        return mix64(h)


def cut_piece(raw: bytes, width: int):
    """Runs of at most ``width`` windows of a piece: (place, group key, digest, bytes).

    A window's distance to its anchor, divided by ``width``, and the bytes that all windows of that
    class share form the key, so equal windows of different pieces meet under one key.
    """
    h = _gram_hashes(np.frombuffer(raw, np.uint8))
    windows, span = len(raw) - LENGTH + 1, LENGTH - GRAM + 1
    s = 0
    while s < windows:
        at = s + int(np.argmin(h[s:s + span]))  # the leftmost smallest hash of this window
        dist = at - s
        near = dist // width * width  # distances near .. near + width - 1 form a class
        e = s + 1
        while e < windows and e <= at - near and at == e + int(np.argmin(h[e:e + span])):
            e += 1
        core = raw[at - near:at - near - width + 1 + LENGTH]
        piece = raw[s:e - 1 + LENGTH]
        key = hashlib.blake2b(core + near.to_bytes(4, "little"), digest_size=8).digest()
        dig = hashlib.blake2b(piece + dist.to_bytes(4, "little"), digest_size=8).digest()
        yield s, int.from_bytes(key, "little", signed=True), int.from_bytes(dig, "little", signed=True), piece
        s = e


def _cut(width: int):
    """Rows (n, bytes, up_anchor, up_dig, place) -> runs (anchor, dig, n, bytes, up_anchor, up_dig, place)."""
    def run(it):
        for batch in it:
            out = [[], [], [], [], [], [], []]
            for n, raw, ua, ud, place in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for at, key, dig, piece in cut_piece(raw, width):
                    for c, v in enumerate((key, dig, n, piece, ua, ud, place + at)):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.binary()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.int64()),
                 pa.array(out[6], pa.int32())],
                names=["anchor", "dig", "n", "bytes", "up_anchor", "up_dig", "place"])
    return run


RUNS = "anchor long, dig long, n long, bytes binary, up_anchor long, up_dig long, place int"


def _search(df: DataFrame, parts: int) -> DataFrame:
    return (df.select("anchor", "dig", "n", "bytes").repartition(parts, "anchor").sortWithinPartitions("anchor")
            .mapInArrow(_expand, "anchor long, dig long, a int, b int"))


def _groups(df: DataFrame) -> DataFrame:
    """Distinct pieces with the number of times that they occur."""
    return df.groupBy("anchor", "dig").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes"))


def _repeats(ws: Workspace, pieces: DataFrame, parts: int) -> DataFrame:
    """(anchor, dig, a, b): runs of repeated starts of the distinct pieces (anchor, dig, n, many, bytes)."""
    found = _search(pieces.filter("not many"), parts)
    hot = pieces.filter("many")
    if hot.isEmpty():
        return ws.save(found, "found")
    sub = ws.save(hot.select("n", "bytes", F.col("anchor").alias("up_anchor"), F.col("dig").alias("up_dig"),
                             F.lit(0).alias("place")).mapInArrow(_cut(RUN), RUNS), "cut_1")
    one = ws.save(_groups(sub), "groups_1")
    stats = ws.save(one.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("m")).filter("total > 1"),
                    "stats_1")
    cold = one.join(stats.filter(F.col("m") <= GROUP_PIECES), "anchor")
    first = _search(cold, parts).join(sub.select("anchor", "dig", "up_anchor", "up_dig", "place"), ["anchor", "dig"])
    # still too many at one place: single windows, which are counted like words
    rest = (sub.join(stats.filter(F.col("m") > GROUP_PIECES).select("anchor"), "anchor", "left_semi")
            .select("n", "bytes", "up_anchor", "up_dig", "place").mapInArrow(_cut(1), RUNS))
    rest = ws.save(rest, "cut_2")
    single = ws.save(_groups(rest).filter("n > 1"), "groups_2")
    second = _search(single, parts).join(rest.select("anchor", "dig", "up_anchor", "up_dig", "place"),
                                         ["anchor", "dig"])
    deeper = first.unionByName(second).select(
        F.col("up_anchor").alias("anchor"), F.col("up_dig").alias("dig"),
        (F.col("place") + F.col("a")).alias("a"), (F.col("place") + F.col("b")).alias("b"))
    out = ws.save(found.unionByName(deeper), "found")
    ws.drop("cut_1", "groups_1", "stats_1", "cut_2", "groups_2")
    return out


def _strip(keep: list[str], with_text: bool):
    """Rows (keep.., z, ranges) -> counts and digest of the kept bytes, or the kept text."""
    def run(it):
        unzip = zstandard.ZstdDecompressor()
        for batch in it:
            n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
            zs = batch.column(batch.schema.get_field_index("z"))
            ranges = batch.column(batch.schema.get_field_index("ranges"))
            for z, spans in zip(zs, ranges):
                raw = unzip.decompress(z.as_py()) if z.is_valid else b""
                gone = 0
                count = 0
                rest = raw
                if spans.is_valid:
                    edge = np.zeros(len(raw) + 1, np.int64)
                    for x in spans.as_py():
                        edge[x["s"]] += 1
                        edge[x["e"]] -= 1
                    mask = np.cumsum(edge)[:-1] > 0
                    gone, count = int(mask.sum()), len(runs_of(mask))
                    rest = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                n_bytes.append(len(raw))
                n_removed.append(gone)
                n_spans.append(count)
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:  # a cut inside a character drops the torn character's rest
                    kept.append(rest.decode("utf-8", "ignore") if z.is_valid else None)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            cols += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                     pa.array(sha, pa.string())]
            names = [*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array(kept, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, keep: list[str] = ("doc_id",),
                   with_text: bool = False) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text) of every row of ``docs``."""
    ws = Workspace(spark, "suffix_dedup")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = [c for c in keep if c != "text"]
    keyed = docs.select(*keep, F.col("text"), F.xxhash64("text").alias("tkey")).withColumn(
        "rkey", F.xxhash64("doc_id", "tkey") if "doc_id" in keep else F.col("tkey"))
    pieces = ws.save(_piece_rows(keyed), "pieces")
    met = ws.save(pieces.groupBy("anchor").agg(F.sum("met").alias("met")).filter("met > 1").select("anchor"), "met")
    shared = ws.save(pieces.drop("met").join(met, "anchor"), "shared")
    ws.drop("pieces", "met")
    distinct = ws.save(shared.groupBy("anchor", "dig").agg(
        F.count("*").alias("n"), F.first("tkey").alias("tkey"), F.first("start").alias("start"),
        F.first("size").alias("size")), "distinct")
    many = ws.save(distinct.groupBy("anchor").agg((F.count("*") > GROUP_PIECES).alias("many")), "many")
    want = (distinct.join(many, "anchor").groupBy("tkey")
            .agg(F.collect_list(F.struct("anchor", "dig", "n", "many", "start", "size")).alias("want")))
    first = keyed.groupBy("tkey").agg(F.min("rkey").alias("rkey"))
    want = ws.save(want.join(first, "tkey").select("rkey", "want"), "want")
    texts = _zip(keyed.select("rkey", "text")).join(want, "rkey").select("z", "want")
    fetched = ws.save(texts.mapInArrow(_fetch, "anchor long, dig long, n long, many boolean, bytes binary"), "fetched")
    ws.drop("want", "many", "distinct")
    found = _repeats(ws, fetched, parts)
    ws.drop("fetched")
    spans = (shared.join(found, ["anchor", "dig"])
             .select("tkey", (F.col("start") + F.col("a")).alias("s"),
                     (F.col("start") + F.col("b") - 1 + LENGTH).alias("e")).distinct())
    ranges = ws.save(spans.groupBy("tkey").agg(F.collect_list(F.struct("s", "e")).alias("ranges")), "ranges")
    ws.drop("shared", "found")
    rows = _zip(keyed.select(*keep, "tkey", "text")).join(ranges, "tkey", "left").select(*keep, "z", "ranges")
    schema = rows.select(*keep).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    if with_text:
        schema = schema.add("kept_text", "string")
    return rows.mapInArrow(_strip(keep, with_text), schema)
