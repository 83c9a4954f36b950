"""Exact n-gram Jaccard self-join: T-occurrence search with DivideSkip.

1. ``shingle_sets``: each text's set of 4-word shingles as sorted 64-bit hashes.  Rows with the
   same set form one class, named by a 64-bit digest of the set.
2. Families: a pair with Jaccard >= t differs in at most d elements, d given by its sizes.
   The hash range is cut into d + 1 + s parts, so a linking pair agrees on s + 1 whole
   parts at least.  A set publishes all but its s smallest parts (by elements, then place): the largest part that a pair
   agrees on has s others of them below it in both sets, so both publish it.  Classes that publish an equal part are joined
   into a family; this loses no pair, and as a published part holds several elements, passages that sets share hardly
   ever join families, which would otherwise grow together as the input grows.
3. Families are cut into blocks and each pair of blocks is one search: an inverted index over one
   block, each set of the other as a query.  DivideSkip merges the short inverted lists, keeps
   sets that occur often enough there, and looks them up in the long lists by binary search.  Survivors are
   checked exactly in integers.  A search returns a spanning forest of its links, never all pairs.
4. Connected components over the classes.

Defined results: null or empty texts have an empty set and link with nothing; a text with fewer
words than the shingle has its whole sequence as its only shingle; equal sets link (Jaccard 1); repeated rows
each get a row and share a component; null ids get a row, and a component's id is its smallest non-null id.
Equality of shingles and of sets is equality of 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Workspace, batches, connected, maybe_among, mix64, span_hash, text_bytes, word_spans

NUM, DEN = 85, 100  # link when DEN * intersection >= NUM * union
WORDS = 4
SPARE = 4  # parts beyond those needed: one for so many of the elements that a linking pair may differ in
BLOCK = 2048  # classes of one block of a family
SIGN = np.uint64(1 << 63)


def _size_classes(limit: int) -> np.ndarray:
    """Smallest size of each class; linking sizes lie in the same or in neighbouring classes."""
    bounds = [1]
    while bounds[-1] <= limit:
        bounds.append(bounds[-1] * DEN // NUM + 1)
    return np.array(bounds + [bounds[-1] * DEN // NUM + 1])


BOUNDS = _size_classes(1 << 40)


def sets_of(column, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts of a column, and each text's offset."""
    data, off = text_bytes(column)
    starts, ends, counts = word_spans(data, off)
    h = span_hash(LOWER[data], starts, ends)
    ends_w = np.cumsum(counts)
    rows = len(counts)
    owner = np.repeat(np.arange(rows), counts)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    with np.errstate(over="ignore"):
        left = np.repeat(ends_w, counts) - np.arange(len(h))  # words from here to the text's end
        acc = np.zeros(len(h), np.uint64)
        for k in range(words):
            step = np.zeros(len(h), np.uint64)
            step[:len(h) - k] = h[k:]
            acc = np.where(left > k, mix64(acc + step + np.uint64(k + 1)), acc)
    first = np.zeros(len(h), bool)
    first[(ends_w - counts)[counts > 0]] = True
    use = (left >= words) | first  # a short text: one shingle, of all its words
    acc, owner = acc[use], owner[use]
    order = np.lexsort((acc, owner))
    acc, owner = acc[order], owner[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (owner[1:] != owner[:-1])
    acc, owner = acc[new], owner[new]
    return acc, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def digests(tokens: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit digest of each set (0 for an empty one)."""
    with np.errstate(over="ignore"):
        pre = np.concatenate([[np.uint64(0)], np.cumsum(mix64(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64)])
        n = np.diff(off).astype(np.uint64)
        return mix64(pre[off[1:]] - pre[off[:-1]] + n * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def parts_of(tokens: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the parts of each set, and the set that publishes each."""
    n = np.diff(off)
    out_sig, out_row = [], []
    high = (tokens >> np.uint64(32)).astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    cls = np.searchsorted(BOUNDS, n, side="right") - 1
    with np.errstate(over="ignore"):
        mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix64(tokens + np.uint64(77)), dtype=np.uint64)])
        for shift in (0, 1):  # as the larger set of a pair, and as the smaller one of the next class
            c = np.where(n > 0, cls + shift, 0)
            largest = BOUNDS[c + 1] - 1
            apart = 6 * largest // 37  # symmetric difference <= 3/37 of both sizes' sum, for 85/100
            spare = -(-apart // SPARE)
            parts = apart + 1 + spare
            slot = (high * parts[owner]) >> 32
            base = np.concatenate([[0], np.cumsum(np.where(n > 0, parts, 0))])
            place = base[:-1][owner] + slot
            count = np.bincount(place, minlength=base[-1])
            edge = np.concatenate([[0], np.cumsum(count)])
            row = np.repeat(np.arange(len(n)), np.where(n > 0, parts, 0))
            total = mixed[edge[1:]] - mixed[edge[:-1]]
            k = np.arange(len(row)) - base[:-1][row]
            sig = mix64(total + mix64((c[row].astype(np.uint64) << np.uint64(40)) + k.astype(np.uint64) + np.uint64(1)))
            order = np.argsort(row * (count.max(initial=0) + 1) + count, kind="stable")
            use = np.ones(len(row), bool)
            use[order[np.arange(len(row)) - base[:-1][row] < spare[row]]] = False  # ``row`` is sorted, before and after
            out_sig.append(sig[use])
            out_row.append(row[use])
    return np.concatenate(out_sig).astype(np.int64), np.concatenate(out_row)


def shingle_profile(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, n (set size) and cls (set digest, null for an empty set) of every row."""
    src = docs.select(*keep, F.col("text").alias("__text"))
    schema = src.drop("__text").schema.add("n", "long").add("cls", "long")

    def run(it):
        for batch in batches(it, "__text"):
            tokens, off = sets_of(batch.column(batch.schema.get_field_index("__text")))
            n = np.diff(off)
            cls = pa.array(digests(tokens, off), mask=n == 0)
            rest = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n), cls], names=[*keep, "n", "cls"])

    return src.mapInArrow(run, schema)


def _signatures(docs: DataFrame) -> DataFrame:
    """(sig, cls) rows; a class that a task meets again is published once."""
    def run(it):
        seen: set[int] = set()
        for batch in batches(it, "text", 2 << 20):
            tokens, off = sets_of(batch.column(0))
            cls = digests(tokens, off)
            fresh = np.zeros(len(cls), bool)
            for i, c in enumerate(cls.tolist()):
                if c not in seen:
                    seen.add(c)
                    fresh[i] = True
            sig, row = parts_of(tokens, off)
            use = fresh[row]
            yield pa.RecordBatch.from_arrays([pa.array(sig[use]), pa.array(cls[row[use]])], names=["sig", "cls"])

    return docs.select("text").mapInArrow(run, "sig long, cls long")


def _family_edges(it):
    """Rows sorted by sig -> (u, v): each class of a signature and the signature's smallest class."""
    tail_sig = tail_low = None
    for batch in it:
        sig, cls = batch.column(0).to_numpy(False), batch.column(1).to_numpy(False)
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        low = cls[new][np.cumsum(new) - 1]  # rows come sorted by (sig, cls)
        if tail_sig == sig[0]:
            low[np.cumsum(new) == 1] = tail_low
        tail_sig, tail_low = sig[-1], low[-1]
        use = low != cls
        pairs = np.unique(np.stack([cls[use], low[use]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])


def divide_skip(query: np.ndarray, need: int, tokens: np.ndarray, bounds: np.ndarray, lists: np.ndarray,
                n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of the index sharing at least ``need`` tokens with ``query``, and how many.

    ``tokens``: the index' distinct tokens, sorted; the list of token i is
    ``lists[bounds[i]:bounds[i + 1]]``, sorted.
    """
    at = np.searchsorted(tokens, query)
    at = at[at < len(tokens)][tokens[at[at < len(tokens)]] == query[at < len(tokens)]]
    if len(at) < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = bounds[at + 1] - bounds[at]
    at = at[np.argsort(-size, kind="stable")]
    size = bounds[at + 1] - bounds[at]
    n_long = min(need - 1, int(need / (0.0085 * np.log2(max(2, int(size[0]))) + 1) / 4))
    if size[0] <= 4:
        n_long = 0
    short = at[n_long:]
    lens = size[n_long:]
    # the short lists are merged by counting, all of them at once
    idx = np.repeat(bounds[short] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
    seen = np.bincount(lists[idx], minlength=n_docs)
    cand = np.flatnonzero(seen >= need - n_long)
    count = seen[cand]
    for i in range(n_long):  # binary search of the candidates in each long list
        if not len(cand):
            break
        part = lists[bounds[at[i]]:bounds[at[i] + 1]]
        spot = np.minimum(np.searchsorted(part, cand), len(part) - 1)
        count = count + (part[spot] == cand)
        ok = count >= need - (n_long - 1 - i)
        cand, count = cand[ok], count[ok]
    return cand, count


def search_blocks(left: list[np.ndarray], right: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right``.

    Positions count through left, then right.
    """
    index = left if right is None else right
    shift = 0 if right is None else len(left)
    sizes = np.array([len(x) for x in index])
    flat = np.concatenate(index)
    doc = np.repeat(np.arange(len(index)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, doc = flat[order], doc[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    bounds = np.concatenate([np.flatnonzero(new), [len(flat)]])
    tokens = flat[new]
    parent = list(range(len(left) + (0 if right is None else len(right))))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for q, query in enumerate(left):
        n = len(query)
        least = -(-NUM * n // DEN)  # no partner is smaller, and overlap >= NUM/(NUM+DEN) of both sizes
        need = -(-NUM * (n + least) // (NUM + DEN))
        cand, count = divide_skip(query, need, tokens, bounds, doc, len(index))
        ok = DEN * count >= NUM * (n + sizes[cand] - count)
        for c in cand[ok].tolist():
            a, b = root(q), root(c + shift)
            if a != b:
                parent[b] = a
                links.append((q, c + shift))
    return links


def _search(it):
    """Rows (family, i, j, block, cls, tokens) sorted by (family, i, j) -> links (u, v)."""
    def solve(rows, i, j):
        seen, sides = set(), ([], [])
        for block, cls, tokens in rows:
            if cls not in seen:
                seen.add(cls)
                sides[0 if block == i else 1].append((cls, np.frombuffer(tokens, np.uint64)))
        a, b = sides
        if not a or (i != j and not b) or len(a) + len(b) < 2:
            return []
        names = [x[0] for x in a + b]
        got = search_blocks([x[1] for x in a], [x[1] for x in b] if i != j else None)
        return [(names[p], names[q]) for p, q in got]

    key, rows = None, []
    for batch in it:
        out = []
        fam, i, j, block, cls = (batch.column(k).to_pylist() for k in range(5))
        tokens = batch.column(5)
        for r in range(batch.num_rows):
            now = (fam[r], i[r], j[r])
            if now != key:
                out += solve(rows, *key[1:]) if rows else []
                key, rows = now, []
            rows.append((block[r], cls[r], tokens[r].as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                          pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])
    out = solve(rows, *key[1:]) if rows else []
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                      pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])


def _token_rows(docs: DataFrame) -> DataFrame:
    def run(it):
        for batch in batches(it, "text"):
            tokens, off = sets_of(batch.column(0))
            cls = digests(tokens, off)
            raw = [tokens[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
            some = np.diff(off) > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[some]), pa.array([r for r in raw if r], pa.binary())], names=["cls", "tokens"])

    return docs.select("text").mapInArrow(run, "cls long, tokens binary")


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id, component for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id, which two components may share (null or repeated ids);
    ``component`` is a set digest and names one component only.
    """
    ws = Workspace(spark, "ngram_join")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "text")
    profile = ws.save(shingle_profile(docs, ["doc_id"]), "profile")
    edges = (_signatures(docs).repartition(parts, "sig").sortWithinPartitions("sig", "cls")
             .mapInArrow(_family_edges, "u long, v long"))
    family = ws.save(connected(spark, ws, edges), "family")
    sizes = ws.save(family.groupBy("component").agg(F.count("*").alias("g")), "sizes")
    family = family.join(sizes, "component")

    # one row of each class in a family brings its text
    first = (profile.join(family.select(F.col("id").alias("cls")), "cls", "left_semi")
             .groupBy("cls").agg(F.min("doc_id").alias("doc_id")))
    # the few other rows that pass are of a class that is there already, or of none
    rep = docs.filter(maybe_among(spark, ws.save(first.select("doc_id"), "first"), "doc_id")(F.col("doc_id")))
    tiles = (_token_rows(rep).join(family.select(F.col("id").alias("cls"), "component", "g"), "cls")
             .withColumn("nb", F.ceil(F.col("g") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "cls", "tokens"))
    links = (tiles.repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j")
             .mapInArrow(_search, "u long, v long"))
    comps = ws.save(connected(spark, ws, links), "components")

    classes = ws.save(profile.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low"))
                      .join(comps.withColumnRenamed("id", "cls"), "cls", "left")
                      .withColumn("component", F.coalesce("component", "cls")), "classes")
    lows = ws.save(classes.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    named = ws.save(classes.join(lows, "component").select("cls", "component_id", "component"), "named")
    return (profile.join(named, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id"), F.col("cls").alias("set_id"), "component"))
