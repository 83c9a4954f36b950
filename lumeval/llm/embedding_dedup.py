"""Near-duplicate vectors of a label: int8 tile products with rigorous error bounds.

Equal vectors of a label are one class, counted before any shuffle of pairs.  The classes of a label are cut into
blocks; a task holds two blocks as int8 vectors with a scale and the exact norm of each one's
quantisation error.  The tile product plus the error bound rules pairs out; only pairs that may
reach the threshold are computed again in double precision.  A tile returns, per class, the
number of its links and a spanning forest, never all pairs.

Defined results: a vector that is null, empty, zero, holds null or non-finite components, or has no label links with
nothing and is its own component; vectors of different lengths never link; repeated rows are
copies that link; rows with a null id count as links but name no component; other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, connected

THRESHOLD = 0.98
BLOCK = 1024
SLACK = 1e-9  # covers the rounding of the bounds themselves


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, and the norm of the error of each unit vector."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q, scale, error


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) with a cosine of at least ``threshold``; both double precision."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa, sa, ea = quantise(a / na[:, None])
    qb, sb, eb = quantise(b / nb[:, None])
    dims = a.shape[1]
    product = np.zeros((len(a), len(b)))
    for d in range(0, dims, 1024):  # sums below 2^24: the float product of int8 values is exact
        product += qa[:, d:d + 1024].astype(np.float32) @ qb[:, d:d + 1024].astype(np.float32).T
    # u.v = u~.v~ + u~.ev + eu.v~ + eu.ev, and |u~| <= 1 + |eu|
    bound = ((1 + ea)[:, None] * eb[None, :] + ea[:, None] * (1 + eb)[None, :] + ea[:, None] * eb[None, :])
    i, j = np.nonzero(product * sa[:, None] * sb[None, :] + bound + SLACK >= threshold)
    out_i, out_j = [], []
    for k in range(0, len(i), 65536):
        x, y = i[k:k + 65536], j[k:k + 65536]
        exact = np.einsum("nd,nd->n", a[x], b[y]) / (na[x] * nb[y])
        ok = exact >= threshold
        out_i.append(x[ok])
        out_j.append(y[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (none, none)


def vector_rows(batch: pa.RecordBatch, column: str) -> list[np.ndarray | None]:
    """Double vectors; None for a null or empty one and for null or non-finite components."""
    out = []
    for v in batch.column(batch.schema.get_field_index(column)):
        if not v.is_valid or not len(v.values) or v.values.null_count:
            out.append(None)
            continue
        x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        out.append(x if np.isfinite(x).all() else None)
    return out


def _profile(it):
    """(vec_id, label, embedding) -> (vec_id, label, cls, raw): class digest and bytes of valid vectors."""
    for batch in it:
        labels = batch.column(1).to_pylist()
        cls, raw = [], []
        for label, v in zip(labels, vector_rows(batch, "embedding")):
            if label is None or v is None or not v.any():
                cls.append(None)
                raw.append(None)
                continue
            # an exact power of two brings the largest component near 1: no square overflows, and the cosine stays
            b = np.ldexp(v, -np.frexp(np.abs(v).max())[1]).tobytes()
            digest = hashlib.blake2b(b + str(label).encode(), digest_size=8).digest()
            cls.append(int.from_bytes(digest, "little", signed=True))
            raw.append(b)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if x is None else str(x) for x in labels], pa.string()),
             pa.array(cls, pa.int64()), pa.array(raw, pa.binary())], names=["vec_id", "label", "cls", "raw"])


def _tiles(threshold: float):
    """Rows (key, i, j, block, cls, n, raw) sorted by (key, i, j) -> (node, other, links)."""
    def solve(rows, i, j):
        out = [[], [], []]
        left = [r for r in rows if r[0] == i]
        right = [r for r in rows if r[0] == j] if i != j else left
        if not left or not right:
            return out
        a = np.stack([np.frombuffer(r[3]) for r in left])
        b = a if i == j else np.stack([np.frombuffer(r[3]) for r in right])
        x, y = tile_links(a, b, threshold)
        if i == j:
            x, y = x[x != y], y[x != y]
        count_b = np.bincount(x, np.array([r[2] for r in right])[y], len(left)).astype(np.int64)
        for r, c in zip(left, count_b.tolist()):
            if c:
                out[0].append(r[1]), out[1].append(None), out[2].append(c)
        if i != j:
            count_a = np.bincount(y, np.array([r[2] for r in left])[x], len(right)).astype(np.int64)
            for r, c in zip(right, count_a.tolist()):
                if c:
                    out[0].append(r[1]), out[1].append(None), out[2].append(c)
        parent = {}

        def root(v):
            while parent.get(v, v) != v:
                parent[v] = v = parent.get(parent[v], parent[v])
            return v
        for p, q in zip(x.tolist(), y.tolist()):
            u, v = left[p][1], right[q][1]
            s, t = root(u), root(v)
            if s != t:
                parent[t] = s
                out[0].append(u), out[1].append(v), out[2].append(0)
        return out

    def run(it):
        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["node", "other", "links"])
        key, rows = None, []
        for batch in it:
            cols = [batch.column(i).to_pylist() for i in range(7)]
            for r in zip(*cols):
                if r[:3] != key:
                    if rows:
                        yield batch_of(solve(rows, *key[1:]))
                    key, rows = r[:3], []
                rows.append(r[3:])
        if rows:
            yield batch_of(solve(rows, *key[1:]))
    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, label, embedding)."""
    ws = Workspace(spark, "embedding_dedup")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = vectors.select("vec_id", "label", "embedding")
    schema = src.select("vec_id").schema.add("label", "string").add("cls", "long").add("raw", "binary")
    profile = ws.save(src.mapInArrow(_profile, schema), "profile")
    classes = ws.save(profile.filter("cls is not null").withColumn("key", F.concat_ws("\u0001", F.octet_length("raw"), "label"))
                      .groupBy("key", "cls", "raw").agg(F.count("*").alias("n"), F.min("vec_id").alias("low")), "classes")
    sizes = ws.save(classes.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb")), "sizes")
    tiles = (classes.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "cls", "n", "raw"))
    found = ws.save(tiles.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
                    .mapInArrow(_tiles(threshold), "node long, other long, links long"), "found")
    links = found.filter("other is null").groupBy(F.col("node").alias("cls")).agg(F.sum("links").alias("links"))
    edges = ws.save(found.filter("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")), "edges")
    comps = ws.save(connected(spark, ws, edges).withColumnRenamed("id", "cls"), "components")
    named = ws.save(classes.select("cls", "n", "low").join(links, "cls", "left").join(comps, "cls", "left")
                    .withColumn("component", F.coalesce("component", "cls")), "named")
    lows = ws.save(named.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    final = ws.save(named.join(lows, "component").select(
        "cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "final")
    out = profile.select("vec_id", "cls").join(final, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", F.when(F.col("cls").isNull(), F.col("vec_id"))).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
