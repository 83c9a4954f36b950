"""Helpers shared by the operators: written intermediate tables, connected
components, and NumPy word hashing on Arrow batches."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import maybe_among  # noqa: F401 - for the operators here
from ..session import WRITE_CONF, bound_batches, conf_set, shared_dir

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
RUN = 1 << 20    # edges that a task contracts at a time
EDGES = 1 << 13  # edges of a partition, while there are fewer than shuffle partitions


class Workspace:
    """Tables written to the shared folder of one operator call.

    ``save`` cuts the lineage with a Parquet table in ``spark.checkpoint.dir``,
    so a lost executor never recomputes earlier steps; ``drop`` removes a table
    that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        bound_batches(spark)
        self.root = f"{shared_dir(spark, name)}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, conf: dict[str, str] | None = None) -> DataFrame:
        """``conf``: further settings for this table's query."""
        path = f"{self.root}/{name}"
        with conf_set(self.spark, WRITE_CONF | (conf or {})):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_bucket(col, n: int = 5):
    """crc32 of the id as text modulo n; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def shards_for(df: DataFrame, col: str, shard_bytes: int) -> int:
    """Number of shards so that one holds about ``shard_bytes`` of text."""
    total = df.agg(F.sum(F.octet_length(col).cast("long"))).first()[0] or 0
    return max(1, -(-int(total) // shard_bytes))


def shard_of(n: int, *cols):
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the ids that the edges (u, v) join: all but the smallest of each component, and that smallest id."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    up = np.arange(len(nodes))
    while len(a):
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up[up] != up).any():
            up = up[up]
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    low = up != np.arange(len(nodes))
    return nodes[low], nodes[up[low]]


def _contract(it):
    """Edges (u, v) -> (u, v): u an id, v the smallest that it reaches by the edges at hand, RUN at a time."""
    def give(held):
        u, v = smallest_reached(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    held, n = [], 0
    for batch in it:
        held.append((batch.column(0).to_numpy(False), batch.column(1).to_numpy(False)))
        n += batch.num_rows
        if n >= RUN:
            yield give(held)
            held, n = [], 0
    if n:
        yield give(held)


def connected(spark: SparkSession, ws: Workspace, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v), long: rows (id, component), component
    being the smallest id reachable; ids without an edge have no row.

    Each task replaces its edges by (id, smallest id reached by them).  A round points every edge at the parent of its
    smaller end (the smallest id that end points to), deals the edges by their larger end and contracts them again,
    so that depths halve and trees that share an id merge.  An id is the larger end of a few edges at
    most, one of each task, so no hub lands in one task; the join on the smaller ends is a plain shuffled
    one, so adaptive execution splits hubs.  Tables are dealt into partitions by their number of
    edges.  Rounds end when each id has one parent and no parent changed: then all parents are smallest ids.
    """
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def spread(df, n):
        return df.repartition(max(1, min(most, -(-n // EDGES))), "u")

    cur = ws.save(edges.filter("u <> v").select("u", "v").mapInArrow(_contract, "u long, v long"), "cc_0")
    n, i, mark = cur.count(), 0, None
    while True:
        up = ws.save(spread(cur, n).groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")), f"cc_up_{i}")
        *now, several = up.agg(F.count("*"), F.sum(F.xxhash64("u", "m").cast("decimal(38,0)")),
                               F.coalesce(F.sum((F.col("m") < F.col("x")).cast("long")), F.lit(0))).first()
        if not several and (now == mark or not now[0]):
            break
        jumped = (cur.join(up.select(F.col("u").alias("v"), "m"), "v", "left")
                  .select("u", F.coalesce("m", "v").alias("v")))
        nxt = ws.save(spread(jumped, n).mapInArrow(_contract, "u long, v long"), f"cc_{i + 1}")
        ws.drop(f"cc_{i}", f"cc_up_{i}")
        cur, mark, i = nxt, now, i + 1
    ws.drop(f"cc_{i}")
    stars = up.select(F.col("u").alias("id"), F.col("m").alias("component"))
    return stars.unionByName(up.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct())


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """B^i and B^-i modulo 2^64, grown on demand."""

    def __init__(self):
        self.p = np.ones(1, np.uint64)
        self.q = np.ones(1, np.uint64)
        self.inv = np.uint64(pow(int(BASE), -1, 1 << 64))

    def upto(self, n):
        if len(self.p) < n:
            with np.errstate(over="ignore"):
                self.p = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE, np.uint64)]), dtype=np.uint64)
                self.q = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.inv, np.uint64)]),
                                    dtype=np.uint64)
        return self.p, self.q


POWERS = _Powers()


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string or binary column (null: empty), as one array and offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words ``[^\\x20\\x09-\\x0D]+`` and the number of words of each text."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = off[:-1][off[:-1] < len(data)]
    first[cut] = solid[cut]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    ends_at = off[1:][off[1:] > 0] - 1
    last[ends_at] |= solid[ends_at]
    ends = np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, off))
    return starts, ends, counts


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, wherever the span stands."""
    out = np.empty(len(starts), np.uint64)
    step = 1 << 20
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):  # blocks of about 1 MiB bound the tables
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(starts, lo + step)))
            hi = int(ends[j - 1])
            p, q = POWERS.upto(hi - lo + 1)
            pre = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * p[:hi - lo], dtype=np.uint64, out=pre[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix64((pre[e] - pre[s]) * q[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            i = j
    return out


def batches(reader, column: str, limit: int = 1 << 20):
    """Arrow batches cut so that the text of one is about ``limit`` bytes (one row at least)."""
    for batch in reader:
        if batch.num_rows == 0:
            continue
        _, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def blocks(df: DataFrame, column: str, shard_bytes: int, level: int = 3) -> DataFrame:
    """Rows as compressed blocks (shard, block) of about 1 MiB of text; a shard is a run of blocks of one task.

    Shards depend on the tasks that read ``df``: save the result before it is used twice.
    """
    def run(it):
        part, size = TaskContext.get().partitionId(), 0
        z = zstandard.ZstdCompressor(level=level)
        for batch in batches(it, column):
            at = (part << 24) | (size // shard_bytes)
            size += batch.column(batch.schema.get_field_index(column)).nbytes
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()),
                                              pa.array([z.compress(sink.getvalue().to_pybytes())], pa.binary())],
                                             names=["shard", "block"])
    return df.mapInArrow(run, "shard long, block binary")


def open_block(block: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block)) as reader:
        return reader.read_all().combine_chunks().to_batches()[0]
