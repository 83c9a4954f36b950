"""Reproducible sharding: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of (id, size, checksum, hash of the text), whatever files or partitions hold them.
The row number goes through a Feistel network on a rectangle of a x b cells, a = ceil(sqrt(rows)), b = ceil(rows / a):
each round adds a keyed function of one coordinate to the other, modulo its side, which can be undone, so the
network is a permutation of the cells.  A number that lands beyond the last row walks on through the network until
it lands on a row.  Fewer than a cells lie beyond the last row, and where each of them leads is walked out in
a table of its own, so the rows pass the network once.  Position p goes to shard p mod shards and slot p div shards:
counts differ by at most one, slots have no gap, and ``locate`` computes both from a row number, ``row_at`` the row number
from both, without the table.

Only DataFrame functions; the rows are shuffled once (the range sort of the narrow columns, no text), and the
one broadcast beside the offsets of partitions is the table of fewer than ceil(sqrt(rows)) cells.

Defined results: a null text counts as empty (size 16, checksum 0); ids may be null (numbered first) or repeat; rows
equal in id and text are numbered one after the other, each in its own slot; other columns are never read,
whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import places_to_index, range_places
from .common import Workspace

SHARDS = 40
SEED = 42
ROUNDS = 8
OVERHEAD = 16
#: Modulus of the round function; row counts up to its square (4.6e18) are handled.
PRIME = (1 << 31) - 1


def round_keys(seed: int = SEED, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Two keys below PRIME for each round."""
    raw = [hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(rounds)]
    return [(int.from_bytes(r[:8], "big") % PRIME, int.from_bytes(r[8:16], "big") % PRIME) for r in raw]


def sides(rows: int) -> tuple[int, int]:
    """Sides of the smallest near-square rectangle that holds ``rows`` cells."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1) if rows else 1
    return a, max(1, -(-rows // a))


def _mix(x: int, keys: tuple[int, int]) -> int:
    u = (x + keys[0]) % PRIME
    v = (u * u + keys[1]) % PRIME
    return v * v % PRIME


def _forward(x: int, a: int, b: int, keys) -> int:
    left, right = divmod(x, b)
    for i, k in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mix(right, k)) % a
        else:
            right = (right + _mix(left, k)) % b
    return left * b + right


def _backward(x: int, a: int, b: int, keys) -> int:
    left, right = divmod(x, b)
    for i in range(len(keys) - 1, -1, -1):
        if i % 2 == 0:
            left = (left - _mix(right, keys[i])) % a
        else:
            right = (right - _mix(left, keys[i])) % b
    return left * b + right


def locate(row: int, rows: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number, without reading anything."""
    (a, b), keys = sides(rows), round_keys(seed)
    p = _forward(row, a, b, keys)
    while p >= rows:
        p = _forward(p, a, b, keys)
    return p % shards, p // shards


def row_at(shard: int, slot: int, rows: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Row number that lies in a slot of a shard: the inverse of ``locate``."""
    (a, b), keys = sides(rows), round_keys(seed)
    x = _backward(slot * shards + shard, a, b, keys)
    while x >= rows:
        x = _backward(x, a, b, keys)
    return x


def network(df: DataFrame, col: str, a: int, b: int, keys, out: str) -> DataFrame:
    """``df`` with ``out``: the cell to which the network takes the cell ``col``.

    Every step is a projection of its own, so that a value used twice is computed once.
    """
    kept = [f"`{c}`" for c in df.columns if c != out]
    d = df.selectExpr(*kept, f"`{col}` div {b}L AS __l", f"`{col}` % {b}L AS __r")
    for i, (k1, k2) in enumerate(keys):
        source, target, side = ("__r", "__l", a) if i % 2 == 0 else ("__l", "__r", b)
        d = d.selectExpr(*kept, "__l", "__r", f"({source} + {k1}L) % {PRIME}L AS __u")
        d = d.selectExpr(*kept, "__l", "__r", f"(__u * __u + {k2}L) % {PRIME}L AS __v")
        d = d.selectExpr(*kept, source, f"({target} + (__v * __v) % {PRIME}L) % {side}L AS {target}")
    return d.selectExpr(*kept, f"__l * {b}L + __r AS `{out}`")


def exits(spark: SparkSession, ws: Workspace, rows: int, a: int, b: int, keys) -> DataFrame:
    """(cell, exit) of the cells beyond the last row: the first row that their walk meets.

    Every walk ends, since the network is a permutation and a row leads into it; each turn moves all walks that have
    not ended, and there are fewer than ``a`` of them at the start.
    """
    open_, done, turn = spark.range(rows, a * b).withColumnRenamed("id", "cell").withColumn("at", F.col("cell")), None, 0
    while True:
        moved = ws.save(network(open_.select("cell", "at"), "at", a, b, keys, "to")
                        .select("cell", F.col("to").alias("at")), f"walk_{turn}")
        inside = moved.filter(F.col("at") < rows).select("cell", F.col("at").alias("exit"))
        done = inside if done is None else done.unionByName(inside)
        open_, turn = moved.filter(F.col("at") >= rows), turn + 1
        if open_.isEmpty():
            return done


def shard(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          seed: int = SEED) -> DataFrame:
    """Rows (id, size, text_crc32, law, shard, slot, grown_shard, row_number) of every row of ``docs``."""
    ws = Workspace(spark, "sharding")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_col).alias("id"), (F.octet_length(body) + F.lit(OVERHEAD)).cast("long").alias("size"),
                         F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("h"))
    # equal rows may be a third of all: their place in the file splits them, and their order shows nowhere
    spread = narrow.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.asc_nulls_first("id"), F.asc("size"), F.asc("text_crc32"), F.asc("h"), F.asc("tie")]
    placed = ws.save(range_places(spread, *order).drop("h", "tie"), "placed")
    rows = placed.count()
    (a, b), keys = sides(rows), round_keys(seed)
    # written before the join: the optimiser would copy the network into the join's conditions
    found = ws.save(network(places_to_index(placed, "row_number"), "row_number", a, b, keys, "p"), "found")
    ws.drop("placed")
    if 0 < rows < a * b:
        found = (found.join(F.broadcast(exits(spark, ws, rows, a, b, keys)), F.col("p") == F.col("cell"), "left")
                 .withColumn("p", F.coalesce("exit", "p")))
    return found.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("p") % shards).cast("int").alias("shard"), F.expr(f"p div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def oracle_sql(shards: int = SHARDS, seed: int = SEED, rounds: int = ROUNDS) -> str:
    """The same sharding as DuckDB SQL over the table ``documents``: checksum by a fold over the bytes,
    walks by a recursive table."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    step = f"SELECT row_number, n, a, b, x // b AS l, x % b AS r FROM {{}}"
    for i, (k1, k2) in enumerate(round_keys(seed, rounds)):
        source, keep = ("r", "r") if i % 2 == 0 else ("l", "l")
        target, side = ("l", "a") if i % 2 == 0 else ("r", "b")
        step = f"SELECT *, ({source} + {k1}) % {PRIME} AS u FROM ({step})"
        step = f"SELECT * EXCLUDE (u), (u * u + {k2}) % {PRIME} AS v FROM ({step})"
        step = (f"SELECT row_number, n, a, b, {keep}, ({target} + (v * v) % {PRIME}) % {side} AS {target} FROM ({step})")
    step = f"SELECT row_number, n, a, b, l * b + r AS x FROM ({step})"
    return f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {OVERHEAD} AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
crc AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor({table}[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS text_crc32 FROM raw),
numbered AS (
  SELECT doc_id, size, text_crc32, count(*) OVER () AS n,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number FROM crc),
walk(row_number, n, a, b, x) AS (
  {step.format("(SELECT row_number, n, a, (n + a - 1) // a AS b, row_number AS x FROM (SELECT row_number, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered))")}
  UNION ALL
  {step.format("(SELECT row_number, n, a, b, x FROM walk WHERE x >= n)")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {shards} AS INTEGER) AS shard, x // {shards} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, row_number
FROM numbered JOIN walk USING (row_number) WHERE x < walk.n
"""
