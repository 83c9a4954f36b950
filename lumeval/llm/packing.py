"""Packing of token ids into sequences of a fixed length: bounded-space online best fit.

Every partition keeps ``OPEN`` windows.  A piece goes into the window that it fills best; when none has
room, the fullest is filled up with the head of the piece and given out.  At the end the pieces of a
partition's open windows are laid together, which leaves one partial window; the partial windows of
all partitions are then merged in rounds of ``FAN`` partitions, best fit again.

Defined results: a null or empty text is its end id alone; texts longer than a sequence are cut;
repeated rows are packed one by one; ids may be null or repeat; other columns are never read; an
empty table gives no piece.  Only the last window of a merged group holds padding, and windows whose gap is
smaller than ``LEAST_CUT``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import Workspace, batches
from .tokens import WordIds

LENGTH = 2048
END_ID = 1
OPEN = 8
LEAST_CUT = 8
FAN = 64


class Packer:
    """Open windows of one partition; a window is a list of (owner, start, ids)."""

    def __init__(self, length: int = LENGTH, slots: int = OPEN, least: int = LEAST_CUT):
        self.length, self.slots, self.least = length, slots, least
        self.open: list[list] = []  # [used, pieces]

    def add(self, owner, ids: bytes):
        """Places a document's ids (4 bytes each); yields the windows that are given out."""
        at, n = 0, len(ids) // 4
        while at < n:
            size = min(n - at, self.length)
            if size == self.length:
                yield [size, [(owner, at, ids[4 * at:4 * (at + size)])]]
                at += size
                continue
            fit = max((w for w in self.open if w[0] + size <= self.length), key=lambda w: w[0], default=None)
            if fit is None and len(self.open) < self.slots:
                fit = [0, []]
                self.open.append(fit)
            if fit is None:
                fit = max(self.open, key=lambda w: w[0])
                self.open.remove(fit)
                gap = self.length - fit[0]
                if gap >= self.least:
                    fit[1].append((owner, at, ids[4 * at:4 * (at + gap)]))
                    fit[0] += gap
                    at += gap
                yield fit
                continue
            fit[1].append((owner, at, ids[4 * at:4 * (at + size)]))
            fit[0] += size
            at += size
            if fit[0] == self.length:
                self.open.remove(fit)
                yield fit

    def close(self):
        """Lays the open windows' pieces together: (window, full?)."""
        pieces = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]]
        now = [0, []]
        for owner, start, ids in pieces:
            while ids:
                room = self.length - now[0]
                head, ids = ids[:4 * room], ids[4 * room:]
                now[1].append((owner, start, head))
                now[0] += len(head) // 4
                start += len(head) // 4
                if now[0] == self.length:
                    yield now, True
                    now = [0, []]
        if now[0]:
            yield now, False
        self.open = []


def _pack(keep: list[str], path: str | None, with_ids: bool):
    def run(it):
        tokens, packer = WordIds(path), Packer()
        part, serial = TaskContext.get().partitionId(), 0
        end = END_ID.to_bytes(4, "little")
        names = [*keep, "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "partial"]
        kinds = None

        def rows(windows):
            nonlocal serial
            out = [[] for _ in range(len(names) + with_ids)]
            for (used, pieces), full in windows:
                offset = 0
                for (owner, total), start, ids in pieces:
                    n = len(ids) // 4
                    values = (*owner, start, n, zlib.crc32(ids), total, (part << 33) | serial, offset, not full)
                    for c, v in enumerate(values):
                        out[c].append(v)
                    if with_ids:
                        out[-1].append(np.frombuffer(ids, "<i4"))
                    offset += n
                serial += 1
            types = [*kinds, *[pa.int64()] * 6, pa.bool_(), *[pa.list_(pa.int32())] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)],
                                              names=[*names, *["ids"] * with_ids])

        for batch in batches(it, "__text"):
            kinds = [batch.schema.field(c).type for c in keep]
            owners = zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in keep])
            texts = batch.column(batch.schema.get_field_index("__text"))
            done = []
            for owner, text in zip(owners, texts):
                ids = tokens.ids(text.as_py()) + end
                done += [(w, True) for w in packer.add((owner, len(ids) // 4), ids)]
            yield rows(done)
        if kinds:
            yield rows(list(packer.close()))
    return run


def _merge(it):
    """Partial windows (grp, window, used) sorted by (grp, used desc) -> (window, into, base)."""
    for batch in it:
        out = [[], [], []]
        grp, window, used = (batch.column(i).to_pylist() for i in range(3))
        now, bins = None, []
        for g, w, u in zip(grp, window, used):
            if g != now:
                now, bins = g, []
            fit = max((b for b in bins if b[1] + u <= LENGTH), key=lambda b: b[1], default=None)
            if fit is None:
                fit = [w, 0]
                bins.append(fit)
                if len(bins) > OPEN * FAN:
                    bins.remove(max(bins, key=lambda b: b[1]))
            for c, v in enumerate((w, fit[0], fit[1])):
                out[c].append(v)
            fit[1] += u
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["window", "into", "base"])


def pack(spark: SparkSession, docs: DataFrame, keep: list[str] = ("doc_id",), tokenizer: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep`` columns, start, length, ids_crc32, doc_tokens, sequence_id, offset (, ids).

    ``tokenizer``: path of a tokenizer file (the public word-level BPE by default).
    """
    ws = Workspace(spark, "packing")
    keep = list(keep)
    src = docs.select(*keep, F.col("text").alias("__text"))
    schema = src.select(*keep).schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "window", "offset"):
        schema = schema.add(name, "long")
    schema = schema.add("partial", "boolean")
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    pieces = ws.save(src.mapInArrow(_pack(keep, tokenizer, with_ids), schema), "pieces")
    # one partial window per partition; rounds of FAN partitions merge what is left
    left = ws.save(pieces.filter("partial").groupBy("window").agg(F.sum("length").alias("used")), "left_0")
    place = ws.save(left.select("window", F.col("window").alias("into"), F.lit(0).cast("long").alias("base")), "place_0")
    width, i = FAN, 0
    while True:
        grp = F.floor(F.shiftright("window", 33) / width)
        keyed = left.withColumn("grp", grp).select("grp", "window", "used")
        moved = ws.save(keyed.repartition("grp").sortWithinPartitions("grp", F.desc("used"), "window")
                        .mapInArrow(_merge, "window long, into long, base long"), f"moved_{i}")
        step = moved.select(F.col("window").alias("into"), F.col("into").alias("to"), F.col("base").alias("more"))
        place = ws.save(place.join(step, "into").select("window", F.col("to").alias("into"),
                                                        (F.col("base") + F.col("more")).alias("base")),
                        f"place_{i + 1}")
        left = ws.save(left.join(moved, "window").groupBy(F.col("into").alias("window"))
                       .agg(F.sum("used").alias("used")), f"left_{i + 1}")
        i += 1
        if left.select(F.floor(F.shiftright("window", 33) / width)).distinct().limit(2).count() < 2:
            break
        width *= FAN
    out = pieces.join(place, "window", "left").withColumn(
        "sequence_id", F.coalesce("into", "window")).withColumn("offset", F.col("offset") + F.coalesce("base", F.lit(0)))
    return out.select(*keep, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                      *["ids"] * with_ids)
