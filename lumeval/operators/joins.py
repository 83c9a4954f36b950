"""Join helpers with an explicit size check before a broadcast."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000
FILTER_BITS = 1 << 26  # of a Bloom filter at most: 8 MB


def broadcast_if_small(small: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the side is proven small (one count);
    otherwise the frame is returned unchanged and Spark shuffles both sides
    (AQE may still broadcast it at run time by its measured size)."""
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def ensure_parallelism(df: DataFrame, key: str | None = None, factor: int = 4) -> DataFrame:
    """Spread a CPU-heavy row-local stage over the cluster.

    A small input file is one scan partition, and byte-based coalescing can
    squeeze text-heavy rows into few tasks.  When the frame has fewer
    partitions than ``factor`` x the default parallelism it is hash
    repartitioned (on ``key`` if given); a large input is left untouched.
    """
    want = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)


def maybe_among(spark: SparkSession, keys: DataFrame, key: str, most_bits: int = FILTER_BITS):
    """A function of a column: true for every value that ``keys`` holds (null is a value) and for few others.

    A Bloom filter of bounded size, 16 bits a key while that fits: it spares the rows that it rules out a
    shuffle, whatever the number of keys.  What it lets through has to be joined with the keys still.
    """
    hashes = keys.select(F.xxhash64(key).alias("h"))
    bits = min(most_bits, 1 << max(16, int(hashes.count() * 16 - 1).bit_length()))
    at = F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 38).bitwiseAND(bits - 1)))
    rows = (hashes.select(at.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask")).toArrow())
    words = np.zeros(bits // 64, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    held = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        words, h = held.value, h.to_numpy().view(np.uint64)
        ok = np.ones(len(h), bool)
        for p in (h, h >> np.uint64(38)):
            p = (p & np.uint64(bits - 1)).astype(np.int64)
            ok &= (words[p >> 6] >> (p & 63)) & 1 == 1
        return pd.Series(ok)

    return lambda column: test(F.xxhash64(column))
