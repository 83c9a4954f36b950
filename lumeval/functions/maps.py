"""Key/value record helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kv(key: str, value) -> Column:
    """One entry for ``map_from_entries``: string key, value cast to string."""
    v = F.lit(value) if isinstance(value, str) else value
    return F.struct(F.lit(key).alias("k"), v.cast("string").alias("v"))


def string_map(*entries: Column) -> Column:
    """``map<string,string>`` from ``kv`` entries; null values are left out,
    so an absent key reads as null."""
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.getField("v").isNotNull()))
