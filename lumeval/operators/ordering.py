"""Order-dependent helpers that stay distributed.

``global_index`` numbers rows in a global order (B6) without the
single-task window a bare ``row_number() over (order by x)`` needs: rows are
cut into blocks of the order key, block sizes are counted with a partial
aggregate, offsets come from a running sum over the (few) block counts, and
rows are numbered inside their block in parallel.

``running_total`` is the same two-level scan for running sums within a
partition key (K3): a hot key is cut into blocks of its order column, so no
task ever holds the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_BLOCK = 1 << 20
_SERIAL = (1 << 33) - 1


def range_places(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows in global order with ``_part`` (range partition) and ``_at`` (0-based place in it).

    Both hold only within one execution: write or checkpoint the frame before
    ``places_to_index``.  Rows equal in ``order`` stay in one partition; add a
    tie-breaking column where one value may hold a large share of the rows.
    """
    return df.orderBy(*order).withColumns({
        "_part": F.spark_partition_id(),
        "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_SERIAL))})


def places_to_index(placed: DataFrame, out_col: str = "idx") -> DataFrame:
    """Global 0-based row numbers from a materialised ``range_places`` frame.

    The running sum sees one row per range partition, and so does the
    broadcast side of the join; the rows themselves are not shuffled.
    """
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    names = [F.col(c) for c in placed.columns if c not in ("_part", "_at")]
    return placed.join(F.broadcast(offsets), "_part").select(
        *names, (F.col("_off") + F.col("_at")).cast("long").alias(out_col))


def global_index(df: DataFrame, order_col: str, out_col: str = "idx",
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """0-based position of each row by ``order_col`` (unique, integral)."""
    blk = F.floor(F.col(order_col) / F.lit(block)).cast("long")
    d = df.withColumn("_blk", blk)
    counts = d.groupBy("_blk").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_blk", (F.sum("_n").over(Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    ranked = d.withColumn("_rn", F.row_number().over(Window.partitionBy("_blk").orderBy(order_col)))
    return ranked.join(offsets, "_blk").select(
        *[F.col(c) for c in df.columns],
        (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn") - 1).cast("long").alias(out_col))


def range_index(df: DataFrame, order_col: str, out_col: str = "idx") -> DataFrame:
    """0-based position of each row in the order of ``order_col``, of any sortable type.

    One range shuffle; the sorted rows are checkpointed, so their places hold.  Equal values (nulls first) are numbered
    in no particular order, and are spread over partitions however many there are.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tie = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    placed = range_places(tie, F.asc_nulls_first(order_col), F.asc("_tie")).drop("_tie").checkpoint(eager=True)
    return places_to_index(placed, out_col)


def running_total(df: DataFrame, keys: Sequence[str], order_col: str,
                  values: dict[str, Column], block: int = 1 << 16,
                  inclusive: bool = True) -> DataFrame:
    """Add running sums ``values`` (name -> expression) over ``order_col``
    within ``keys``.  ``order_col`` is integral; blocks are ``block`` wide."""
    keys = list(keys)
    d = df.withColumn("_blk", F.floor(F.col(order_col) / F.lit(block)).cast("long"))
    for name, expr in values.items():
        d = d.withColumn(f"_v_{name}", expr.cast("long"))
    per_block = d.groupBy(*keys, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in values])
    wb = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_block.select(*keys, "_blk", *[
        F.coalesce(F.sum(f"_b_{n}").over(wb), F.lit(0)).alias(f"_o_{n}") for n in values])
    frame_end = Window.currentRow if inclusive else -1
    wi = Window.partitionBy(*keys, "_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, frame_end)
    inner = d.select(*df.columns, "_blk", *[
        F.coalesce(F.sum(f"_v_{n}").over(wi), F.lit(0)).alias(f"_i_{n}") for n in values])
    j = inner.join(offs, [*keys, "_blk"])
    return j.select(*df.columns, *[(F.col(f"_o_{n}") + F.col(f"_i_{n}")).alias(n) for n in values])
