"""Conversation history (K3).

A system turn starts a new history; every later message is appended to it.
Instead of materialising each prefix (quadratic in conversation length),
every message gets its history coordinates: the segment it belongs to and
its position and running size in that segment.  Both are running sums over
``turn``, computed with the two-level block scan of ``ordering`` so a very
long conversation is spread over many tasks.  ``history_at`` returns the
ordered messages of one history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_total


def history_coordinates(conv: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", block: int = 1 << 16) -> DataFrame:
    is_sys = (F.col(role_col) == "system")
    seg = running_total(conv, [conv_col], turn_col, {"segment": is_sys.cast("int")}, block=block)
    nonsys = (~is_sys).cast("int")
    chars = F.when(~is_sys, F.length(F.col(text_col))).otherwise(F.lit(0))
    h = running_total(seg, [conv_col, "segment"], turn_col, {"_n": nonsys, "history_chars": chars},
                      block=block)
    # position 1 is the system message that heads every history
    return h.withColumn("history_len", (F.col("_n") + 1).cast("long")).drop("_n")


def history_at(conv: DataFrame, coords: DataFrame, conv_id: int, turn: int,
               conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Ordered messages of the history seen at ``(conv_id, turn)``."""
    me = coords.filter((F.col(conv_col) == conv_id) & (F.col(turn_col) == turn)).select("segment")
    seg = coords.filter(F.col(conv_col) == conv_id).join(me, "segment") \
        .filter(F.col(turn_col) <= turn).select(turn_col)
    return conv.filter(F.col(conv_col) == conv_id).join(seg, turn_col).orderBy(turn_col)
