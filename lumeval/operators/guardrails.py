"""Staged guardrails over request rows (K1, K2), batch or streaming.

The whole flow is one stateless projection, so the same function serves a
batch DataFrame and a ``readStream`` DataFrame.  Stage order and
short-circuit follow the support flow: input safety blocks, output toxicity
blocks, a policy violation only appends a note, and quality is monitored on
the sampled share of the unblocked requests.  Stages after a block leave a
null score; expensive stages sit inside ``when`` so they are not evaluated
for blocked rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import verdicts as V
from .scorers import input_safety_expr, policy_expr

# Replies and note of the support flow.
INPUT_BLOCK_REPLY = ("I'm sorry, but I can't process that request. Please rephrase your question "
                     "about our products or services.")
TOXIC_BLOCK_REPLY = "I apologize, but I need to rephrase my response. How else can I help you today?"
POLICY_NOTE = "\n\n(Note: For specific guarantees, please contact our team directly.)"


def in_sample(key: Column, pct: float) -> Column:
    """K2: stable sampling by the first byte of md5(key): in when
    ``byte < 256 * pct / 100``; repeatable across retries and engines."""
    if pct >= 100:
        return F.lit(True)
    b = F.conv(F.substring(F.md5(key.cast("string")), 1, 2), 16, 10).cast("int")
    return b < F.lit(256.0 * pct / 100.0)


def guard(df: DataFrame, *, id_col: str = "request_id", user_col: str = "user_message",
          output_col: str = "output", toxicity_col: str = "toxicity_raw",
          quality_col: str = "quality_raw", monitor_pct: float = 100.0,
          case_insensitive_injection: bool = False) -> DataFrame:
    """Add ``response, blocked, block_reason, scores`` to every request."""
    inp = input_safety_expr(F.col(user_col), case_insensitive=case_insensitive_injection)
    d = df.withColumn("_inp", inp)
    in_blocked = ~F.col("_inp.safe")
    d = d.withColumn("_tox", F.when(~in_blocked, V.toxicity(F.col(toxicity_col))))
    tox_blocked = F.coalesce(F.col("_tox.flagged"), F.lit(False))
    blocked = in_blocked | tox_blocked
    d = d.withColumn("_blocked", blocked).withColumn(
        "_pol", F.when(~F.col("_blocked"), policy_expr(F.col(output_col))))
    sampled = in_sample(F.col(id_col), monitor_pct)
    d = d.withColumn("_sampled", sampled).withColumn(
        "_q", F.when(~F.col("_blocked") & F.col("_sampled"), V.quality(F.col(quality_col))))
    response = (F.when(in_blocked, F.lit(INPUT_BLOCK_REPLY))
                .when(tox_blocked, F.lit(TOXIC_BLOCK_REPLY))
                .when(~F.col("_pol.compliant"), F.concat(F.col(output_col), F.lit(POLICY_NOTE)))
                .otherwise(F.col(output_col)))
    reason = F.when(in_blocked, F.lit("input_safety")).when(tox_blocked, F.lit("toxicity"))
    scores = F.struct(F.col("_inp").alias("input_safety"), F.col("_tox").alias("toxicity"),
                      F.col("_pol").alias("policy"), F.col("_q").alias("quality"))
    return d.select(*df.columns, response.alias("response"), F.col("_blocked").alias("blocked"),
                    reason.alias("block_reason"), F.col("_sampled").alias("monitored"),
                    scores.alias("scores"))


def flatten_guard(g: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Flat view of the guard result (one column per score field)."""
    s = F.col("scores")
    return g.select(
        id_col, "blocked", "block_reason", "response", "monitored",
        s.input_safety.safe.alias("safe"), s.input_safety.reason.alias("injection_reason"),
        s.toxicity.flagged.alias("toxic_flagged"), s.toxicity.reason.alias("toxic_reason"),
        s.policy.compliant.alias("compliant"),
        F.array_join(s.policy.violations, "|").alias("violations"),
        s.quality.average.alias("quality_average"), s.quality.passes_threshold.alias("quality_passes"))
