"""Dataset curation: parse, validate, filter, deduplicate, judge, sample and
number examples (A6, A7, B5, B6, D1-D6, E1, G5, G6, H3, H4, I1, I2).

Every stage is a narrow projection or filter except exact dedup (one
partial aggregate on the question hash) and numbering (see ``ordering``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import verdicts as V
from ..functions.text import strip_py, word_count
from .ordering import range_index

REQUIRED_FIELDS = ("question", "context", "reference_answer", "scenario")
EXAMPLE_STRUCT = "question string, context string, reference_answer string"


# ------------------------------------------------------------ A6, A7, B5, I1

def parse_payloads(payloads: DataFrame, raw_col: str = "raw",
                   keep: Sequence[str] = ("payload_id", "scenario"),
                   generated_by: str = "generator") -> tuple[DataFrame, DataFrame]:
    """Split generator replies into example rows and error rows.

    Valid JSON with an ``examples`` array yields one row per element (``pos``
    keeps the array order); a missing key yields no rows; invalid JSON goes to
    the error output.  Both outputs read the same scan.
    """
    ok = F.try_parse_json(F.col(raw_col)).isNotNull()
    parsed = F.from_json(F.col(raw_col), f"examples array<struct<{EXAMPLE_STRUCT}>>")
    good = payloads.filter(ok).select(
        *keep, F.posexplode(F.coalesce(parsed.getField("examples"), F.array())).alias("pos", "ex"))
    rows = good.select(*keep, "pos", "ex.question", "ex.context", "ex.reference_answer",
                       F.lit(generated_by).alias("generated_by"))
    errors = payloads.filter(~ok).select(*keep, F.lit("invalid JSON").alias("error"))
    return rows, errors


def tag_provenance(df: DataFrame, generated_at: str, model: str,
                   targeted: Column | bool = False) -> DataFrame:
    """Nested provenance struct; the timestamp is a job parameter so
    reruns give the same rows."""
    t = targeted if isinstance(targeted, Column) else F.lit(bool(targeted))
    return df.withColumn("metadata", F.struct(
        F.lit(generated_at).alias("generated_at"), F.lit(model).alias("model"), t.alias("targeted")))


# ------------------------------------------------------------ D1, D2, D3

def missing_fields(fields: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Names of required fields that are absent, null or empty (a
    whitespace-only value passes), in field order."""
    return F.array_compact(F.array(*[
        F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in fields]))


def length_checks(min_q: int = 5, min_c: int = 20, min_a: int = 3) -> dict[str, Column]:
    """Whitespace word counts, inclusive minimums."""
    q, c, a = word_count("question"), word_count("context"), word_count("reference_answer")
    return {"q_len": q, "c_len": c, "a_len": a,
            "length_ok": (q >= min_q) & (c >= min_c) & (a >= min_a)}


# Allowed difficulty and category values of a support case.
DIFFICULTIES = ["easy", "medium", "hard"]
CASE_CATEGORIES = ["products", "shipping", "returns", "account", "payment"]
CASE_KEYS = ["question", "answer", "difficulty", "category"]


def schema_failure(raw: Column) -> Column:
    """D3: the first failed rule of a support case as text, null when valid."""
    v = F.try_parse_json(raw)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    out = F.lit(None).cast("string")
    steps = []
    for k in CASE_KEYS:
        item = F.try_variant_get(v, f"$.{k}", "variant")
        typ = F.schema_of_variant(item)
        sval = F.try_variant_get(v, f"$.{k}", "string")
        steps.append((item.isNull(), F.lit(f"Missing key: {k}")))
        steps.append((typ != "STRING", F.lit(f"Key {k} is not a string")))
        steps.append((strip_py(sval) == "", F.lit(f"Key {k} is empty")))
    diff = F.try_variant_get(v, "$.difficulty", "string")
    cat = F.try_variant_get(v, "$.category", "string")
    steps.append((~diff.isin(DIFFICULTIES), F.concat(F.lit("Invalid difficulty: "), diff)))
    steps.append((~cat.isin(CASE_CATEGORIES), F.concat(F.lit("Invalid category: "), cat)))
    for cond, msg in reversed(steps):
        out = F.when(cond, msg).otherwise(out)
    return F.when(~is_obj, F.lit("Not an object")).otherwise(out)


# ------------------------------------------------------------ E1

def question_hash(col: str = "question") -> Column:
    """md5 of ``question.lower().strip()`` (missing -> empty string)."""
    return F.md5(strip_py(F.lower(F.coalesce(F.col(col), F.lit("")))))


def dedup_exact(df: DataFrame, order_col: str = "seq", col: str = "question") -> DataFrame:
    """Keep the first row (in ``order_col`` order) of every question hash.

    The smallest ``order_col`` of a hash is a partial hash aggregate over two
    narrow columns; the rows join it on (hash, order), which is unique, so a
    hash shared by a third of all rows skews neither.
    """
    marked = df.withColumn("question_hash", question_hash(col))
    first = marked.groupBy("question_hash").agg(F.min(order_col).alias(order_col))
    return marked.join(first, ["question_hash", order_col], "left_semi").select(*df.columns, "question_hash")


# ------------------------------------------------------------ D4-D6, G6

STAGES = ("format", "length", "dedup", "judge")


def curation_status(examples: DataFrame, verdicts: DataFrame, order_col: str = "seq",
                    verdict_key: str = "id", accept_col: str = "accept_raw") -> DataFrame:
    """Per example, the first stage that removed it (null = kept): format
    (D1), length (D2), exact dedup among survivors (E1), judge accept
    (C20/D4; no verdict reads as a failed parse, i.e. not accepted)."""
    lc = length_checks()
    d = examples.withColumn("_missing", missing_fields()).withColumn("_len_ok", lc["length_ok"])
    pre = F.when(F.size("_missing") > 0, F.lit("format")).when(~F.col("_len_ok"), F.lit("length"))
    d = d.withColumn("_pre", pre).withColumn("_h", question_hash())
    # first row per hash among survivors (partial aggregate), joined back on
    # (hash, seq): the pair is unique, so a hot hash does not skew the join
    keepers = d.filter(F.col("_pre").isNull()).groupBy("_h").agg(
        F.min(order_col).alias(order_col)).withColumn("_first", F.lit(True))
    d = d.join(keepers, ["_h", order_col], "left")
    v = verdicts.select(F.col(verdict_key).alias(order_col), V.accept(F.col(accept_col)).alias("_acc"))
    d = d.join(v, order_col, "left")
    accepted = F.coalesce(F.col("_acc").getField("accept"), F.lit(False))
    status = (F.when(F.col("_pre").isNotNull(), F.col("_pre"))
              .when(F.col("_first").isNull(), F.lit("dedup"))
              .when(~accepted, F.lit("judge")))
    return d.select(*examples.columns, status.alias("removed_at"))


# ------------------------------------------------------------ B6, H3, H4

def assign_ids(df: DataFrame, order_col: str = "seq", prefix_col: str = "scenario",
               prefix: str = "synthetic_") -> DataFrame:
    """``{prefix}{scenario}_{i:03d}`` with ``i`` the global 0-based
    position in ``order_col`` order (``%03d`` widens past 999)."""
    n = range_index(df, order_col, "_i")
    return n.withColumn("id", F.concat(F.lit(prefix), F.col(prefix_col), F.lit("_"),
                                       F.format_string("%03d", F.col("_i")))).drop("_i")


def review_sample(df: DataFrame, n: int, seed: str, key_col: str = "seq") -> DataFrame:
    """H3: repeatable sample without replacement of min(n, rows) rows, by
    hash order (TakeOrderedAndProject keeps n rows per task)."""
    h = F.md5(F.concat(F.lit(seed), F.col(key_col).cast("string")))
    top = df.withColumn("_h", h).orderBy("_h", key_col).limit(n)
    # numbering n (<= a few dozen) rows in one task is fine
    return top.withColumn("sample_ord", F.row_number().over(Window.orderBy("_h", key_col))).drop("_h")


def apply_decisions(sample: DataFrame, decisions: DataFrame, accepted: DataFrame,
                    key_col: str = "seq") -> DataFrame:
    """H4: keep 'y' rows reviewed before the first 's'; when none is kept,
    keep every accepted row."""
    d = sample.join(decisions.select(key_col, "decision"), key_col)
    # the sample holds at most n rows, so one window over it is bounded
    stop = F.min(F.when(F.col("decision") == "s", F.col("sample_ord"))).over(Window.partitionBy())
    d = d.withColumn("_stop", stop)
    kept = d.filter((F.col("decision") == "y") &
                    (F.col("_stop").isNull() | (F.col("sample_ord") < F.col("_stop"))))
    kept = kept.select(*accepted.columns)
    # one row if any was kept: the anti join on a constant then leaves none of the accepted rows
    some = kept.select(F.lit(1).alias("_kept")).distinct()
    rest = accepted.withColumn("_kept", F.lit(1)).join(F.broadcast(some), "_kept", "left_anti")
    return kept.unionByName(rest.select(*accepted.columns))


class EmptyStageError(RuntimeError):
    """A curation stage removed every row."""


def stage_gate(df: DataFrame, stage: str) -> DataFrame:
    """Stop the build when a stage leaves no rows (one ``isEmpty`` probe,
    which reads a single row)."""
    if df.isEmpty():
        raise EmptyStageError(f"all examples were removed at stage {stage!r}")
    return df


def curate(examples: DataFrame, verdicts: DataFrame, order_col: str = "seq",
           verdict_key: str = "id", accept_col: str = "accept_raw") -> DataFrame:
    """The staged build: format, length, exact dedup, gate, judge, gate.
    Returns the accepted rows; raises ``EmptyStageError`` like the script's
    early exits."""
    lc = length_checks()
    d = examples.filter(F.size(missing_fields()) == 0).filter(lc["length_ok"])
    d = stage_gate(dedup_exact(d, order_col).drop("question_hash"), "dedup")
    v = verdicts.select(F.col(verdict_key).alias(order_col), V.accept(F.col(accept_col)).alias("_acc"))
    acc = d.join(v, order_col, "left").filter(F.coalesce(F.col("_acc.accept"), F.lit(False))).drop("_acc")
    return stage_gate(acc, "judge")
