"""Judge-verdict parsers (C14-C21) as JVM expressions.

Unparsable replies become null (or the documented default), never an error:
``try_cast`` is guarded by a strict number pattern because Spark's cast is
looser than Python's (``'5d'`` casts to 5.0), and JSON failures are told apart
from JSON nulls with ``try_parse_json``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_py, words

# Python float() literals (underscore digit groups are not accepted here).
FLOAT_RE = r"(?i)^[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)$"
INT_RE = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_float(s) -> Column:
    s = _col(s)
    return F.when(s.rlike(FLOAT_RE), s.try_cast("double"))


def py_int(s) -> Column:
    s = _col(s)
    return F.when(s.rlike(INT_RE), s.try_cast("long"))


def first_token_score(raw) -> Column:
    """C14: ``float(raw.strip().split()[0])``; empty or bad -> null."""
    return py_float(F.get(words(_col(raw)), 0))


def capped_score(raw, cap: float = 0.9999) -> tuple[Column, Column]:
    """``min((s - 1) / 4, cap)`` and the raw score; bad -> both null, nan stays nan."""
    s = py_float(strip_py(raw))
    return F.when(s.isNull() | F.isnan(s), s).otherwise(F.least((s - 1) / 4, F.lit(cap))), s


def plain_score(raw) -> tuple[Column, Column]:
    """``(s - 1) / 4`` without cap or clamp, and the raw score."""
    s = py_float(strip_py(raw))
    return (s - 1) / 4, s


def int_score(raw) -> Column:
    """C17: ``(int(raw.strip()) - 1) / 4``; '4.0' is not an int -> null."""
    s = py_int(strip_py(raw))
    return (s - 1) / 4


def json_ok(raw) -> Column:
    return F.try_parse_json(_col(raw)).isNotNull()


def json_truthy(raw, field: str) -> Column:
    """Whether a JSON object's field is truthy: a true boolean, a number but 0, any text or list but the empty one."""
    v = F.try_variant_get(F.try_parse_json(_col(raw)), f"$.{field}", "variant")
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.length(text) > 0)
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}"))
        .when(kind != "VOID", F.try_variant_get(v, "$", "double") != 0), F.lit(False))


def toxicity(raw) -> Column:
    """struct(flagged, reason); any truthy value flags; bad JSON -> not flagged, fixed reason."""
    j = F.from_json(_col(raw), "reason string")
    ok = json_ok(raw)
    return F.struct(
        F.when(ok, json_truthy(raw, "is_toxic")).otherwise(F.lit(False)).alias("flagged"),
        F.when(ok, j.getField("reason")).otherwise(F.lit("Parse error - defaulting to safe")).alias("reason"))


def quality(raw, threshold: float = 3.5) -> Column:
    """C19 + G7: dimensions as a map, mean of all values rounded to 2, pass
    when the unrounded mean reaches the threshold.  A non-numeric value,
    a null value, an empty object or bad JSON -> null average, not passing."""
    m = F.from_json(_col(raw), "map<string,double>")
    vals = F.map_values(m)
    n = F.size(vals)
    has_null = F.exists(vals, lambda v: v.isNull())
    total = F.aggregate(vals, F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    avg = F.when(json_ok(raw) & m.isNotNull() & (n > 0) & ~has_null, total / n)
    return F.struct(m.alias("dimensions"), F.round(avg, 2).alias("average"),
                    F.coalesce(avg >= F.lit(threshold), F.lit(False)).alias("passes_threshold"))


def accept(raw) -> Column:
    """C20: keep flag (JSON boolean only) and reasoning; bad JSON -> false
    with a fixed reason."""
    j = F.from_json(_col(raw), "accept boolean, reasoning string")
    ok = json_ok(raw)
    return F.struct(
        F.when(ok, F.coalesce(j.getField("accept"), F.lit(False))).otherwise(F.lit(False)).alias("accept"),
        F.when(ok, j.getField("reasoning")).otherwise(F.lit("Failed to parse validation")).alias("reasoning"))


def accept_scores(raw) -> Column:
    """C20: the numeric scores of an accept reply by name; bad JSON -> none."""
    return F.when(json_ok(raw), json_numbers(raw)).otherwise(F.create_map().cast("map<string,double>"))


def json_numbers(raw) -> Column:
    """The numeric top-level fields of a JSON object as a map; null if the text is no object."""
    m = F.from_json(_col(raw), "map<string,string>")
    kept = F.map_filter(m, lambda k, v: v.rlike(FLOAT_RE))
    return F.transform_values(kept, lambda k, v: v.try_cast("double"))


def first_missing(fields: list[str]) -> Column:
    """Name of the first of the columns that is null, else null."""
    return F.coalesce(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields])


def pass_verdict(raw, min_score: float = 4.0, missing: Column | None = None) -> Column:
    """struct(passed, score, issues); pass needs a truthy flag and the score.

    A missing flag or score counts as false / 0.  ``missing`` names an input field that the judged row lacks: such
    a row fails with score 0 whatever the reply says.  Bad JSON fails with a fixed issue.
    """
    j = F.from_json(_col(raw), "score double, issues array<string>")
    ok = json_ok(raw)
    flag = F.when(ok, json_truthy(raw, "pass")).otherwise(F.lit(False))
    score = F.when(ok, F.coalesce(j.getField("score"), F.lit(0.0))).otherwise(F.lit(0.0))
    issues = F.when(ok, j.getField("issues")).otherwise(F.array(F.lit("Failed to parse judge reply")))
    if missing is not None:
        lacking = missing.isNotNull()
        flag, score = flag & ~lacking, F.when(lacking, F.lit(0.0)).otherwise(score)
        issues = F.when(lacking, F.array(F.concat(F.lit("Missing "), missing))).otherwise(issues)
    return F.struct((flag & (score >= F.lit(min_score))).alias("passed"), score.alias("score"), issues.alias("issues"))
