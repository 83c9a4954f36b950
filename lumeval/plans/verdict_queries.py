"""Verdict-parsing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import verdicts as V
from ..sources import fixtures as X

# Same literal grammar in DuckDB (RE2): Python float() and int() forms.
_FLOAT = r"'(?i)^[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)$'"
_INT = r"'^[+-]?[0-9]+$'"
_STRIP = r"regexp_replace(raw, '^\s+|\s+$', '', 'g')"


def judge_first_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = X.judge_raw(spark, sf_dir)
    return j.select("id", F.round(V.first_token_score("raw"), 6).alias("judge_quality_score"))


JUDGE_FIRST_TOKEN_SQL = X.with_ctes(X.JUDGE_RAW_SQL, body=rf"""
SELECT id, round(CASE WHEN regexp_matches(t, {_FLOAT}) THEN TRY_CAST(t AS DOUBLE) END, 6)
  AS judge_quality_score
FROM (SELECT id, list_filter(string_split_regex(raw, '\s+'), lambda x: x <> '')[1] AS t FROM judge_raw)
""")


def judge_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = X.judge_raw(spark, sf_dir)
    score, raw = V.capped_score("raw")
    return j.select("id", F.round(score, 6).alias("accuracy_score"), raw.alias("accuracy_raw"))


JUDGE_CAPPED_SQL = X.with_ctes(X.JUDGE_RAW_SQL, body=rf"""
SELECT id, round(CASE WHEN s IS NULL OR isnan(s) THEN s ELSE least((s - 1) / 4, 0.9999) END, 6) AS accuracy_score, s AS accuracy_raw
FROM (SELECT id, CASE WHEN regexp_matches(t, {_FLOAT}) THEN TRY_CAST(t AS DOUBLE) END AS s
      FROM (SELECT id, {_STRIP} AS t FROM judge_raw))
""")


def judge_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = X.judge_raw(spark, sf_dir)
    score, raw = V.plain_score("raw")
    return j.select("id", F.round(score, 6).alias("helpfulness_score"), raw.alias("helpfulness_raw"))


JUDGE_PLAIN_SQL = X.with_ctes(X.JUDGE_RAW_SQL, body=rf"""
SELECT id, round((s - 1) / 4, 6) AS helpfulness_score, s AS helpfulness_raw
FROM (SELECT id, CASE WHEN regexp_matches(t, {_FLOAT}) THEN TRY_CAST(t AS DOUBLE) END AS s
      FROM (SELECT id, {_STRIP} AS t FROM judge_raw))
""")


def judge_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = X.judge_raw(spark, sf_dir)
    return j.select("id", F.round(V.int_score("raw"), 6).alias("faithfulness"))


JUDGE_INT_SQL = X.with_ctes(X.JUDGE_RAW_SQL, body=rf"""
SELECT id, round((CASE WHEN regexp_matches(t, {_INT}) THEN TRY_CAST(t AS BIGINT) END - 1) / 4, 6)
  AS faithfulness
FROM (SELECT id, {_STRIP} AS t FROM judge_raw)
""")


def toxicity_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = X.verdict_json(spark, sf_dir)
    t = V.toxicity("toxicity_raw")
    return v.select("id", t.getField("flagged").alias("flagged"), t.getField("reason").alias("reason"))


TOXICITY_VERDICT_SQL = X.with_ctes(X.VERDICT_JSON_SQL, body=r"""
SELECT id,
  CASE WHEN json_valid(toxicity_raw)
       THEN coalesce(CASE json_type(toxicity_raw, '$.is_toxic')
              WHEN 'BOOLEAN' THEN json_extract_string(toxicity_raw, '$.is_toxic') = 'true'
              WHEN 'VARCHAR' THEN json_extract_string(toxicity_raw, '$.is_toxic') <> ''
              WHEN 'NULL' THEN false
              WHEN 'ARRAY' THEN json_extract_string(toxicity_raw, '$.is_toxic') <> '[]'
              WHEN 'OBJECT' THEN json_extract_string(toxicity_raw, '$.is_toxic') <> '{}'
              ELSE TRY_CAST(json_extract_string(toxicity_raw, '$.is_toxic') AS DOUBLE) <> 0 END, false)
       ELSE false END AS flagged,
  CASE WHEN json_valid(toxicity_raw) THEN json_extract_string(toxicity_raw, '$.reason')
       ELSE 'Parse error - defaulting to safe' END AS reason
FROM verdict_json
""")


def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = X.verdict_json(spark, sf_dir)
    q = V.quality("quality_raw")
    dims = q.getField("dimensions")
    return v.select(
        "id", *[dims.getItem(k).alias(k) for k in ("relevance", "helpfulness", "clarity", "professionalism")],
        q.getField("average").alias("average"), q.getField("passes_threshold").alias("passes_threshold"))


QUALITY_VERDICT_SQL = X.with_ctes(X.VERDICT_JSON_SQL, body=r"""
, parsed AS (
  SELECT id, quality_raw AS raw,
    coalesce(CASE WHEN json_valid(quality_raw) THEN json_type(quality_raw) END = 'OBJECT', false) AS is_obj
  FROM verdict_json),
vals AS (
  SELECT id, raw, is_obj,
    CASE WHEN is_obj THEN list_transform(json_keys(raw), lambda k: json_extract(raw, '$."' || k || '"')) END AS v
  FROM parsed),
chk AS (
  SELECT id, raw, is_obj, v,
    is_obj AND len(v) > 0 AND
      len(list_filter(v, lambda x: json_type(x) NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE'))) = 0 AS numeric
  FROM vals)
SELECT id,
  CASE WHEN numeric OR (is_obj AND len(v) = 0) THEN TRY_CAST(json_extract(raw, '$.relevance') AS DOUBLE) END AS relevance,
  CASE WHEN numeric OR (is_obj AND len(v) = 0) THEN TRY_CAST(json_extract(raw, '$.helpfulness') AS DOUBLE) END AS helpfulness,
  CASE WHEN numeric OR (is_obj AND len(v) = 0) THEN TRY_CAST(json_extract(raw, '$.clarity') AS DOUBLE) END AS clarity,
  CASE WHEN numeric OR (is_obj AND len(v) = 0) THEN TRY_CAST(json_extract(raw, '$.professionalism') AS DOUBLE) END AS professionalism,
  CASE WHEN numeric THEN round(list_avg(list_transform(v, lambda x: TRY_CAST(x AS DOUBLE))), 2) END AS average,
  coalesce(CASE WHEN numeric THEN list_avg(list_transform(v, lambda x: TRY_CAST(x AS DOUBLE))) >= 3.5 END, false) AS passes_threshold
FROM chk
""")


_SCORES = ("context_quality", "question_quality", "answer_correctness", "overall_usefulness")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies beside the example that they judge (null fields if it is gone)."""
    return X.verdict_json(spark, sf_dir).join(X.examples(spark, sf_dir).withColumnRenamed("seq", "id"), "id", "left")


def accept_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20 + D4: the accept flag, reasoning and scores per reviewed row, with the original row."""
    v = _judged(spark, sf_dir).withColumns({"a": V.accept("accept_raw"), "s": V.accept_scores("accept_raw")})
    return v.select("id", F.substring(F.coalesce("question", F.lit("")), 1, 50).alias("example_id"), "a.accept",
                    "a.reasoning", *[F.try_element_at("s", F.lit(k)).alias(k) for k in _SCORES],
                    "question", "context", "reference_answer", "scenario")


ACCEPT_VERDICT_SQL = X.with_ctes(X.VERDICT_JSON_SQL, X.EXAMPLES_SQL, body=r"""
SELECT id, substr(coalesce(question, ''), 1, 50) AS example_id,
  CASE WHEN json_valid(accept_raw)
       THEN coalesce(TRY_CAST(json_extract(accept_raw, '$.accept') AS BOOLEAN), false)
       ELSE false END AS accept,
  CASE WHEN json_valid(accept_raw) THEN json_extract_string(accept_raw, '$.reasoning')
       ELSE 'Failed to parse validation' END AS reasoning,
""" + "".join(f"  CASE WHEN json_valid(accept_raw) THEN TRY_CAST(json_extract_string(accept_raw, '$.{k}') AS DOUBLE) END"
              f" AS {k},\n" for k in _SCORES) + r"""
  question, context, reference_answer, scenario
FROM verdict_json LEFT JOIN examples ON seq = id
""")


#: Fields that a judged row must have (fixed values).
JUDGED_FIELDS = ["question", "context", "reference_answer", "scenario"]


def pass_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C21 + D5: pass/fail split with the verdict attached (status column); rows that lack a field fail."""
    v = _judged(spark, sf_dir)
    p = V.pass_verdict("pass_raw", missing=V.first_missing(JUDGED_FIELDS))
    v = v.withColumn("p", p)
    return v.select("id", "p.passed", "p.score", F.array_join("p.issues", "; ").alias("issues"),
                    F.when(F.col("p.passed"), F.lit("passed")).otherwise(F.lit("failed")).alias("status"))


def _truthy_sql(raw: str, field: str) -> str:
    kind, text = f"json_type({raw}, '$.{field}')", f"json_extract_string({raw}, '$.{field}')"
    return (f"coalesce(CASE {kind} WHEN 'BOOLEAN' THEN {text} = 'true' WHEN 'VARCHAR' THEN {text} <> '' "
            f"WHEN 'NULL' THEN false WHEN 'ARRAY' THEN {text} <> '[]' WHEN 'OBJECT' THEN {text} <> '{{}}' "
            f"ELSE TRY_CAST({text} AS DOUBLE) <> 0 END, false)")


PASS_VERDICT_SQL = X.with_ctes(X.VERDICT_JSON_SQL, X.EXAMPLES_SQL, body=rf"""
, p AS (
  SELECT id,
    CASE WHEN question IS NULL THEN 'question' WHEN context IS NULL THEN 'context'
         WHEN reference_answer IS NULL THEN 'reference_answer' WHEN scenario IS NULL THEN 'scenario' END AS missing,
    CASE WHEN json_valid(pass_raw) THEN {_truthy_sql('pass_raw', 'pass')} ELSE false END AS flag,
    CASE WHEN json_valid(pass_raw) THEN coalesce(TRY_CAST(json_extract(pass_raw, '$.score') AS DOUBLE), 0.0)
         ELSE 0.0 END AS score,
    CASE WHEN json_valid(pass_raw)
         THEN array_to_string(CAST(json_extract(pass_raw, '$.issues') AS VARCHAR[]), '; ')
         ELSE 'Failed to parse judge reply' END AS issues
  FROM verdict_json LEFT JOIN examples ON seq = id)
SELECT id, missing IS NULL AND flag AND score >= 4.0 AS passed,
  CASE WHEN missing IS NULL THEN score ELSE 0.0 END AS score,
  CASE WHEN missing IS NULL THEN issues ELSE 'Missing ' || missing END AS issues,
  CASE WHEN missing IS NULL AND flag AND score >= 4.0 THEN 'passed' ELSE 'failed' END AS status
FROM p
""")


def hallucination_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C22 + G2: true fraction of the hallucination verdict column."""
    v = X.verdict_json(spark, sf_dir)
    return v.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg(F.col("has_hallucination").cast("int")), 6)
                 .alias("has_hallucination_true_fraction"))


HALLUCINATION_RATE_SQL = X.with_ctes(X.VERDICT_JSON_SQL, body=r"""
SELECT count(*) AS n_rows, round(avg(CAST(has_hallucination AS INTEGER)), 6) AS has_hallucination_true_fraction
FROM verdict_json
""")
