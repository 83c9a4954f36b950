"""Guardrail, classifier and prompt queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import guardrails as G
from ..operators import prompts as P
from ..operators import scorers as S
from ..operators.joins import broadcast_if_small
from ..operators.summary import leaderboard
from ..sources import fixtures as X
from ..sources.tables import read_table

MONITOR_PCT = 10.0


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_list(items) -> str:
    return "[" + ", ".join(_sql_str(x) for x in items) + "]"


def injection_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 + L2: first matching injection pattern per request."""
    r = X.requests(spark, sf_dir)
    sc = S.get_scorer("input_safety").column(r)
    return r.select("request_id", sc.safe.alias("safe"), sc.reason.alias("reason"))


def _first_pattern_sql(col: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({col}), {_sql_str(p)}) THEN {_sql_str(p)}"
                     for p in S.INJECTION_PATTERNS)
    return f"CASE {whens} END"


INJECTION_SCAN_SQL = X.with_ctes(X.REQUESTS_SQL, body=f"""
, m AS (SELECT request_id, {_first_pattern_sql('user_message')} AS hit FROM requests)
SELECT request_id, hit IS NULL AS safe,
  CASE WHEN hit IS NOT NULL THEN 'Potential prompt injection detected: matches pattern ''' || hit || '''' END AS reason
FROM m
""")


def policy_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forbidden phrases found in the output, in list order."""
    r = X.requests(spark, sf_dir)
    sc = S.get_scorer("policy").column(r)
    return r.select("request_id", sc.compliant.alias("compliant"),
                    F.array_join(sc.violations, "|").alias("violations"))


_POLICY_SQL = f"list_filter({_sql_list(S.FORBIDDEN_PHRASES)}, lambda p: contains(lower(output), p))"

POLICY_SCAN_SQL = X.with_ctes(X.REQUESTS_SQL, body=f"""
, v AS (SELECT request_id, {_POLICY_SQL} AS found FROM requests)
SELECT request_id, len(found) = 0 AS compliant,
  CASE WHEN len(found) > 0 THEN array_to_string(found, '|') END AS violations
FROM v
""")


def _guard_sql(pct: float) -> str:
    sampled = ("true" if pct >= 100 else
               f"((instr('0123456789abcdef', substring(md5(request_id), 1, 1)) - 1) * 16 + "
               f"instr('0123456789abcdef', substring(md5(request_id), 2, 1)) - 1) < {256.0 * pct / 100.0}")
    return f"""
g0 AS (
  SELECT request_id, output, toxicity_raw, quality_raw, {_first_pattern_sql('user_message')} AS hit,
    {sampled} AS monitored
  FROM requests),
g1 AS (
  SELECT *, hit IS NOT NULL AS in_blocked,
    CASE WHEN hit IS NULL THEN
      CASE WHEN json_valid(toxicity_raw)
           THEN coalesce(TRY_CAST(json_extract(toxicity_raw, '$.is_toxic') AS BOOLEAN), false) ELSE false END
    END AS tox_flag,
    CASE WHEN hit IS NULL THEN
      CASE WHEN json_valid(toxicity_raw) THEN json_extract_string(toxicity_raw, '$.reason')
           ELSE 'Parse error - defaulting to safe' END
    END AS tox_reason
  FROM g0),
g2 AS (
  SELECT *, in_blocked OR coalesce(tox_flag, false) AS blocked FROM g1),
g3 AS (
  SELECT *, CASE WHEN NOT blocked THEN {_POLICY_SQL} END AS found,
    CASE WHEN NOT blocked AND monitored AND json_valid(quality_raw) AND json_type(quality_raw) = 'OBJECT'
      THEN list_transform(json_keys(quality_raw), lambda k: TRY_CAST(json_extract(quality_raw, '$."' || k || '"') AS DOUBLE))
    END AS qv
  FROM g2),
guarded AS (
  SELECT request_id, blocked,
    CASE WHEN in_blocked THEN 'input_safety' WHEN tox_flag THEN 'toxicity' END AS block_reason,
    CASE WHEN in_blocked THEN {_sql_str(G.INPUT_BLOCK_REPLY)}
         WHEN tox_flag THEN {_sql_str(G.TOXIC_BLOCK_REPLY)}
         WHEN len(found) > 0 THEN output || chr(10) || chr(10) || {_sql_str(G.POLICY_NOTE.strip())}
         ELSE output END AS response,
    monitored,
    hit IS NULL AS safe,
    CASE WHEN hit IS NOT NULL THEN 'Potential prompt injection detected: matches pattern ''' || hit || '''' END
      AS injection_reason,
    tox_flag AS toxic_flagged, tox_reason AS toxic_reason,
    CASE WHEN found IS NOT NULL THEN len(found) = 0 END AS compliant,
    CASE WHEN len(found) > 0 THEN array_to_string(found, '|') END AS violations,
    CASE WHEN qv IS NOT NULL AND len(qv) > 0 AND len(list_filter(qv, lambda x: x IS NULL)) = 0
         THEN round(list_avg(qv), 2) END AS quality_average,
    CASE WHEN NOT blocked AND monitored THEN
      coalesce(qv IS NOT NULL AND len(qv) > 0 AND len(list_filter(qv, lambda x: x IS NULL)) = 0
               AND list_avg(qv) >= 3.5, false) END AS quality_passes
  FROM g3)
"""


def guardrail_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: staged guardrails, every request scored, flattened."""
    return G.flatten_guard(G.guard(X.requests(spark, sf_dir)))


GUARDRAIL_FLOW_SQL = X.with_ctes(X.REQUESTS_SQL, _guard_sql(100.0), body="\nSELECT * FROM guarded")


def guardrail_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: quality monitored on a stable 10% of requests."""
    g = G.guard(X.requests(spark, sf_dir), monitor_pct=MONITOR_PCT)
    return G.flatten_guard(g).select("request_id", "blocked", "monitored", "quality_average",
                                     "quality_passes")


GUARDRAIL_SAMPLE_SQL = X.with_ctes(X.REQUESTS_SQL, _guard_sql(MONITOR_PCT), body="""
SELECT request_id, blocked, monitored, quality_average, quality_passes FROM guarded
""")


def category_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword category from the classifier reply."""
    s = X.support(spark, sf_dir)
    return s.select("id", S.category_expr(F.col("raw_response")).alias("output"))


def _category_sql(col: str) -> str:
    r = f"lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"
    whens = " ".join(f"WHEN contains({r}, '{c}') THEN '{c}'" for c in X.CATEGORIES)
    return f"CASE {whens} ELSE {r} END"


CATEGORY_EXTRACT_SQL = X.with_ctes(X.SUPPORT_SQL, body=f"""
SELECT id, {_category_sql('raw_response')} AS output FROM support
""")


def prompt_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 + C2 + G3: accuracy (true fraction of correct) per prompt version."""
    s = X.support(spark, sf_dir).withColumn("output", S.category_expr(F.col("raw_response")))
    scored = S.evaluate(s, ["accuracy_scorer"], keep=["prompt_version"])
    return leaderboard(scored, "prompt_version", [("accuracy_scorer", "correct.true_fraction")])


PROMPT_ACCURACY_SQL = X.with_ctes(X.SUPPORT_SQL, body=f"""
, o AS (SELECT prompt_version, expected, {_category_sql('raw_response')} AS output FROM support)
SELECT prompt_version,
  round(avg(CAST(lower(regexp_replace(expected, '^\\s+|\\s+$', '', 'g')) =
                 lower(regexp_replace(output, '^\\s+|\\s+$', '', 'g')) AS INTEGER)), 6)
    AS accuracy_scorer_correct_true_fraction,
  count(*) AS n_rows
FROM o GROUP BY prompt_version
""")


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + B2 + F2 + A5: every user message rendered with every published
    version of the classifier prompt (versions resolved by reference)."""
    prompts = P.prompt_table(spark)
    msgs = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user") \
        .select("conv_id", "turn", F.col("text").alias("message"), F.lit(P.PROMPT_NAME).alias("name"))
    resolved = P.resolve(prompts, prompts.select("name", "version"))
    j = msgs.join(broadcast_if_small(resolved), "name")
    prompt = P.render_column(F.col("template"), "message", F.col("message"))
    from ..functions.text import messages
    return j.select("conv_id", "turn", F.col("resolved_version").alias("version"),
                    prompt.alias("prompt")).withColumn(
        "n_messages", F.size(messages(("user", F.col("prompt")))))


def _prompt_values_sql() -> str:
    rows = ", ".join(f"({i + 1}, {_sql_str(t)})" for i, t in enumerate(P.SUPPORT_CLASSIFIER_TEMPLATES))
    return f"prompts(version, template) AS (VALUES {rows})"


PROMPT_RENDER_SQL = X.with_ctes(_prompt_values_sql(), body=r"""
SELECT c.conv_id, c.turn, CAST(p.version AS INTEGER) AS version,
  list_reduce(list_transform(
    string_split(replace(replace(p.template, '{{', chr(1)), '}}', chr(2)), '{message}'),
    lambda x: replace(replace(x, chr(1), '{'), chr(2), '}')), lambda a, b: a || c.text || b) AS prompt,
  1 AS n_messages
FROM conversations c, prompts p WHERE c.role = 'user'
""")


def guardrail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on Structured Streaming: the request log is written to the shared
    folder, drained by a ``readStream`` query (``availableNow`` trigger,
    parquet sink with a checkpoint) and the sink is read back.  Same rows as
    ``guardrail_flow``."""
    import uuid

    from ..session import shared_dir
    from ..streaming.guardrail_stream import guard_stream, run_to_sink
    root = shared_dir(spark, f"streams/guardrail-{uuid.uuid4().hex}")
    X.requests(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/requests")
    q = run_to_sink(guard_stream(spark, f"{root}/requests"), f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    cols = [f.name for f in guardrail_flow(spark, sf_dir).schema.fields]
    return spark.read.parquet(f"{root}/out").select(*cols)


GUARDRAIL_STREAM_SQL = GUARDRAIL_FLOW_SQL
