"""Curation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curate as C
from ..operators.summary import stage_funnel
from ..sources import fixtures as X

SAMPLE_SEED = "review-seed-42"
SAMPLE_SIZE = 10
GENERATED_AT = "2026-01-01T00:00:00"

_WS = r"'\s+'"


def _wc(col: str) -> str:
    return f"len(list_filter(string_split_regex(coalesce({col}, ''), {_WS}), lambda x: x <> ''))"


def _hash(col: str) -> str:
    return f"md5(regexp_replace(lower(coalesce({col}, '')), '^\\s+|\\s+$', '', 'g'))"


def parse_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + I1 + L5: generator replies exploded to example rows."""
    rows, _ = C.parse_payloads(X.generated_payloads(spark, sf_dir))
    return rows


PARSE_GENERATED_SQL = X.with_ctes(X.GENERATED_PAYLOADS_SQL, body=r"""
, ok AS (SELECT * FROM generated_payloads WHERE json_valid(raw))
SELECT payload_id, scenario, CAST(pos - 1 AS INTEGER) AS pos,
  json_extract_string(e, '$.question') AS question, json_extract_string(e, '$.context') AS context,
  json_extract_string(e, '$.reference_answer') AS reference_answer, 'generator' AS generated_by
FROM ok, unnest(CAST(coalesce(json_extract(raw, '$.examples'), '[]') AS JSON[])) WITH ORDINALITY AS t(e, pos)
""")


def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that are not JSON, as error rows."""
    _, errors = C.parse_payloads(X.generated_payloads(spark, sf_dir))
    return errors


PARSE_ERRORS_SQL = X.with_ctes(X.GENERATED_PAYLOADS_SQL, body="""
SELECT payload_id, scenario, 'invalid JSON' AS error FROM generated_payloads WHERE NOT json_valid(raw)
""")


def format_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields present and non-empty, with the missing list."""
    e = X.examples(spark, sf_dir)
    m = C.missing_fields()
    return e.select("seq", (F.size(m) == 0).alias("passed"), m.alias("missing"))


FORMAT_FILTER_SQL = X.with_ctes(X.EXAMPLES_SQL, body="""
, m AS (SELECT seq, list_filter([
    CASE WHEN coalesce(question, '') = '' THEN 'question' END,
    CASE WHEN coalesce(context, '') = '' THEN 'context' END,
    CASE WHEN coalesce(reference_answer, '') = '' THEN 'reference_answer' END,
    CASE WHEN coalesce(scenario, '') = '' THEN 'scenario' END], lambda x: x IS NOT NULL) AS missing
  FROM examples)
SELECT seq, len(missing) = 0 AS passed, missing FROM m
""")


def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts >= 5 / 20 / 3 for question / context / answer."""
    e = X.examples(spark, sf_dir)
    lc = C.length_checks()
    return e.select("seq", lc["q_len"].alias("q_len"), lc["c_len"].alias("c_len"),
                    lc["a_len"].alias("a_len"), lc["length_ok"].alias("passed"))


LENGTH_FILTER_SQL = X.with_ctes(X.EXAMPLES_SQL, body=f"""
, l AS (SELECT seq, {_wc('question')} AS q_len, {_wc('context')} AS c_len,
               {_wc('reference_answer')} AS a_len FROM examples)
SELECT seq, CAST(q_len AS INTEGER) AS q_len, CAST(c_len AS INTEGER) AS c_len, CAST(a_len AS INTEGER) AS a_len,
       q_len >= 5 AND c_len >= 20 AND a_len >= 3 AS passed FROM l
""")


def schema_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: support-case schema check, first failure named."""
    s = X.support_cases(spark, sf_dir)
    r = C.schema_failure(F.col("raw"))
    return s.select("id", r.isNull().alias("valid"), r.alias("reason"))


def _key_checks(k: str) -> str:
    return (f"WHEN json_extract(raw, '$.{k}') IS NULL THEN 'Missing key: {k}' "
            f"WHEN json_type(json_extract(raw, '$.{k}')) <> 'VARCHAR' THEN 'Key {k} is not a string' "
            f"WHEN regexp_matches(json_extract_string(raw, '$.{k}'), '^\\s*$') THEN 'Key {k} is empty' ")


SCHEMA_VALIDATE_SQL = X.with_ctes(X.SUPPORT_CASES_SQL, body=f"""
, r AS (
  SELECT id, CASE
    WHEN NOT coalesce(CASE WHEN json_valid(raw) THEN json_type(raw) END = 'OBJECT', false) THEN 'Not an object'
    {''.join(_key_checks(k) for k in C.CASE_KEYS)}
    WHEN json_extract_string(raw, '$.difficulty') NOT IN ('easy', 'medium', 'hard')
      THEN 'Invalid difficulty: ' || json_extract_string(raw, '$.difficulty')
    WHEN json_extract_string(raw, '$.category') NOT IN ('products', 'shipping', 'returns', 'account', 'payment')
      THEN 'Invalid category: ' || json_extract_string(raw, '$.category')
    END AS reason
  FROM support_cases)
SELECT id, reason IS NULL AS valid, reason FROM r
""")


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First example per normalised-question md5, in input order."""
    e = X.examples(spark, sf_dir).select("seq", "question", "scenario")
    return C.dedup_exact(e).select("seq", "question_hash")


DEDUP_EXACT_SQL = X.with_ctes(X.EXAMPLES_SQL, body=f"""
SELECT min(seq) AS seq, h AS question_hash
FROM (SELECT seq, {_hash('question')} AS h FROM examples) GROUP BY h
""")


def _status(spark, sf_dir):
    return C.curation_status(X.examples(spark, sf_dir), X.verdict_json(spark, sf_dir))


_STATUS_SQL = f"""
st AS (
  SELECT seq, question, scenario, list_filter([
      CASE WHEN coalesce(question, '') = '' THEN 'question' END,
      CASE WHEN coalesce(context, '') = '' THEN 'context' END,
      CASE WHEN coalesce(reference_answer, '') = '' THEN 'reference_answer' END,
      CASE WHEN coalesce(scenario, '') = '' THEN 'scenario' END], lambda x: x IS NOT NULL) AS missing,
    {_wc('question')} AS q_len, {_wc('context')} AS c_len, {_wc('reference_answer')} AS a_len,
    {_hash('question')} AS h
  FROM examples),
pre AS (
  SELECT *, CASE WHEN len(missing) > 0 THEN 'format'
                 WHEN NOT (q_len >= 5 AND c_len >= 20 AND a_len >= 3) THEN 'length' END AS pre
  FROM st),
keep AS (SELECT h, min(seq) AS first_seq FROM pre WHERE pre IS NULL GROUP BY h),
acc AS (
  SELECT id AS seq, CASE WHEN json_valid(accept_raw)
    THEN coalesce(TRY_CAST(json_extract(accept_raw, '$.accept') AS BOOLEAN), false) ELSE false END AS accept
  FROM verdict_json),
status AS (
  SELECT p.seq, p.question, p.scenario,
    CASE WHEN p.pre IS NOT NULL THEN p.pre WHEN p.seq <> k.first_seq THEN 'dedup'
         WHEN NOT coalesce(a.accept, false) THEN 'judge' END AS removed_at
  FROM pre p LEFT JOIN keep k ON k.h = p.h LEFT JOIN acc a ON a.seq = p.seq),
final AS (SELECT seq, question, scenario FROM status WHERE removed_at IS NULL)
"""


def curation_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6 + G12 + D4: rows before / after each stage, removed and removed %."""
    return stage_funnel(_status(spark, sf_dir), "removed_at", C.STAGES)


CURATION_FUNNEL_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL, body="""
, c AS (
  SELECT count(*) AS n0,
    sum(CASE WHEN removed_at = 'format' THEN 1 ELSE 0 END) AS r1,
    sum(CASE WHEN removed_at = 'length' THEN 1 ELSE 0 END) AS r2,
    sum(CASE WHEN removed_at = 'dedup' THEN 1 ELSE 0 END) AS r3,
    sum(CASE WHEN removed_at = 'judge' THEN 1 ELSE 0 END) AS r4
  FROM status),
s AS (
  SELECT 1 AS stage_no, 'format' AS stage, n0 AS before, r1 AS removed FROM c
  UNION ALL SELECT 2, 'length', n0 - r1, r2 FROM c
  UNION ALL SELECT 3, 'dedup', n0 - r1 - r2, r3 FROM c
  UNION ALL SELECT 4, 'judge', n0 - r1 - r2 - r3, r4 FROM c)
SELECT stage_no, stage, CAST(before AS BIGINT) AS before, CAST(before - removed AS BIGINT) AS after,
  CAST(removed AS BIGINT) AS removed,
  round(CASE WHEN before = 0 THEN NULL ELSE removed * 100.0 / before END, 1) AS removed_pct
FROM s
""")


def _final(spark, sf_dir):
    return _status(spark, sf_dir).filter(F.col("removed_at").isNull()).select("seq", "question", "scenario")


def scenario_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 + H2: kept examples per scenario, sorted by scenario."""
    return _final(spark, sf_dir).groupBy("scenario").agg(F.count(F.lit(1)).alias("n")).orderBy("scenario")


SCENARIO_COUNTS_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL, body="""
SELECT scenario, count(*) AS n FROM final GROUP BY scenario ORDER BY scenario
""")


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from the global position among kept examples."""
    return C.assign_ids(_final(spark, sf_dir)).select("seq", "id")


ASSIGN_IDS_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL, body="""
SELECT seq, 'synthetic_' || scenario || '_' || printf('%03d', row_number() OVER (ORDER BY seq) - 1) AS id
FROM final
""")


def short_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The judge's example key, first 50 characters of the question."""
    from ..functions.text import short_key as sk
    e = X.examples(spark, sf_dir)
    return e.select("seq", sk("question").alias("example_id"))


SHORT_KEY_SQL = X.with_ctes(X.EXAMPLES_SQL, body="""
SELECT seq, substring(coalesce(question, ''), 1, 50) AS example_id FROM examples
""")


def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: repeatable review sample of 10 kept examples."""
    s = C.review_sample(_final(spark, sf_dir), SAMPLE_SIZE, SAMPLE_SEED)
    return s.select("seq", "sample_ord")


_SAMPLE_SQL = f"""
sample AS (
  SELECT seq, question, scenario,
    row_number() OVER (ORDER BY md5('{SAMPLE_SEED}' || CAST(seq AS VARCHAR)), seq) AS sample_ord
  FROM final QUALIFY sample_ord <= {SAMPLE_SIZE})
"""

REVIEW_SAMPLE_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL, _SAMPLE_SQL,
                                body="SELECT seq, CAST(sample_ord AS INTEGER) AS sample_ord FROM sample")


def apply_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: reviewer decisions applied; none approved -> all kept examples."""
    final = _final(spark, sf_dir)
    sample = C.review_sample(final, SAMPLE_SIZE, SAMPLE_SEED)
    return C.apply_decisions(sample, X.decisions(sample), final).select("seq", "scenario")


APPLY_DECISIONS_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL, _SAMPLE_SQL, body=r"""
, d AS (
  SELECT s.*, CASE WHEN regexp_matches(substring(md5(CAST(seq AS VARCHAR)), 1, 1), '^[0-9]$') THEN 'y'
                   WHEN substring(md5(CAST(seq AS VARCHAR)), 1, 1) IN ('a', 'b', 'c', 'd') THEN 'n'
                   ELSE 's' END AS decision
  FROM sample s),
stop AS (SELECT min(CASE WHEN decision = 's' THEN sample_ord END) AS stop_ord FROM d),
kept AS (SELECT seq, scenario FROM d, stop
         WHERE decision = 'y' AND (stop_ord IS NULL OR sample_ord < stop_ord))
SELECT seq, scenario FROM kept
UNION ALL
SELECT seq, scenario FROM final WHERE NOT EXISTS (SELECT 1 FROM kept)
""")


def extend_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v2 = v1 kept rows with ids + new validated rows (no ids, no
    cross-version dedup), by name with missing columns filled by null."""
    v1 = C.assign_ids(_final(spark, sf_dir)).select("id", "question", "scenario", F.lit("v1").alias("origin"))
    rows, _ = C.parse_payloads(X.generated_payloads(spark, sf_dir))
    ex = rows.select((F.col("payload_id") * 2 + F.col("pos")).alias("seq"),
                     "question", "context", "reference_answer", "scenario")
    verd = X.verdict_json(spark, sf_dir)
    # the judge's reply for a payload applies to both of its examples
    verd2 = verd.select((F.col("id") * 2).alias("id"), "accept_raw").unionByName(
        verd.select((F.col("id") * 2 + 1).alias("id"), "accept_raw"))
    new = C.curation_status(ex, verd2).filter(F.col("removed_at").isNull()) \
        .select("question", "scenario", F.lit("new").alias("origin"))
    return v1.unionByName(new, allowMissingColumns=True)


EXTEND_DATASET_SQL = X.with_ctes(X.EXAMPLES_SQL, X.VERDICT_JSON_SQL, _STATUS_SQL,
                                 X.GENERATED_PAYLOADS_SQL, body=f"""
, nb AS (
  SELECT payload_id * 2 + (pos - 1) AS seq, scenario,
    json_extract_string(e, '$.question') AS question, json_extract_string(e, '$.context') AS context,
    json_extract_string(e, '$.reference_answer') AS reference_answer
  FROM generated_payloads, unnest(CAST(coalesce(json_extract(raw, '$.examples'), '[]') AS JSON[]))
       WITH ORDINALITY AS t(e, pos)
  WHERE json_valid(raw)),
nst AS (
  SELECT seq, question, scenario, list_filter([
      CASE WHEN coalesce(question, '') = '' THEN 'question' END,
      CASE WHEN coalesce(context, '') = '' THEN 'context' END,
      CASE WHEN coalesce(reference_answer, '') = '' THEN 'reference_answer' END,
      CASE WHEN coalesce(scenario, '') = '' THEN 'scenario' END], lambda x: x IS NOT NULL) AS missing,
    {_wc('question')} AS q_len, {_wc('context')} AS c_len, {_wc('reference_answer')} AS a_len,
    {_hash('question')} AS h
  FROM nb),
npre AS (
  SELECT *, CASE WHEN len(missing) > 0 THEN 'format'
                 WHEN NOT (q_len >= 5 AND c_len >= 20 AND a_len >= 3) THEN 'length' END AS pre
  FROM nst),
nkeep AS (SELECT h, min(seq) AS first_seq FROM npre WHERE pre IS NULL GROUP BY h),
nacc AS (SELECT seq // 2 AS pid, seq FROM npre),
new_rows AS (
  SELECT p.question, p.scenario
  FROM npre p JOIN nkeep k ON k.h = p.h AND k.first_seq = p.seq
  JOIN acc a ON a.seq = p.seq // 2
  WHERE p.pre IS NULL AND a.accept)
SELECT 'synthetic_' || scenario || '_' || printf('%03d', row_number() OVER (ORDER BY seq) - 1) AS id,
       question, scenario, 'v1' AS origin FROM final
UNION ALL
SELECT NULL AS id, question, scenario, 'new' AS origin FROM new_rows
""")


def tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance struct on generated rows (flattened for comparison)."""
    rows, _ = C.parse_payloads(X.generated_payloads(spark, sf_dir))
    t = C.tag_provenance(rows, GENERATED_AT, "generator", targeted=F.col("pos") == 1)
    return t.select("payload_id", "pos", "metadata.generated_at", "metadata.model", "metadata.targeted")


TAG_ROWS_SQL = X.with_ctes(X.GENERATED_PAYLOADS_SQL, body=f"""
SELECT payload_id, CAST(pos - 1 AS INTEGER) AS pos, '{GENERATED_AT}' AS generated_at, 'generator' AS model,
       pos - 1 = 1 AS targeted
FROM generated_payloads, unnest(CAST(coalesce(json_extract(raw, '$.examples'), '[]') AS JSON[]))
     WITH ORDINALITY AS t(e, pos)
WHERE json_valid(raw)
""")


def dedup_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered greedy near-duplicate removal on whole document texts
    (Jaccard > 0.9).  No SQL oracle: checked against a sequential loop in
    the tests."""
    from ..operators.joins import ensure_parallelism
    from ..operators.neardup import near_dup_keep
    from ..sources.tables import read_table
    d = ensure_parallelism(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return near_dup_keep(d, "doc_id", "text", 0.9)
