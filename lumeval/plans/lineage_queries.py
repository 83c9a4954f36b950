"""Lineage, run-metric, file-manifest, conversation and UDF-surface queries
(A3, A4, J1-J5, G11, G12, K3, L4, L5)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conversations as CV
from ..operators import lineage as L
from ..operators import scorers as S
from ..operators.predict import predict_with
from ..session import shared_dir
from ..sources import catalog as CAT
from ..sources import fixtures as X
from ..sources.tables import read_table


def lineage_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ancestor of every artifact with its depth (frontier loop)."""
    return L.ancestors(X.dag_edges(spark, sf_dir))


LINEAGE_ANCESTORS_SQL = "WITH RECURSIVE " + X.DAG_EDGES_SQL.strip() + """,
anc(node, ancestor, depth) AS (
  SELECT child, parent, 1 FROM dag_edges
  UNION ALL
  SELECT a.node, e.parent, a.depth + 1 FROM anc a JOIN dag_edges e ON e.child = a.ancestor
  WHERE e.parent <> e.child)
SELECT node, ancestor, min(depth) AS depth FROM anc GROUP BY node, ancestor
"""



def lineage_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every descendant of every artifact with its depth."""
    return L.descendants(X.dag_edges(spark, sf_dir))


LINEAGE_DESCENDANTS_SQL = "WITH RECURSIVE " + X.DAG_EDGES_SQL.strip() + """,
anc(node, ancestor, depth) AS (
  SELECT child, parent, 1 FROM dag_edges
  UNION ALL
  SELECT a.node, e.parent, a.depth + 1 FROM anc a JOIN dag_edges e ON e.child = a.ancestor
  WHERE e.parent <> e.child)
SELECT ancestor AS node, node AS descendant, min(depth) AS depth FROM anc GROUP BY node, ancestor
"""


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version per artifact name."""
    return L.latest_versions(X.artifact_versions(spark, sf_dir))


LATEST_VERSIONS_SQL = X.with_ctes(X.ARTIFACT_VERSIONS_SQL, body="""
SELECT name, max(version) AS latest_version, count(*) AS n_versions FROM artifact_versions GROUP BY name
""")


def eval_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J3: each run (order) uses its customer's dataset at ``latest`` and
    produces one result artifact; the resolved versions are recorded."""
    o = read_table(spark, sf_dir, "orders")
    uses = o.select(F.col("o_orderkey").cast("string").alias("run_id"),
                    F.concat(F.lit("dataset-"), F.col("o_custkey").cast("string")).alias("name"))
    used = L.resolve_inputs(uses, X.artifact_versions(spark, sf_dir)).select(
        "run_id", F.lit("uses").alias("direction"), "name", "version")
    produced = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.lit("produces").alias("direction"),
                        F.concat(F.lit("eval-results-"), F.col("o_orderkey").cast("string")).alias("name"),
                        F.lit(1).cast("long").alias("version"))
    return used.unionByName(produced)


EVAL_INPUTS_SQL = X.with_ctes(X.ARTIFACT_VERSIONS_SQL, body="""
, latest AS (SELECT name, max(version) AS version FROM artifact_versions GROUP BY name)
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'uses' AS direction, 'dataset-' || CAST(o_custkey AS VARCHAR) AS name,
       l.version
FROM orders LEFT JOIN latest l ON l.name = 'dataset-' || CAST(o_custkey AS VARCHAR)
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'produces', 'eval-results-' || CAST(o_orderkey AS VARCHAR), CAST(1 AS BIGINT)
FROM orders
""")


def artifact_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact metadata as key/value rows."""
    a = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("dataset-"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").alias("version"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    return L.metadata_kv(a, ["status", "priority", "total"], ["name", "version"],
                         {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"),
                          "total": F.round("o_totalprice", 2)})


ARTIFACT_METADATA_SQL = """
SELECT 'dataset-' || CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS version, 'status' AS key,
       o_orderstatus AS value FROM orders WHERE o_orderstatus IS NOT NULL
UNION ALL
SELECT 'dataset-' || CAST(o_custkey AS VARCHAR), o_orderkey, 'priority', o_orderpriority
FROM orders WHERE o_orderpriority IS NOT NULL
UNION ALL
SELECT 'dataset-' || CAST(o_custkey AS VARCHAR), o_orderkey, 'total', CAST(round(o_totalprice, 2) AS VARCHAR)
FROM orders WHERE o_totalprice IS NOT NULL
"""


def run_metrics_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last / min / max of each metric per run."""
    return L.metric_summary(X.run_metrics(spark, sf_dir))


RUN_METRICS_LAST_SQL = X.with_ctes(X.RUN_METRICS_SQL, body="""
SELECT run, metric, arg_max(value, step) AS last_value, min(value) AS min_value, max(value) AS max_value,
       count(*) AS n_steps, max(step) AS last_step
FROM run_metrics GROUP BY run, metric
""")


def file_manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A4 + G12: documents written as a directory artifact (one folder
    per language split) in the shared folder, read back as files, counted
    per split; the counts are written beside it as a JSON record."""
    root = shared_dir(spark, f"artifacts/raw-docs-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    CAT.write_text_artifact(docs, "text", "lang", f"{root}/files")
    counts = CAT.file_manifest(spark, f"{root}/files").groupBy("split").agg(
        F.sum("n_bytes").alias("n_bytes"))
    CAT.write_record(counts, f"{root}/manifest_counts")
    return spark.read.schema("split string, n_bytes long").json(f"{root}/manifest_counts")


FILE_MANIFEST_COUNTS_SQL = """
SELECT lang AS split, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang
"""


def conversation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: history segment, length (system message first) and size per message."""
    c = read_table(spark, sf_dir, "conversations")
    return CV.history_coordinates(c).select("conv_id", "turn", "segment", "history_len", "history_chars")


CONVERSATION_HISTORY_SQL = """
, s AS (
  SELECT conv_id, turn, role, text,
    sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment
  FROM conversations)
SELECT conv_id, turn, CAST(segment AS BIGINT) AS segment,
  CAST(1 + sum(CASE WHEN role <> 'system' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS history_len,
  CAST(sum(CASE WHEN role <> 'system' THEN length(text) ELSE 0 END) OVER w AS BIGINT) AS history_chars
FROM s
WINDOW w AS (PARTITION BY conv_id, segment ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""".lstrip().lstrip(",").lstrip()
CONVERSATION_HISTORY_SQL = "WITH " + CONVERSATION_HISTORY_SQL

PLACEHOLDER_ANSWER = "This is a placeholder answer."


def _constant_model(questions: pd.Series) -> pd.Series:
    return pd.Series([PLACEHOLDER_ANSWER] * len(questions), index=questions.index)


def predict_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + C2: a user predictor (here the constant one) over every request,
    scored by trimmed exact match against the recorded answer."""
    r = X.requests(spark, sf_dir)
    p = predict_with(r, _constant_model, "user_message", "prediction")
    sc = S.get_scorer("exact_match_trim").column(p, {"reference": "output", "output": "prediction"})
    return p.select("request_id", "prediction", sc.getField("match").alias("exact_match"))


PREDICT_CONSTANT_SQL = X.with_ctes(X.REQUESTS_SQL, body=f"""
SELECT request_id, '{PLACEHOLDER_ANSWER}' AS prediction,
  lower(regexp_replace(output, '^\\s+|\\s+$', '', 'g')) = lower('{PLACEHOLDER_ANSWER}') AS exact_match
FROM requests
""")


def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message to many rows, one per line of its whole text."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


EXPLODE_LINES_SQL = """
SELECT conv_id, turn, CAST(line_no - 1 AS INTEGER) AS line_no, line
FROM conversations, unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(line, line_no)
"""


def _published_chain(spark: SparkSession, sf_dir: str) -> str:
    """Raw documents, their distinct texts and counts per language, each a published version made by a step that
    records its edges; then a rerun on the same data, and both steps again after the raw data was extended."""
    root = shared_dir(spark, f"catalog-{uuid.uuid4().hex}")
    cols = ["lang", "source", "text"]
    raw = read_table(spark, sf_dir, "documents").select(*cols)
    items = read_table(spark, sf_dir, "benchmark").select(F.lit("en").alias("lang"), F.lit("benchmark").alias("source"),
                                                          "text")

    def distinct_texts(d):
        return d.filter(F.col("text").rlike(r"\S")).dropDuplicates(cols)

    CAT.publish(raw, "raw", root)
    for i, latest in enumerate((raw, raw, raw.unionByName(items))):
        if i == 2:
            CAT.publish(latest, "raw", root)
        CAT.run_step(spark, root, f"prepare-{i}", [("raw", "latest")], "texts", distinct_texts)
        CAT.run_step(spark, root, f"count-{i}", [("texts", "latest"), ("raw", "latest")], "languages", _per_language)
    return root


def _per_language(texts: DataFrame, raw: DataFrame) -> DataFrame:
    """Texts and raw rows per language."""
    n = raw.groupBy("lang").agg(F.count(F.lit(1)).alias("n_raw"))
    return texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n_texts")).join(n, "lang")


_CHAIN_SQL = r"""
raw_1 AS (SELECT lang, source, text FROM documents),
raw_2 AS (SELECT * FROM raw_1 UNION ALL SELECT 'en', 'benchmark', text FROM benchmark),
texts_1 AS (SELECT DISTINCT * FROM raw_1 WHERE regexp_matches(text, '\S')),
texts_2 AS (SELECT DISTINCT * FROM raw_2 WHERE regexp_matches(text, '\S')),
languages_1 AS (SELECT lang, count(*) AS n FROM texts_1 WHERE lang IS NOT NULL GROUP BY lang),
languages_2 AS (SELECT lang, count(*) AS n FROM texts_2 WHERE lang IS NOT NULL GROUP BY lang),
versions AS (
  SELECT 'raw' AS name, 1 AS version, (SELECT count(*) FROM raw_1) AS n_rows
  UNION ALL SELECT 'raw', 2, (SELECT count(*) FROM raw_2)
  UNION ALL SELECT 'texts', 1, (SELECT count(*) FROM texts_1)
  UNION ALL SELECT 'texts', 2, (SELECT count(*) FROM texts_2)
  UNION ALL SELECT 'languages', 1, (SELECT count(*) FROM languages_1)
  UNION ALL SELECT 'languages', 2, (SELECT count(*) FROM languages_2))
"""


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + A5: versions published by a chain of steps; unchanged content makes no new version."""
    v = CAT.read_versions(spark, _published_chain(spark, sf_dir))
    return v.select("name", "version", "n_rows")


PUBLISH_VERSIONS_SQL = X.with_ctes(_CHAIN_SQL, body="""
SELECT name, CAST(version AS BIGINT) AS version, n_rows FROM versions
""")


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that the steps recorded, as artifact versions with their sizes."""
    root = _published_chain(spark, sf_dir)
    v = CAT.read_versions(spark, root)
    size = v.select(F.concat("name", F.lit(":"), F.col("version").cast("string")).alias("node"), "n_rows")
    return (CAT.artifact_edges(spark, root)
            .join(size.select(F.col("node").alias("child"), F.col("n_rows").alias("child_rows")), "child")
            .join(size.select(F.col("node").alias("parent"), F.col("n_rows").alias("parent_rows")), "parent")
            .select("run_id", "child", "parent", "child_rows", "parent_rows"))


LINEAGE_EDGES_SQL = X.with_ctes(_CHAIN_SQL, body="""
, e(run_id, cname, cv, pname, pv) AS (
  SELECT 'prepare-' || i, 'texts', v, 'raw', v FROM (VALUES (0, 1), (1, 1), (2, 2)) r(i, v)
  UNION ALL SELECT 'count-' || i, 'languages', v, 'texts', v FROM (VALUES (0, 1), (1, 1), (2, 2)) r(i, v)
  UNION ALL SELECT 'count-' || i, 'languages', v, 'raw', v FROM (VALUES (0, 1), (1, 1), (2, 2)) r(i, v))
SELECT run_id, cname || ':' || cv AS child, pname || ':' || pv AS parent, c.n_rows AS child_rows,
       p.n_rows AS parent_rows
FROM e JOIN versions c ON c.name = cname AND c.version = cv JOIN versions p ON p.name = pname AND p.version = pv
""")


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: multiset difference between two published versions: all documents' (lang, source, size class), then
    those of the labelled documents and the benchmark items."""
    root = shared_dir(spark, f"catalog-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    size = F.floor(F.char_length("text") / 1000).cast("long").alias("size")
    labelled = docs.join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    items = read_table(spark, sf_dir, "benchmark").select(F.lit(None).cast("string").alias("lang"),
                                                          F.lit("benchmark").alias("source"), size)
    CAT.publish(docs.select("lang", "source", size), "sizes", root)
    CAT.publish(labelled.select("lang", "source", size).unionByName(items), "sizes", root)
    return CAT.version_diff(spark, root, "sizes", 1, 2)


VERSION_DIFF_SQL = """
WITH one AS (SELECT lang, source, length(text) // 1000 AS size FROM documents),
two AS (
  SELECT lang, source, length(text) // 1000 AS size FROM documents SEMI JOIN labels USING (doc_id)
  UNION ALL SELECT NULL, 'benchmark', length(text) // 1000 FROM benchmark),
more AS (SELECT * FROM two EXCEPT ALL SELECT * FROM one),
less AS (SELECT * FROM one EXCEPT ALL SELECT * FROM two)
SELECT lang, source, size, 'added' AS change, count(*) AS n_copies FROM more GROUP BY ALL
UNION ALL SELECT lang, source, size, 'removed', count(*) FROM less GROUP BY ALL
"""
