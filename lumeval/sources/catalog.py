"""Versioned datasets, artifacts and file manifests in a shared folder
(A2, A3, A4, A5, J1).

Layout under ``root`` (a shared, distributed path):

* ``datasets/name=<n>/version=<v>/`` - the rows of each published version
* ``_versions/`` - one row per (name, version): digest, row count, time
* ``_edges/`` - lineage edges (run, direction, name, version)

Versions are append-only.  A publish whose content digest equals the
latest version's is skipped, as the tracking service does.  The digest is
an order-insensitive aggregate (sum of 64-bit row hashes plus the count),
computed on the executors.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("published_at", T.StringType())])
EDGES_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("direction", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType())])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False if it is there already."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(p)


def content_digest(df: DataFrame) -> tuple[str, int]:
    """Order-insensitive content digest and row count (one aggregate).

    A row is hashed as JSON with its column names and nulls; the schema's own
    hash is part of the digest, so a renamed or retyped column changes it."""
    cols = sorted(df.columns)
    h = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"}))
    r = df.agg(F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).alias("s"),
               F.count(F.lit(1)).alias("n")).first()
    kinds = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols)
    return f"{hashlib.md5(kinds.encode()).hexdigest()[:16]}:{r['s']}:{r['n']}", int(r["n"])


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_versions"
    if _exists(spark, path):
        return spark.read.schema(VERSIONS_SCHEMA).parquet(path)
    return spark.createDataFrame([], VERSIONS_SCHEMA)


def publish(df: DataFrame, name: str, root: str, published_at: str | None = None) -> int:
    """A2/A5: write ``df`` as the next version of ``name``; returns the
    version (the existing latest one when the content is unchanged)."""
    spark = df.sparkSession
    digest, n = content_digest(df)
    versions = read_versions(spark, root).filter(F.col("name") == name)
    last = versions.orderBy(F.col("version").desc()).select("version", "digest").first()
    if last is not None and last["digest"] == digest:
        return int(last["version"])
    version = 1 if last is None else int(last["version"]) + 1
    while not _claim(spark, f"{root}/_claims/name={name}/version={version}"):
        version += 1  # taken by another publisher
    df.write.mode("errorifexists").parquet(f"{root}/datasets/name={name}/version={version}")
    stamp = published_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    spark.createDataFrame([(name, version, digest, n, stamp)], VERSIONS_SCHEMA) \
        .write.mode("append").parquet(f"{root}/_versions")
    return version


def resolve_version(spark: SparkSession, root: str, name: str, version: int | str = "latest") -> int:
    """The number of a version (``latest``: the highest that was published)."""
    if version == "latest":
        version = read_versions(spark, root).filter(F.col("name") == name).agg(F.max("version")).first()[0]
        if version is None:
            raise KeyError(f"no published version of {name!r}")
    return int(version)


def read_version(spark: SparkSession, root: str, name: str, version: int | str = "latest") -> DataFrame:
    """Read one published version (``latest`` resolves to the highest)."""
    return spark.read.parquet(f"{root}/datasets/name={name}/version={resolve_version(spark, root, name, version)}")


def log_edge(spark: SparkSession, root: str, run_id: str, direction: str, name: str, version: int) -> None:
    """Append a ``uses`` / ``produces`` edge."""
    log_edges(spark, root, [(run_id, direction, name, int(version))])


def log_edges(spark: SparkSession, root: str, edges: DataFrame | Iterable[tuple]) -> None:
    """J1 in bulk: append a frame, or rows, of (run_id, direction, name, version) in one job."""
    if not isinstance(edges, DataFrame):
        edges = spark.createDataFrame(list(edges), EDGES_SCHEMA)
    known = F.col("direction").isin("uses", "produces")
    checked = F.when(known, F.col("direction")).otherwise(
        F.raise_error(F.concat(F.lit("unknown direction: "), F.coalesce("direction", F.lit("null")))))
    edges.select("run_id", checked.alias("direction"), "name", F.col("version").cast("long").alias("version")) \
        .write.mode("append").parquet(f"{root}/_edges")


def read_edges(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_edges"
    if _exists(spark, path):
        return spark.read.schema(EDGES_SCHEMA).parquet(path)
    return spark.createDataFrame([], EDGES_SCHEMA)


def artifact_edges(spark: SparkSession, root: str) -> DataFrame:
    """J1 -> J4: (run_id, child, parent) of every run: what it produced and each version that it used."""
    edges = read_edges(spark, root)
    label = F.concat("name", F.lit(":"), F.col("version").cast("string"))
    made, used = (edges.filter(F.col("direction") == d).select("run_id", label.alias(c))
                  for d, c in (("produces", "child"), ("uses", "parent")))
    return made.join(used, "run_id").distinct()


def run_step(spark: SparkSession, root: str, run_id: str, uses: Sequence[tuple[str, int | str]], produces: str,
             build: Callable[..., DataFrame], published_at: str | None = None) -> int:
    """A2/A5 with J1: one pipeline step.

    ``build`` gets a frame per (name, version) of ``uses``, each resolved once, so that ``latest`` names the same version in
    the rows and in the record; its result is published and all edges of the run are written in one
    append after it, so a failed step leaves none.  Unchanged content records the version that holds it.
    """
    resolved = [(name, resolve_version(spark, root, name, version)) for name, version in uses]
    version = publish(build(*[read_version(spark, root, n, v) for n, v in resolved]), produces, root, published_at)
    log_edges(spark, root, [(run_id, "uses", n, v) for n, v in resolved] + [(run_id, "produces", produces, version)])
    return version


def version_diff(spark: SparkSession, root: str, name: str, old: int | str, new: int | str = "latest") -> DataFrame:
    """Multiset difference of two versions: each distinct row that one holds more often than the other, ``change`` (added
    or removed) and ``n_copies``, by how many.

    One aggregate over both, so a row that makes up a third of a version is added up before the shuffle; nulls equal
    nulls; a column that only one version has is null in the other.
    """
    one, two = (read_version(spark, root, name, v) for v in (old, new))
    both = one.withColumn("_sign", F.lit(-1)).unionByName(two.withColumn("_sign", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c != "_sign"]
    n = both.groupBy(*cols).agg(F.sum("_sign").alias("_n")).filter(F.col("_n") != 0)
    return n.select(*cols, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"),
                    F.abs("_n").alias("n_copies"))


def write_text_artifact(df: DataFrame, text_col: str, split_col: str, path: str) -> None:
    """Write rows as text files in ``split=<value>`` folders (a directory artifact)."""
    df.select(F.col(text_col).alias("value"), F.col(split_col).alias("split")) \
        .write.mode("overwrite").partitionBy("split").text(path)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A3: one row per file under ``path`` (recursive): path, split (the first
    folder below ``path``, as ``train`` or ``split=train``; empty for files
    in ``path`` itself), size and sha-256 of the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(fs_path).toUri().getPath().rstrip("/") + "/"
    below = F.substring_index("path", base, -1)
    return files.select(
        "path", F.regexp_extract(below, r"^(?:split=)?([^/]+)/", 1).alias("split"),
        F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def write_record(df: DataFrame, path: str) -> None:
    """A4: write a result record as JSON next to an artifact."""
    df.coalesce(1).write.mode("overwrite").json(path)
