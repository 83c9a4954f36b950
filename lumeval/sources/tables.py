"""Table scans (A1): parquet tables of a data folder, with schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail fast when a dataset lacks a column or has another type.

    Extra columns are allowed and kept; required ones are cast-free checked
    by name and type (nullable differences are ignored).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"column {f.name}: {have[f.name].simpleString()} "
                            f"!= {f.dataType.simpleString()}")
    if problems:
        raise ValueError("dataset does not match its schema: " + "; ".join(problems))
    return df


def load_dataset(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet") -> DataFrame:
    """Typed dataset load (A1).  JSON/CSV are read with the declared schema
    (no inference pass); parquet is read with its own schema, then checked."""
    reader = spark.read.format(fmt)
    if fmt in ("json", "csv"):
        reader = reader.schema(schema)
    return check_schema(reader.load(path), schema)


# Dataset schemas used by the evaluation and curation jobs.
QA_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("question", T.StringType()),
    T.StructField("context", T.StringType()), T.StructField("reference", T.StringType()),
])
RAG_SCHEMA = T.StructType(QA_SCHEMA.fields + [
    T.StructField("ground_truth_context", T.ArrayType(T.StringType())),
])
EXAMPLE_SCHEMA = T.StructType([
    T.StructField("question", T.StringType()), T.StructField("context", T.StringType()),
    T.StructField("reference_answer", T.StringType()), T.StructField("scenario", T.StringType()),
])
