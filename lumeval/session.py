"""Spark session settings shared by the library, the tests and the bench.

Cluster jobs get their session from the platform; ``get_session`` only fills
in settings that are still unset, so a cluster configuration always wins.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for correctness (UTC timestamps, ANSI arithmetic) and
# for scale (AQE re-plans shuffles, coalesces small partitions, splits skew).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # iterative operators checkpoint every round: remove the files once the
    # checkpointed frames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Bytes of an Arrow batch between Spark and its Python workers.  Spark's own limit of 64 MB lets each task hold whole
#: partitions outside the JVM's heap, in buffers that grow by doubling.
BATCH_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: For one written table: its shuffle files go as soon as it stands, not when the driver collects its garbage.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def get_session(master: str | None = None, app_name: str = "lumeval",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    asked = dict(extra_conf or {})
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:  # a run of our own: nothing else configures it
        builder = builder.master(master)
        asked = {**DEFAULT_CONF, **asked}
    for k, v in asked.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k not in asked and not given.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only when it is unset -- local tests -- a fresh scratch
    folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = os.environ.get("LUMEVAL_SCRATCH", "/tmp")
    local = tempfile.mkdtemp(prefix="lumeval-ckpt-", dir=base)
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches for this session's operators; a cluster configuration wins."""
    given = spark.sparkContext.getConf()
    for k, v in BATCH_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)


def measured_joins(spark: SparkSession) -> dict[str, str]:
    """Settings under which a join is broadcast by the rows that its shuffle measured alone.

    A written table's size is that of its compressed files, of which a few MB may hold millions of rows, and a broadcast
    is built on the driver."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    return {planned: "-1", measured: spark.conf.get(measured, None) or spark.conf.get(planned)}


@contextlib.contextmanager
def conf_set(spark: SparkSession, conf: dict[str, str]):
    """``conf`` for the queries run within, the old values after them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


class Rounds:
    """Tables of an iterative operator, written to the shared folder as compressed Parquet.

    A reliable checkpoint computes its frame twice and writes rows uncompressed; ``save`` computes it
    once, with joins planned by measured sizes.  ``drop`` removes tables that nothing reads any more; their plans must not be used again.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.root, self.paths = spark, f"{shared_dir(spark, name)}-{uuid.uuid4().hex}", {}

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        with conf_set(self.spark, WRITE_CONF | measured_joins(self.spark)):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path  # holds the frame, so that its id stays its own
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths[id(frame)][1])
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
