"""Size-checked broadcast and the parallelism guard."""

from pyspark.sql import functions as F

from lumeval.operators.joins import broadcast_if_small, ensure_parallelism


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no automatic broadcast
    try:
        big = spark.range(0, 5000).select(F.col("id").alias("k"))
        small = spark.range(0, 10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        assert "BroadcastHashJoin" in _plan(big.join(broadcast_if_small(small, 100), "k"))
        large = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        plan = _plan(big.join(broadcast_if_small(large, 100), "k"))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parallelism_guard(spark):
    one = spark.range(0, 100).coalesce(1)
    spread = ensure_parallelism(one, "id")
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, numPartitions=spark.sparkContext.defaultParallelism * 8)
    assert ensure_parallelism(many) is many
