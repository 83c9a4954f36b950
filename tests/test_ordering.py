"""Distributed numbering and running sums equal their one-task windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lumeval.operators.ordering import global_index, running_total


def test_global_index_across_blocks(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 + 3).alias("seq"))
    got = global_index(df, "seq", "i", block=64)
    exp = df.withColumn("i", F.row_number().over(Window.orderBy("seq")) - 1)
    assert sorted(got.collect()) == sorted(exp.collect())


def test_running_total_across_blocks(spark):
    rows = [(k, t, (t * 13 + k) % 5) for k in range(3) for t in range(300)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = running_total(df, ["k"], "t", {"s": F.col("v")}, block=16)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("s", F.sum("v").over(w))
    assert sorted(got.collect()) == sorted(exp.select(*got.columns).collect())


def test_assign_ids_widen_past_999(spark):
    from lumeval.operators.curate import assign_ids
    df = spark.range(0, 1200).select(F.col("id").alias("seq"), F.lit("s").alias("scenario"))
    ids = {r["seq"]: r["id"] for r in assign_ids(df).collect()}
    assert ids[0] == "synthetic_s_000" and ids[1199] == "synthetic_s_1199"


def test_history_coordinates_long_conversation(spark):
    from lumeval.operators.conversations import history_coordinates
    rows = []
    for t in range(700):
        role = "system" if t in (0, 250, 251, 600) else ("user" if t % 2 else "assistant")
        rows.append((7, t, role, "x" * (t % 13)))
    rows += [(8, t, "user", "abc") for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["segment"], r["history_len"], r["history_chars"])
           for r in history_coordinates(df, block=32).collect()}
    exp, state = {}, {}
    for c, t, role, text in sorted(rows):
        seg, n, ch = state.get(c, (0, 0, 0))
        if role == "system":
            seg, n, ch = seg + 1, 0, 0
        else:
            n, ch = n + 1, ch + len(text)
        state[c] = (seg, n, ch)
        exp[(c, t)] = (seg, n + 1, ch)
    assert got == exp
