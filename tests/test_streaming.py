"""The guardrail stream gives the same rows as the batch guard."""

from conftest import SF_SMALL
from lumeval.operators.guardrails import flatten_guard, guard
from lumeval.sources import fixtures as X
from lumeval.streaming.guardrail_stream import guard_stream, run_to_sink


def test_stream_equals_batch(spark, scratch):
    req = X.requests(spark, SF_SMALL)
    req.repartition(4).write.parquet(f"{scratch}/requests")
    q = run_to_sink(guard_stream(spark, f"{scratch}/requests", monitor_pct=10.0, max_files_per_trigger=1),
                    f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{scratch}/out")
    exp = flatten_guard(guard(req, monitor_pct=10.0))
    assert got.count() == exp.count()
    assert got.select(*exp.columns).exceptAll(exp).isEmpty()
    assert exp.exceptAll(got.select(*exp.columns)).isEmpty()


def test_blocked_rows_have_no_later_scores(spark):
    g = guard(X.requests(spark, SF_SMALL))
    blocked_input = g.filter("block_reason = 'input_safety'")
    assert blocked_input.count() > 0
    assert blocked_input.filter("scores.toxicity IS NOT NULL OR scores.policy IS NOT NULL "
                                "OR scores.quality IS NOT NULL").isEmpty()
    assert g.filter("blocked AND scores.policy IS NOT NULL").isEmpty()


def test_stream_restart_processes_only_new_files(spark, scratch):
    req = X.requests(spark, SF_SMALL)
    first, second = req.randomSplit([0.5, 0.5], seed=7)
    first.write.parquet(f"{scratch}/in/part=1")
    q = run_to_sink(guard_stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(300)
    n1 = spark.read.parquet(f"{scratch}/out").count()
    second.write.parquet(f"{scratch}/in/part=2")
    q = run_to_sink(guard_stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(300)
    out = spark.read.parquet(f"{scratch}/out")
    assert n1 == first.count()
    assert out.count() == req.count()
    assert out.select("request_id").distinct().count() == req.count()
