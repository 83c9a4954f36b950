"""Rounds without broadcasts by the size of compressed files; retrieval by tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumeval.operators import retrieval
from lumeval.operators.lineage import ancestors, descendants
from lumeval.session import conf_set


def _plans(spark):
    """Plans of the last queries, by number: older ones are forgotten."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {runs.apply(i).executionId(): runs.apply(i).physicalPlanDescription() for i in range(runs.size())}


@pytest.mark.parametrize("walk", [ancestors, descendants])
def test_lineage_broadcasts_no_small_file_of_many_rows(spark, walk):
    # three levels; the written tables take about 0.3 MB, their rows over 3 MB
    edges = (spark.range(100_000).select((F.col("id") + 1000).alias("child"), (F.col("id") % 90 + 10).alias("parent"))
             .unionByName(spark.range(10, 100).select(F.col("id").alias("child"), (F.col("id") % 5).alias("parent"))))
    before = max(_plans(spark), default=-1)
    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "600k"}):
        n = walk(edges).groupBy("depth").count().orderBy("depth").collect()
    assert [tuple(r) for r in n] == [(1, 100_090), (2, 100_000)]
    plans = [p for k, p in sorted(_plans(spark).items()) if k > before]
    first = next(p for p in plans if "Join" in p)
    assert "BroadcastHashJoin" not in first


def test_cells_look_at_few_cosines(monkeypatch):
    """Top k by tiles equals a full sort; after the first tile only what is above the k-th best so far is sorted."""
    g = np.random.default_rng(8)
    c = g.standard_normal((5000, 8))
    c[3000:3010] = c[:10]  # equal vectors: the first position wins
    c /= np.linalg.norm(c, axis=1)[:, None]
    ids = np.concatenate([np.arange(4990), np.arange(10)])  # an id may come twice
    seen, best = [], retrieval._best
    monkeypatch.setattr(retrieval, "_best", lambda *a: (seen.append(len(a[1])), best(*a))[1])
    for own in ((), (ids[:1100], ids)):
        q, at, score = retrieval._tile_topk(c[:1100], c, 3, *own)
        s = c[:1100] @ c.T
        if own:
            s[ids[:1100, None] == ids[None]] = -np.inf
        s = np.round(s, 12)
        want = np.argsort(-s, axis=1, kind="stable")[:, :3]
        assert np.array_equal(at.reshape(-1, 3), want) and np.array_equal(q, np.repeat(np.arange(1100), 3))
        assert np.allclose(score, np.take_along_axis(s, want, 1).ravel())
    assert sum(seen) < 2 * 1100 * 60, sum(seen)
    assert all(len(x) == 0 for x in retrieval._tile_topk(c[:5], c[:0], 2))
