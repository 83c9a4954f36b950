"""Connected components in few tables."""

from __future__ import annotations

import numpy as np
import pytest

from lumeval.llm import common


def components(edges):
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x
    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            low[b] = a
    return sorted((x, root(x)) for x in low)


def graphs():
    g = np.random.default_rng(4)
    path = g.permutation(300).tolist()
    yield [(a, b) for a, b in zip(path, path[1:])]
    yield [(7, int(x)) for x in g.permutation(400)] + [(int(x), 5000) for x in range(1000, 1100)]  # two hubs
    yield [(int(a), int(b)) for a, b in g.integers(-60, 60, (70, 2))] + [(None, 3), (4, None), (9, 9), (1, 2), (2, 1)]
    # two descending chains that meet at their tops
    yield [(k, k - 2) for k in range(2, 120)] + [(119, 118)]
    yield []


@pytest.mark.parametrize("run, edges", [(1 << 20, 1 << 13), (5, 8)])
def test_components_equal_search(spark, monkeypatch, run, edges):
    # Workers import the module anew: its small runs come from many small partitions there.
    monkeypatch.setattr(common, "RUN", run, raising=False)
    monkeypatch.setattr(common, "EDGES", edges, raising=False)
    for rows in graphs():
        df = spark.createDataFrame(rows, "u long, v long").repartition(1 + len(rows) // (7 * run))
        got = common.connected(spark, common.Workspace(spark, "test_cc"), df)
        assert sorted(tuple(r) for r in got.collect()) == components(rows)


def test_components_take_few_tables(spark, monkeypatch):
    made, save = [], common.Workspace.save
    monkeypatch.setattr(common.Workspace, "save", lambda ws, df, name, *a: made.append(save(ws, df, name, *a)) or made[-1])
    path = np.random.default_rng(4).permutation(300).tolist()
    df = spark.createDataFrame(list(zip(path, path[1:])), "u long, v long").repartition(4)
    common.connected(spark, common.Workspace(spark, "test_cc"), df).collect()
    assert len(made) <= 12


def test_contraction_keeps_components():
    g = np.random.default_rng(2)
    for n in (1, 5, 60, 400):
        u, v = g.integers(-200, 200, (2, n))
        got = common.smallest_reached(u, v)
        want = [(x, low) for x, low in components(zip(u.tolist(), v.tolist())) if x != low]
        assert sorted(zip(got[0].tolist(), got[1].tolist())) == want
    assert all(len(x) == 0 for x in common.smallest_reached(np.zeros(0, np.int64), np.zeros(0, np.int64)))
