"""Dataset versions, lineage edges and the ancestor graph."""

from pyspark.sql import functions as F

from lumeval.operators.lineage import ancestors, latest_versions
from lumeval.sources import catalog as C


def test_publish_versions_and_skip_unchanged(spark, scratch):
    root = f"{scratch}/catalog"
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "id long, q string")
    assert C.publish(v1, "qa", root, "t1") == 1
    assert C.publish(v1.orderBy(F.desc("id")), "qa", root, "t2") == 1  # same content
    v2 = v1.unionByName(spark.createDataFrame([(3, "c")], "id long, q string"))
    assert C.publish(v2, "qa", root, "t3") == 2
    assert C.read_version(spark, root, "qa", "latest").count() == 3
    assert C.read_version(spark, root, "qa", 1).count() == 2
    C.log_edge(spark, root, "run-1", "uses", "qa", 2)
    C.log_edge(spark, root, "run-1", "produces", "model", 1)
    assert C.read_edges(spark, root).count() == 2


def test_four_step_chain_ancestors(spark):
    # raw -> processed -> classifier -> eval; processed is also an input of eval
    edges = spark.createDataFrame([("processed", "raw"), ("classifier", "processed"),
                                   ("eval", "classifier"), ("eval", "processed")],
                                  "child string, parent string")
    got = {(r["node"], r["ancestor"]): r["depth"] for r in ancestors(edges).collect()}
    assert got == {("processed", "raw"): 1, ("classifier", "processed"): 1, ("classifier", "raw"): 2,
                   ("eval", "classifier"): 1, ("eval", "processed"): 1, ("eval", "raw"): 2}


def test_latest_versions(spark):
    v = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "name string, version long")
    got = {r["name"]: (r["latest_version"], r["n_versions"]) for r in latest_versions(v).collect()}
    assert got == {"a": (3, 2), "b": (2, 1)}


def test_file_manifest(spark, scratch):
    df = spark.createDataFrame([("x" * 10, "train"), ("yy", "train"), ("zzz", "test")], "text string, split string")
    C.write_text_artifact(df, "text", "split", f"{scratch}/art")
    m = C.file_manifest(spark, f"{scratch}/art").groupBy("split").agg(F.sum("n_bytes").alias("b"))
    assert {r["split"]: r["b"] for r in m.collect()} == {"train": 14, "test": 4}


def test_file_manifest_of_plain_folders(spark, scratch):
    import os
    for name, text in (("train/img_0.txt", "abc"), ("test/img_1.txt", "de"), ("top.txt", "f")):
        os.makedirs(os.path.dirname(f"{scratch}/plain/{name}"), exist_ok=True)
        with open(f"{scratch}/plain/{name}", "w") as f:
            f.write(text)
    m = C.file_manifest(spark, f"{scratch}/plain").collect()
    assert {r["split"]: r["n_bytes"] for r in m} == {"train": 3, "test": 2, "": 1}


def test_digest_sees_nulls_and_names(spark):
    a = spark.createDataFrame([(None, "x")], "p string, q string")
    b = spark.createDataFrame([("x", None)], "p string, q string")
    assert len({C.content_digest(d)[0] for d in (a, b, a.withColumnsRenamed({"p": "r"}))}) == 3


def test_a_taken_version_is_left_alone(spark, scratch):
    root = f"{scratch}/taken"
    assert C._claim(spark, f"{root}/_claims/name=qa/version=1")  # another publisher at work
    assert C.publish(spark.range(2), "qa", root, "t") == 2


def test_edges_in_bulk(spark, scratch):
    import pytest
    C.log_edges(spark, f"{scratch}/bulk", [("r", "uses", "a", 1), ("r", "produces", "b", 1)])
    assert C.read_edges(spark, f"{scratch}/bulk").count() == 2
    with pytest.raises(Exception):
        C.log_edge(spark, f"{scratch}/bulk", "r", "eats", "a", 1)


def test_pointer_doubling_equals_breadth_first(spark):
    from lumeval.operators.lineage import _dag_ancestors, _forest_ancestors
    rows = [(k, k // 2) for k in range(1, 300)] + [(1000 + i, 1000 + i - 1) for i in range(1, 40)]
    e = spark.createDataFrame(rows, "_c long, _p long")
    a = sorted(_forest_ancestors(e).collect())
    b = sorted(_dag_ancestors(e).collect())
    assert a == b and len(a) > 0


def test_ancestors_of_requested_nodes(spark):
    from lumeval.operators.lineage import ancestors, ancestors_of
    rows = [(k, k // 2) for k in range(1, 200)]
    e = spark.createDataFrame(rows, "child long, parent long")
    want = spark.createDataFrame([(150,), (7,)], "node long")
    got = sorted(ancestors_of(e, want).collect())
    full = sorted(r for r in ancestors(e).collect() if r["node"] in (150, 7))
    assert got == full


def test_version_diff_is_a_multiset_difference(spark, scratch):
    root = f"{scratch}/catalog"
    one = [("a", 1), ("a", 1), ("a", 1), (None, 2), ("b", None), ("c", 3)]
    two = [("a", 1), (None, 2), (None, 2), ("d", 4), ("c", 3), ("c", 3)]
    for rows in (one, two):
        C.publish(spark.createDataFrame(rows, "k string, v long"), "t", root)
    got = {(r.k, r.v): (r.change, r.n_copies) for r in C.version_diff(spark, root, "t", 1).collect()}
    assert got == {("a", 1): ("removed", 2), (None, 2): ("added", 1), ("b", None): ("removed", 1), ("c", 3): ("added", 1),
                   ("d", 4): ("added", 1)}
    assert C.version_diff(spark, root, "t", 2, 2).isEmpty()
    C.publish(spark.createDataFrame([("a", 1, True)], "k string, v long, w boolean"), "t", root)
    assert C.version_diff(spark, root, "t", 2, "latest").filter("w").count() == 1


def test_run_step_records_its_edges(spark, scratch):
    import pytest
    root = f"{scratch}/catalog"
    C.publish(spark.range(5), "raw", root)
    double = lambda d: d.select((F.col("id") * 2).alias("id"))
    assert C.run_step(spark, root, "r1", [("raw", "latest")], "even", double) == 1
    assert C.run_step(spark, root, "r2", [("raw", 1)], "even", double) == 1  # same content
    C.publish(spark.range(6), "raw", root)
    assert C.run_step(spark, root, "r3", [("raw", "latest"), ("even", 1)], "even", lambda a, b: double(a)) == 2
    with pytest.raises(ZeroDivisionError):
        C.run_step(spark, root, "r4", [("raw", 1)], "bad", lambda d: 1 / 0)
    with pytest.raises(KeyError):
        C.run_step(spark, root, "r5", [("none", "latest")], "bad", double)
    edges = C.artifact_edges(spark, root)
    assert sorted(map(tuple, edges.collect())) == [("r1", "even:1", "raw:1"), ("r2", "even:1", "raw:1"),
                                                   ("r3", "even:2", "even:1"), ("r3", "even:2", "raw:2")]
    up = {(r.node, r.ancestor, r.depth) for r in ancestors(edges).collect()}
    assert ("even:2", "raw:1", 2) in up and ("even:2", "raw:2", 1) in up
