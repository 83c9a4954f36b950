"""Lineage records and graph queries.

Edges are a plain ``(child, parent)`` table.  All ancestors with their
minimum depth come from a loop of joins, each round written once to the
shared checkpoint folder so the plan stays short and a lost executor only
recomputes one round: pointer doubling when every node has one parent
(rounds = log2 of the depth), breadth-first frontier rounds otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Rounds
from .joins import broadcast_if_small


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``(node, ancestor, depth)`` for every ancestor of every node,
    depth = shortest path length.  Cycles end: a pair is found once."""
    rounds = Rounds(edges.sparkSession, "lineage")
    every = rounds.save(edges.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).distinct())
    # an edge to itself adds one pair and no path that is not there without it
    own = every.filter(F.col("_c").eqNullSafe(F.col("_p")))
    e = every.filter(~F.col("_c").eqNullSafe(F.col("_p")))
    forest = e.groupBy("_c").count().filter(F.col("count") > 1).isEmpty()
    found = _forest_ancestors(e, rounds) if forest else _dag_ancestors(e, rounds)
    own = own.select(F.col("_c").alias("node"), F.col("_p").alias("ancestor"), F.lit(1).alias("depth"))
    # no broadcast by the size of a compressed file: planned where the frame is read
    turns = found.filter("node = ancestor").join(own.hint("merge"), ["node", "ancestor"], "left_anti")
    return found.filter("node <> ancestor").unionByName(own).unionByName(turns)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _forest_ancestors(e: DataFrame, rounds: Rounds | None = None) -> DataFrame:
    """One parent per node, no edge to itself: pointer doubling, ``log2(depth) + 1`` rounds.

    With ``A`` = all ancestors within distance ``span`` and ``exact`` = the
    ancestor at distance exactly ``span``, the ancestors at distances
    ``span+1 .. 2*span`` of ``x`` are those of ``exact(x)`` within ``span``.
    Without a cycle every pair is new.  A pair can come back only after a turn
    of a cycle, whose nodes have by then met themselves; from that round on pairs already found are
    removed, so the loop ends when a round finds no new pair."""
    rounds = rounds or Rounds(e.sparkSession, "lineage")
    exact = e.select(F.col("_c").alias("node"), F.col("_p").alias("mid"))
    found = [e.select(F.col("_c").alias("node"), F.col("_p").alias("ancestor"), F.lit(1).alias("depth"))]
    span, cycle = 1, False
    while True:
        acc = _union(found).select(F.col("node").alias("mid"), "ancestor", "depth")
        nxt = exact.join(acc, "mid").select("node", "ancestor", (F.col("depth") + span).alias("depth"))
        if not cycle:
            nxt = rounds.save(nxt)
            cycle = not nxt.filter(F.col("node") == F.col("ancestor")).isEmpty()
        if cycle:
            seen = _union(found).select("node", "ancestor")
            nxt = rounds.save(nxt.groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
                              .join(seen, ["node", "ancestor"], "left_anti"))
        if nxt.isEmpty():
            break
        found.append(nxt)
        span *= 2
        step = exact.select(F.col("node").alias("mid"), F.col("mid").alias("far"))
        exact = rounds.save(exact.join(step, "mid").select("node", F.col("far").alias("mid")))
    return _union(found)


def _dag_ancestors(e: DataFrame, rounds: Rounds | None = None) -> DataFrame:
    """Several parents: breadth-first frontier rounds (rounds = depth); pairs
    already found are removed each round so every pair keeps its first
    (shortest) depth and no path is expanded twice."""
    rounds = rounds or Rounds(e.sparkSession, "lineage")
    frontier = e.select(F.col("_c").alias("node"), F.col("_p").alias("ancestor"), F.lit(1).alias("depth"))
    found = [frontier]
    seen = frontier.select("node", "ancestor")
    while True:
        nxt = frontier.join(e, frontier["ancestor"] == e["_c"]).select(
            "node", F.col("_p").alias("ancestor"), (F.col("depth") + 1).alias("depth"))
        nxt = rounds.save(nxt.groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
                          .join(seen, ["node", "ancestor"], "left_anti"))
        if nxt.isEmpty():
            break
        found.append(nxt)
        seen = seen.unionByName(nxt.select("node", "ancestor"))
        frontier = nxt
    return _union(found)


def latest_versions(versions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """``name:latest`` -> highest version, with the version count."""
    return versions.groupBy(name).agg(F.max(version).alias("latest_version"),
                                      F.count(F.lit(1)).alias("n_versions"))


def resolve_inputs(uses: DataFrame, versions: DataFrame, name: str = "name") -> DataFrame:
    """J2 + J3: attach the resolved version to each ``name:latest`` use."""
    latest = latest_versions(versions, name)
    return uses.join(broadcast_if_small(latest), name, "left") \
        .withColumnRenamed("latest_version", "version").drop("n_versions")


def metadata_kv(df: DataFrame, keys: list[str], id_cols: list[str], values: dict) -> DataFrame:
    """Metadata / config as key-value rows (one per present key)."""
    m = F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(k).alias("k"), values[k].cast("string").alias("v")) for k in keys]),
        lambda e: e.getField("v").isNotNull()))
    return df.select(*id_cols, F.explode(m).alias("key", "value"))


def metric_summary(metrics: DataFrame, run: str = "run", step: str = "step", metric: str = "metric",
                   value: str = "value") -> DataFrame:
    """Per run and metric, the last logged value (by step), min, max and count."""
    return metrics.groupBy(run, metric).agg(
        F.max_by(value, step).alias("last_value"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"), F.count(F.lit(1)).alias("n_steps"), F.max(step).alias("last_step"))


def descendants(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """J4, other direction: ``(node, descendant, depth)``."""
    a = ancestors(edges, child, parent)
    return a.select(F.col("ancestor").alias("node"), F.col("node").alias("descendant"), "depth")


def ancestors_of(edges: DataFrame, nodes: DataFrame, node_col: str = "node", child: str = "child",
                 parent: str = "parent") -> DataFrame:
    """Ancestors of requested artifacts only: the frontier starts from
    ``nodes``, so the work follows their lineage, not the whole graph."""
    rounds = Rounds(edges.sparkSession, "lineage")
    e = edges.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).distinct()
    start = nodes.select(F.col(node_col).alias("node")).distinct()
    frontier = rounds.save(start.join(e, start["node"] == e["_c"]).select(
        "node", F.col("_p").alias("ancestor"), F.lit(1).alias("depth")))
    found, seen = [frontier], frontier.select("node", "ancestor")
    while True:
        if frontier.isEmpty():
            break
        nxt = frontier.join(e, frontier["ancestor"] == e["_c"]).select(
            "node", F.col("_p").alias("ancestor"), (F.col("depth") + 1).alias("depth"))
        nxt = rounds.save(nxt.groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
                          .join(seen, ["node", "ancestor"], "left_anti"))
        found.append(nxt)
        seen = seen.unionByName(nxt.select("node", "ancestor"))
        frontier = nxt
    return _union(found)
