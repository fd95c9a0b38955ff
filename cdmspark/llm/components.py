"""Connected components by alternating large-star and small-star rounds.

Every round is a pre-aggregated minimum per node and a join back. Nodes that hold over a
thousandth of all edge ends, fewer than a thousand, are joined by broadcast, so that no hub's
edges meet in one task; any other key holds few of them. Each round is written to the shared
checkpoint folder, in fewer files than a shuffle has partitions, which cuts the lineage and
keeps plans small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmspark.llm.common import materialise

MAX_ROUNDS = 60
#: A node with more than one in so many of all edge ends is a hub.
HUB_SHARE = 1000


def join_by_size(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (key, n, ...), n being the rows of a key out of ``total``:
    keys with over a thousandth of them, fewer than a thousand, by broadcast."""
    hubs = F.broadcast(groups.filter(F.col("n") > total // HUB_SHARE))
    few = groups.filter(F.col("n") <= total // HUB_SHARE)
    return rows.join(hubs, key).unionByName(rows.join(hubs.select(key), key, "left_anti").join(few, key))


def _with_least(rows: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """``rows`` (a, b) with the minimum m of their node a; ``least`` is (a, m, n), n the rows of a."""
    return join_by_size(rows, least, "a", ends).drop("n")


def _large_star(edges: DataFrame, ends: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return (_with_least(both.filter("b > a"), least, ends)
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame, ends: int) -> DataFrame:
    # edges run from the larger node a to the smaller b
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = _with_least(edges, least, ends).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).filter("a <> b").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: then the work is done."""
    out = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    ends = edges.select(F.col("b").alias("a")).distinct()           # a hub once
    bad = out.filter("n > 1").select("a").union(ends.join(out, "a", "left_semi"))
    return bad.isEmpty()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """Rows (node, comp) for every node in ``edges`` (columns a, b of one orderable type);
    comp is the least node reachable. Self links and repeated edges do no harm; no edges give
    no rows."""
    edges = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-edges")
    files = max(1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    for _ in range(MAX_ROUNDS):
        if _all_stars(edges):
            break
        ends = 2 * edges.count()
        larger = materialise(_large_star(edges, ends).coalesce(files), f"{name}-large")
        edges = materialise(_small_star(larger, ends).coalesce(files), f"{name}-round")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots)
