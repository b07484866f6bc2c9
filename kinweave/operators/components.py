"""Connected components of an edge table (alternating large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging

#: Rounds are logarithmic in the longest shortest path; more than this are an error.
MAX_ROUNDS = 100


#: A node is a hub if its edges are over this share of a task's, and over so many.
HUB_SHARE, HUB_ROWS = 0.25, 1000


def _minima(edges: DataFrame, stage: Staging, rows: int | None = None) -> DataFrame:
    """``u, m, out, into`` for each ``u`` of the edges: its least ``v``, and how many of its ``v`` are smaller and larger."""
    smaller = F.col("v") < F.col("u")
    lows = edges.groupBy("u").agg(F.min("v").alias("m"), F.count_if(smaller).alias("out"), F.count_if(~smaller).alias("into"))
    return stage.write(lows, "minima", rows)


def _with_minima(edges: DataFrame, lows: DataFrame) -> DataFrame:
    """``u, v, m``: edges with the least ``v`` of their ``u``.

    The edges of hubs are dealt to all tasks by ``v``, and a hub's minimum is copied to each of
    them. Hubs are known from the counts; by their definition there are at most as many as
    tasks over the share, so their table is small.
    """
    spark = edges.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = lows.agg(F.coalesce(F.sum(F.col("out") + F.col("into")), F.lit(0)).alias("n")).first().n
    least = max(HUB_ROWS, int(total / tasks * HUB_SHARE))
    hub = F.col("out") + F.col("into") > least
    hubs = lows.filter(hub).select("u")
    if not hubs.limit(1).count():
        return edges.join(lows.select("u", "m"), "u")
    copies = F.when(hub, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    dealt = lows.select("u", "m", F.explode(copies).alias("part"))
    salted = edges.join(F.broadcast(hubs.withColumn("_hub", F.lit(True))), "u", "left").withColumn("part", F.when(F.col("_hub"), F.pmod(F.xxhash64("v"), F.lit(tasks)).cast("int")).otherwise(0)).drop("_hub")
    return salted.join(dealt, ["u", "part"]).drop("part")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", nodes: DataFrame | None = None, node: str = "node") -> DataFrame:
    """``node, component`` with the smallest node of each component as its name.

    Nodes are those of the edges and, if given, the distinct non-null values of the first
    column of ``nodes`` (isolated ones become their own component). Edges with a null end
    and loops add no link. Each round shrinks trees toward stars around the smallest node;
    it joins minima back instead of gathering neighbours, deals the edges of hubs to all tasks,
    and writes its edges to the shared folder, so lineage doesn't grow.
    """
    stage = Staging(edges.sparkSession, "components")
    ends = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).filter("s IS NOT NULL AND d IS NOT NULL")
    now = stage.write(ends.filter("s != d").select(F.greatest("s", "d").alias("u"), F.least("s", "d").alias("v")).distinct(), "edges")
    rows = now.count()
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = _minima(both, stage, rows)
        # Done when every node has one edge at most to a smaller node, and that one has none itself.
        if not lows.filter("out > 1 OR (out > 0 AND into > 0)").limit(1).count():
            break
        near = lows.withColumn("m", F.least("u", "m"))
        large = stage.write(_with_minima(both, near).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large", rows)
        least = _minima(large, stage, rows)
        small = _with_minima(large, least).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = stage.write(small, "edges", rows)
        stage.drop(now, lows, large, least)
        now = after
    else:
        raise RuntimeError(f"components did not converge in {MAX_ROUNDS} rounds")
    found = now.select(F.col("u").alias(node), F.col("v").alias("component"))
    every = ends.select(F.col("s").alias(node)).unionByName(ends.select(F.col("d").alias(node)))
    if nodes is not None:
        every = every.unionByName(nodes.select(F.col(nodes.columns[0]).alias(node)).filter(F.col(node).isNotNull()))
    return every.distinct().join(found, node, "left").select(node, F.coalesce("component", node).alias("component"))
