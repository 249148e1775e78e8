"""Connected components of a distributed edge table (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import written

SALTS = 16


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least neighbour of u or u itself.

    The minimum is pre-aggregated. In the join back, the neighbours of a vertex
    are dealt to ``SALTS`` parts, so the centre of a large star is no single task.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = edges.withColumn("salt", F.pmod(F.hash("v"), F.lit(SALTS)))
    return salted.join(least.withColumn("salt", salts), ["u", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _with_least(down)
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, *name: str) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (u, v) that has a link.

    The component is the least vertex reachable. Rounds go on until the edges
    are stars; there are O(log^2 n) of them at most, each a written table, so a
    lost executor costs one round.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), *name, "edges")
    before, state = None, _state(now)
    while state != before:
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), *name, "edges")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
