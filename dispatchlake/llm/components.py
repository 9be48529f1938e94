"""Connected components of link tables: every step is an aggregate or a join, nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlake.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame):
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node it is connected to) of all nodes of edges (a, b).

    Roots are listed too. Alternates large-star and small-star steps until a round changes nothing; the
    number of rounds grows with the logarithm of the longest chain. Every round is written to the shared
    folder, so a lost executor costs at most one round.
    """
    now = settle(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = settle(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if before == state:
            break
    root = F.col("b").alias("root")
    return now.select(F.col("a").alias("node"), root).union(now.select(F.col("b").alias("node"), root).distinct())
