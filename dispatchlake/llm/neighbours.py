"""Approximate nearest neighbours by collision counting over query-centred windows.

Every vector is projected on ``m`` random lines, and a slice of vectors keeps one sorted array per line. A
query opens a window around its own projection on every line and widens all of them by a factor (virtual
rehashing: nothing is rehashed, only the new rings are read). A vector that lies in at least ``threshold``
windows is verified by its exact distance. At radius R a vector within R of the query lies in a window with
a known chance, so the threshold follows from the chance ``found`` that such a vector is verified; the search
of a query ends when it holds ``k`` verified vectors within R, or when the windows cover the slice.

Vectors are dealt to slices by hash and queries to blocks; every block meets every slice in one task of
bounded size, which returns the best ``k`` of the slice, and the best of all slices are merged. Equal
vectors are searched once: a class keeps its ``k + 1`` smallest ids, more can never be among the nearest.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id,
take no part; vectors of different lengths never meet; a repeated id counts once and is no neighbour of
itself; equal distances go to the smaller id; fewer candidates than ``k`` give fewer rows; an empty table
gives none; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchlake.llm.vectors import keyed, matrix, usable
from dispatchlake.session import settle

LINES = 64
HALF_WIDTH = 1.5  # of a window at radius 1
FOUND = 0.97  # chance that a vector within the last radius is verified
GROWTH = 1.2
SLICE_ROWS, SMALL_SLICE, BLOCK_QUERIES, BATCH_QUERIES = 65_536, 4_096, 16_384, 256
SAMPLE = 512  # vectors of a slice that set a query's first radius
SEED = 20

HITS_SQL = "query_class long, class_id long, distance double"
HITS = pa.schema([("query_class", pa.int64()), ("class_id", pa.int64()), ("distance", pa.float64())])


def collision_threshold(lines: int, half_width: float, found: float) -> int:
    """The most collisions that a vector at the radius has with chance ``found`` at least."""
    p = math.erf(half_width / math.sqrt(2))
    tail = 0.0
    for k in range(lines, 0, -1):
        tail += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if tail >= found:
            return k
    return 1


class SliceIndex:
    """Sorted projections of one slice of vectors."""

    def __init__(self, points: np.ndarray, lines: int = LINES) -> None:
        self.points = points
        self.lines = np.random.default_rng(SEED).standard_normal((points.shape[1], lines))
        placed = (points @ self.lines).T
        self.order = np.argsort(placed, axis=1, kind="stable")
        self.sorted = np.take_along_axis(placed, self.order, axis=1)

    def distances(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - query) ** 2).sum(axis=1))

    def search(self, queries: np.ndarray, k: int, ids: np.ndarray, threshold: int, half_width: float, growth: float):
        """For each query the rows of its ``k`` nearest found and their distances, ties by ``ids``."""
        n, m, q = len(self.points), len(self.order), len(queries)
        centre = (queries @ self.lines).T
        near = self.points[:SAMPLE]
        gaps = np.sqrt(np.maximum((queries**2).sum(1)[:, None] + (near**2).sum(1) - 2 * queries @ near.T, 0))
        radius = 0.75 * np.where(gaps > 1e-6, gaps, np.inf).min(axis=1)
        radius[~np.isfinite(radius)] = 1e-3
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)]).T
        high = low.copy()
        counts = np.zeros((q, n), dtype=np.uint16)
        verified = np.zeros((q, n), dtype=bool)
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in range(q)]
        active = np.arange(q)
        while len(active):
            reach = half_width * radius[active]
            wide_low = np.array([np.searchsorted(s, c[active] - reach) for s, c in zip(self.sorted, centre)]).T
            wide_high = np.array(
                [np.searchsorted(s, c[active] + reach, side="right") for s, c in zip(self.sorted, centre)]
            ).T
            going = []
            for a, lows, highs in zip(active.tolist(), wide_low, wide_high):
                rings = []
                for j in range(m):
                    rings.append(self.order[j, lows[j] : low[a, j]])
                    rings.append(self.order[j, high[a, j] : highs[j]])
                counts[a] += np.bincount(np.concatenate(rings), minlength=n).astype(np.uint16)
                low[a], high[a] = lows, highs
                new = np.flatnonzero((counts[a] >= threshold) & ~verified[a])
                verified[a, new] = True
                rows = np.concatenate([best[a][0], new])
                gaps_a = np.concatenate([best[a][1], self.distances(queries[a], new)])
                keep = np.lexsort((ids[rows], gaps_a))[:k]
                best[a] = rows[keep], gaps_a[keep]
                covered = not lows.any() and (highs == n).all()
                if not (covered or (len(keep) == k and gaps_a[keep[-1]] <= radius[a])):
                    going.append(a)
            active = np.array(going, dtype=np.int64)
            radius[active] *= growth
        return best


def _searcher(k: int, lines: int, half_width: float, found: float, growth: float):
    threshold = collision_threshold(lines, half_width, found)

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return HITS.empty_table()
        vectors = vectors.take(np.argsort(vectors.column("spread").to_numpy()))
        ids, asked = vectors.column("class_id").to_numpy(), queries.column("class_id").to_numpy()
        index = SliceIndex(matrix(vectors.column("v")), lines)
        wanted = matrix(queries.column("v"))
        hits = []
        for at in range(0, len(asked), BATCH_QUERIES):
            part = slice(at, at + BATCH_QUERIES)
            for query, (rows, gaps) in zip(
                asked[part].tolist(), index.search(wanted[part], k, ids, threshold, half_width, growth)
            ):
                hits.append((np.full(len(rows), query), ids[rows], gaps))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*hits)], schema=HITS)

    return run


def nearest(
    rows: DataFrame,
    is_query: Column,
    vector: str = "embedding",
    k: int = 10,
    lines: int = LINES,
    half_width: float = HALF_WIDTH,
    found: float = FOUND,
    growth: float = GROWTH,
) -> DataFrame:
    """The ``k`` nearest other rows found for each row where ``is_query`` holds.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).
    """
    spark = rows.sparkSession
    taken = keyed(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col(vector).alias("raw"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "raw",
    ).filter(F.col("vec_id").isNotNull() & usable("v"))
    ids = taken.groupBy("k1", "k2", "vec_id").agg(F.first("v").alias("v"), F.max("asks").alias("asks"))
    smallest = Window.partitionBy("k1", "k2").orderBy("vec_id")
    members = ids.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k + 1)
    classes = settle(
        members.groupBy("k1", "k2").agg(
            F.min("vec_id").alias("class_id"),
            F.array_sort(F.collect_list("vec_id")).alias("ids"),
            F.min_by("v", "vec_id").alias("v"),
        ),
        "vector-classes",
    ).withColumn("dim", F.size("v"))
    queries = settle(
        ids.filter("asks").select("vec_id", "k1", "k2").join(classes.select("k1", "k2", "class_id"), ["k1", "k2"])
        .select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("query_class")),
        "vector-queries",
    )
    asked = classes.join(queries.select(F.col("query_class").alias("class_id")).distinct(), "class_id", "left_semi")
    tasks = spark.sparkContext.defaultParallelism
    sizes = classes.groupBy("dim").agg(
        F.expr(
            f"cast(greatest(ceil(count(1) / {SLICE_ROWS}), least({tasks}, ceil(count(1) / {SMALL_SLICE}))) as int)"
        ).alias("slices"),
    )
    blocks = asked.groupBy("dim").agg(F.expr(f"cast(ceil(count(1) / {BLOCK_QUERIES}) as int)").alias("blocks"))
    layout = sizes.join(blocks, "dim")

    def dealt(df: DataFrame, own: str, over: str, other: str, other_count: str) -> DataFrame:
        """Each row in its own part, once for every part of the other side."""
        return (
            df.join(layout, "dim")
            .withColumn("spread", F.xxhash64("class_id"))
            .withColumn(own, F.pmod("spread", over).cast("int"))
            .withColumn(other, F.explode(F.expr(f"sequence(0, {other_count} - 1)")))
            .select(*[F.col(c).alias(c) for c in ("dim", "slice", "block", "class_id", "spread", "v")])
        )

    cell = ["dim", "slice", "block"]
    hits = (
        dealt(classes, "slice", "slices", "block", "blocks")
        .groupBy(*cell)
        .cogroup(dealt(asked, "block", "blocks", "slice", "slices").groupBy(*cell))
        .applyInArrow(_searcher(k + 1, lines, half_width, found, growth), HITS_SQL)
    )
    by_class = Window.partitionBy("query_class").orderBy("distance", "class_id")
    closest = hits.withColumn("nth", F.row_number().over(by_class)).filter(F.col("nth") <= k + 1)
    named = closest.join(classes.select("class_id", "ids"), "class_id").select(
        "query_class", "distance", F.explode("ids").alias("vec_id")
    )
    by_row = Window.partitionBy("query_class").orderBy("distance", "vec_id")
    named = named.withColumn("nth", F.row_number().over(by_row)).filter(F.col("nth") <= k + 1).drop("nth")
    pairs = queries.join(named, "query_class").filter("query_id <> vec_id")
    by_query = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
    )
