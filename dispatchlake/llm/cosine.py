"""Near duplicates among vectors of one label, compared in PCA-ordered tiles.

Vectors are scaled to length one and rotated to principal axes, so that leading components carry most of a
product. They are sorted by label, by slab of the first component and by the second one, and cut into tiles.
Two tiles meet only if their boxes on the leading axes are close enough for the threshold. In a pair of tiles
products add up axis by axis in groups; after each group the rest is bounded by the product of the suffix
norms, and pairs that cannot reach the threshold drop out. What is left is decided by the cosine of the
original vectors in double precision.

A pair of tiles returns, for each vector, the sum of its links and the least vector it is connected to there;
so a group of n near copies gives at most n rows for each pair of tiles, not n squared. Equal vectors of a
label are one class, compared once.

Any rotation is right, only speed depends on it: the axes are fitted on ``sample`` vectors with the smallest
hash. Defined results: a vector that is null, zero or holds null or non-finite components, or has no label,
links with nothing and is its own component; vectors of different lengths never link; a row without an id
links with nothing and has a null component; repeated rows link with each other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from dispatchlake.llm.components import components
from dispatchlake.llm.vectors import keyed, matrix, usable
from dispatchlake.session import settle

THRESHOLD = 0.98
TILE_ROWS = 1024
BOX_AXES = 8
GROUP_AXES = 16
SAMPLE = 20_000
SLACK = 1e-6  # of the bounds, far above rounding; survivors are decided exactly
CHUNK_PAIRS = 1 << 16

TILES_SQL = (
    "tile long, dim int, label string, slab long, low array<double>, high array<double>, ids binary, weights binary, "
    "vectors binary"
)
LINKED_SQL = "class_id long, links long, least long"


def axes(vectors: np.ndarray) -> np.ndarray:
    """Principal axes (columns) of unit vectors, strongest first."""
    values, found = np.linalg.eigh(vectors.T @ vectors)
    return found[:, np.argsort(-values)]


def linked_pairs(x: np.ndarray, y: np.ndarray, turn: np.ndarray, threshold: float, upper: bool):
    """Rows (i, j) of two tiles whose cosine reaches ``threshold``; ``upper``: only i < j, of one tile."""
    norms_x, norms_y = np.sqrt((x**2).sum(1)), np.sqrt((y**2).sum(1))
    a, b = (x / norms_x[:, None]) @ turn, (y / norms_y[:, None]) @ turn
    rest_a, rest_b = (np.sqrt(np.cumsum((u**2)[:, ::-1], axis=1)[:, ::-1]) for u in (a, b))
    dim, at = a.shape[1], min(GROUP_AXES, a.shape[1])
    sums = a[:, :at] @ b[:, :at].T
    bound = sums + rest_a[:, at, None] * rest_b[:, at] if at < dim else sums
    alive = bound >= threshold - SLACK
    if upper:
        alive &= np.tri(len(a), dtype=bool).T & ~np.eye(len(a), dtype=bool)
    i, j = np.nonzero(alive)
    del alive, bound
    found = []
    for part in range(0, len(i), CHUNK_PAIRS):
        pi, pj = i[part : part + CHUNK_PAIRS], j[part : part + CHUNK_PAIRS]
        total, now = sums[pi, pj], at
        while now < dim and len(pi):
            upto = min(now + GROUP_AXES, dim)
            total = total + np.einsum("ij,ij->i", a[pi, now:upto], b[pj, now:upto])
            left = rest_a[pi, upto] * rest_b[pj, upto] if upto < dim else 0.0
            keep = total + left >= threshold - SLACK
            pi, pj, total, now = pi[keep], pj[keep], total[keep], upto
        exact = np.einsum("ij,ij->i", x[pi], y[pj]) / (norms_x[pi] * norms_y[pj])
        found.append((pi[exact >= threshold], pj[exact >= threshold]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def least_connected(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least id it is connected to by the links."""
    least = ids.copy()
    while True:
        step = least.copy()
        np.minimum.at(step, i, least[j])
        np.minimum.at(step, j, step[i])
        if (step == least).all():
            return least
        least = step


def _tiler(turns: dict[int, np.ndarray], tile_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        key, rows = None, []

        def cut() -> pa.RecordBatch:
            vectors = np.stack([r[2] for r in rows])
            turned = (vectors / np.sqrt((vectors**2).sum(1))[:, None]) @ turns[key[0]]
            box = turned[:, :BOX_AXES]
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "tile": tile,
                        "dim": key[0],
                        "label": key[1],
                        "slab": key[2],
                        "low": box.min(0).tolist(),
                        "high": box.max(0).tolist(),
                        "ids": np.array([r[0] for r in rows], dtype=np.int64).tobytes(),
                        "weights": np.array([r[1] for r in rows], dtype=np.int64).tobytes(),
                        "vectors": vectors.tobytes(),
                    }
                ],
                schema=pa.schema(
                    [
                        ("tile", pa.int64()),
                        ("dim", pa.int32()),
                        ("label", pa.string()),
                        ("slab", pa.int64()),
                        ("low", pa.list_(pa.float64())),
                        ("high", pa.list_(pa.float64())),
                        ("ids", pa.binary()),
                        ("weights", pa.binary()),
                        ("vectors", pa.binary()),
                    ]
                ),
            )

        for batch in batches:
            names = ("dim", "label", "slab", "class_id", "weight", "v")
            columns = [batch.column(n).to_pylist() for n in names[:5]]
            vectors = batch.column("v").to_numpy(zero_copy_only=False)
            for dim, label, slab, class_id, weight, v in zip(*columns, vectors):
                if rows and ((dim, label, slab) != key or len(rows) == tile_rows):
                    yield cut()
                    tile, rows = tile + 1, []
                key = (dim, label, slab)
                rows.append((class_id, weight, v))
        if rows:
            yield cut()

    return run


def _comparer(turns: dict[int, np.ndarray], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in (batch.slice(r, 1).to_pylist()[0] for r in range(batch.num_rows)):
                same, dim = pair["tile"] == pair["other"], pair["dim"]
                ids, weights = (np.frombuffer(pair[n], np.int64) for n in ("ids", "weights"))
                x = np.frombuffer(pair["vectors"]).reshape(-1, dim)
                y = np.frombuffer(pair["other_vectors"]).reshape(-1, dim)
                i, j = linked_pairs(x, y, turns[dim], threshold, same)
                if not len(i):
                    continue
                if not same:
                    j = j + len(ids)
                    ids = np.concatenate([ids, np.frombuffer(pair["other_ids"], np.int64)])
                    weights = np.concatenate([weights, np.frombuffer(pair["other_weights"], np.int64)])
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, i, weights[j])
                np.add.at(links, j, weights[i])
                least = least_connected(len(ids), i, j, ids)
                rows = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(links[rows]), pa.array(least[rows])],
                    names=["class_id", "links", "least"],
                )

    return run


def _fit(classes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Axes for every vector length of the sample, of at most ``sample`` vectors."""
    groups: dict[int, list] = {}
    for row in classes.orderBy(F.xxhash64("class_id")).limit(sample).select("v").toLocalIterator():
        groups.setdefault(len(row["v"]), []).append(row["v"])
    fitted = {}
    for dim, vectors in groups.items():
        x = np.array(vectors)
        fitted[dim] = axes(x / np.sqrt((x**2).sum(1))[:, None])
    return fitted


class _Turns(dict):
    """Axes by vector length; a length that the sample missed keeps its own axes."""

    def __missing__(self, dim: int) -> np.ndarray:
        self[dim] = np.eye(dim)
        return self[dim]


def near_duplicates(
    rows: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tile_rows: int = TILE_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (the least id of its component stays)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine between 0 and 1")
    narrow = keyed(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("raw"), F.col(label).cast("string").alias("label")
        ),
        "raw",
    ).withColumn("takes", usable("v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    classes = settle(
        narrow.filter("takes")
        .groupBy("label", "k1", "k2")
        .agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")),
        "cosine-classes",
    )
    turns = _Turns(_fit(classes, sample))
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    leading = {d: t[:, : min(2, d)] for d, t in turns.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slabs, second = [], []
            for v in batch.column("v").to_numpy(zero_copy_only=False):
                on = (v / math.sqrt((v**2).sum())) @ leading.get(len(v), np.eye(len(v))[:, :2])
                slabs.append(math.floor(on[0] / reach))
                second.append(float(on[-1]))
            dims = [len(v) for v in batch.column("v").to_numpy(zero_copy_only=False)]
            added = [pa.array(dims, pa.int32()), pa.array(slabs, pa.int64()), pa.array(second, pa.float64())]
            kept = [batch.column(n) for n in ("label", "class_id", "weight", "v")]
            yield pa.RecordBatch.from_arrays(
                [*added, *kept], names=["dim", "slab", "second", "label", "class_id", "weight", "v"]
            )

    placed = classes.mapInArrow(
        place, "dim int, slab long, second double, label string, class_id long, weight long, v array<double>"
    )
    order = ["dim", "label", "slab", "second", "class_id"]
    tiles = settle(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tiler(turns, tile_rows), TILES_SQL),
        "tiles",
    )
    head = ["tile", "dim", "label", "slab", "low", "high"]
    left = tiles.select(*head, F.explode(F.array(F.col("slab"), F.col("slab") + 1)).alias("near"))
    right = tiles.select(
        F.col("tile").alias("other"),
        F.col("dim").alias("r_dim"),
        F.col("label").alias("r_label"),
        F.col("slab").alias("r_slab"),
        F.col("low").alias("r_low"),
        F.col("high").alias("r_high"),
    )
    gap = F.aggregate(
        F.zip_with("low", "r_high", lambda a, b: a - b),
        F.lit(0.0),
        lambda s, x: s + F.when(x > 0, x * x).otherwise(0.0),
    ) + F.aggregate(
        F.zip_with("r_low", "high", lambda a, b: a - b),
        F.lit(0.0),
        lambda s, x: s + F.when(x > 0, x * x).otherwise(0.0),
    )
    pairs = left.join(
        right,
        (F.col("dim") == F.col("r_dim"))
        & (F.col("label") == F.col("r_label"))
        & (F.col("near") == F.col("r_slab"))
        & ((F.col("slab") != F.col("r_slab")) | (F.col("tile") <= F.col("other")))
        & (gap <= reach * reach),
    ).select("tile", "other")
    body = ["dim", "ids", "weights", "vectors"]
    whole = pairs.join(tiles.select("tile", *body), "tile").join(
        tiles.select(F.col("tile").alias("other"), *[F.col(c).alias(f"other_{c}") for c in body[1:]]), "other"
    )
    linked = settle(whole.mapInArrow(_comparer(turns, threshold), LINKED_SQL), "cosine-links")
    totals = linked.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("class_id").alias("a"), F.col("least").alias("b")))
    judged = (
        classes.drop("v")
        .join(totals, "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            F.col("label"),
            "k1",
            "k2",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "class_id").alias("root"),
            F.lit(True).alias("takes"),
        )
    )
    joined = narrow.drop("raw", "v").join(judged, ["label", "k1", "k2", "takes"], "left")
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
