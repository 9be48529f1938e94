"""Mixing sources to target weights by Pfair scheduling.

Every source is a stream of its documents in hash order, cut into blocks of ``block_bytes``. With weight w
(a share of all), block i of a source is released in slot floor(i / w) and due by slot ceil((i + 1) / w); in
every slot the released block with the earliest deadline goes out. For integer weights this schedule repeats
after as many slots as the weights add up to, so one period is scheduled and every block finds its slot by
arithmetic. In each prefix of the schedule every source is less than one block away from its share. When a
source ends, the others go on with their weights in proportion, from lags of zero: a phase of its own.

Targets are shares of the whole. Sources without target divide what the targets of the sources at hand leave,
in proportion to their bytes to the power ``temper``, or take ``other`` each. Targets that leave nothing, or add up
to more than one, are proportions: then the sources without target follow, in equal parts, when the others have
ended, and so does a source of target zero. Shares become whole numbers of slots in a period that is long enough
for the smallest one: no share is off by more than one part in ``EXACT``, except that a period has at most
``LONGEST`` slots (``WORK`` slots over all phases), so smaller shares are rounded to whole slots, one at least.

What runs on the driver is the table of sources (a row and a block count each) and one period for each phase.
More than ``fan`` sources are scheduled in levels, by groups of sources of like weight: the slots of a group are
dealt within it by a schedule of its own. Each level adds less than one block to a source's deviation.
Positions within a source are added up in two levels, hash ranges first, so a hot source is spread over tasks.

Defined results: a null or empty text has one byte, so it has a place of its own; a null source is a source
of its own; a document goes out whole with the block that its first byte lies in, so a block that one long
document covers may start none; rows without an id take part; repeated rows follow one another; an empty table
gives no rows; other columns are carried through.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlake.llm.batches import lean
from dispatchlake.session import settle

BLOCK_BYTES = 64 << 10
EXACT = 100  # a weight is off by at most one part in this
SHORTEST, LONGEST = 1_000, 100_000  # slots of a period
WORK = 5_000_000  # slots of the periods of all phases; each source that ends starts a phase
TEMPER = 0.5  # without targets a source weighs its bytes to this power
BUCKET_ROWS = 20_000
FAN = 200  # sources, or groups of them, in one schedule

PLACES_SQL = "source_id int, block long, within long, doc_id long, row_hash long, phase int, slot long, release long, due long"


def shares(sizes: list[int], targets: list[float | None], other: float | None = None, temper: float = TEMPER) -> list[float]:
    """The share of each source: its target, ``other``, or its part of what the targets leave."""
    if any(t is not None and not 0 <= t < float("inf") for t in [*targets, other]):
        raise ValueError("targets are numbers from zero up")
    named = sum(t for t in targets if t is not None)
    if other is not None:
        return [other if t is None else t for t in targets]
    rest = [float(n) ** temper if t is None else 0.0 for n, t in zip(sizes, targets)]
    left = max(0.0, 1 - named) / (sum(rest) or 1)
    return [left * r if t is None else t for r, t in zip(rest, targets)]


def whole_weights(shares: list[float], shortest: int = SHORTEST, longest: int = LONGEST) -> list[int]:
    """Integer weights in proportion to the shares, exact to one part in ``EXACT``; zero only for a share of zero."""
    total = sum(shares)
    if not total:
        return [0] * len(shares)
    longest = max(min(longest, WORK // len(shares)), shortest, len(shares))
    units = min(max(shortest, math.ceil(EXACT * total / 2 / min(s for s in shares if s))), longest)
    return [max(1, round(units * s / total)) if s else 0 for s in shares]


def period(weights: list[int], blocks: list[int] | None = None) -> list[int]:
    """The source of each slot of one period: released blocks, earliest deadline first (ties: later blocks last).

    With ``blocks`` the list ends early when a source has no block left.
    """
    total = sum(weights)
    waiting = [(0, s, 0) for s in range(len(weights))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out.append(s)
        if blocks and i + 1 == blocks[s]:
            break
        if i + 1 < weights[s]:
            heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))
    return out


class Schedule:
    """Slots of all blocks: phases that each repeat a period until one of their sources ends.

    Sources of weight zero follow, in equal parts, when those with a weight have ended.
    """

    def __init__(self, weights: list[int], blocks: list[int]) -> None:
        self.weights = [w or 1 for w in weights]
        # of each phase: first slot, slots of a period, and for each source its first block and period slots
        self.phases: list[tuple[int, int, dict[int, tuple[int, np.ndarray]]]] = []
        self.ends: dict[int, list[int]] = {s: [] for s in range(len(blocks))}
        self.starts = [0] * len(blocks)  # the first phase of each source
        done, slot = [0] * len(blocks), 0
        active = [s for s, n in enumerate(blocks) if n and weights[s]]
        last = [s for s, n in enumerate(blocks) if n and not weights[s]]
        weights = self.weights
        while active or last:
            if not active:
                active, last = last, []
                for s in active:
                    self.starts[s] = len(self.phases)
            slots = sum(weights[s] for s in active)
            order = np.array(period([weights[s] for s in active], [blocks[s] - done[s] for s in active]))
            places = {s: np.flatnonzero(order == k).astype(np.int32) for k, s in enumerate(active)}
            # The first source to end gives the length of the phase.
            length = len(order) if len(order) < slots else min(
                (n - 1) // weights[s] * slots + int(places[s][(n - 1) % weights[s]]) + 1
                for s in active
                for n in [blocks[s] - done[s]]
            )
            self.phases.append((slot, slots, {s: (done[s], places[s]) for s in active}))
            rounds, rest = divmod(length, slots)
            for s in active:
                done[s] += rounds * weights[s] + int(np.searchsorted(places[s], rest))
                self.ends[s].append(done[s])
            slot += length
            active = [s for s in active if done[s] < blocks[s]]

    def place(self, source: int, block: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phase, slot, release and deadline of blocks of one source."""
        phase = np.searchsorted(np.array(self.ends[source]), block, side="right") + self.starts[source]
        out = [phase.astype(np.int32), *(np.zeros(len(block), np.int64) for _ in range(3))]
        for p in np.unique(phase).tolist():
            first_slot, slots, sources = self.phases[p]
            first, places = sources[source]
            rows = phase == p
            i, w = block[rows] - first, self.weights[source]
            out[1][rows] = first_slot + i // w * slots + places[i % w]
            out[2][rows] = first_slot + i * slots // w
            out[3][rows] = first_slot + -(-(i + 1) * slots // w)
        return tuple(out)


class Levels:
    """A schedule of any number of sources: up to ``fan`` of them, or of groups that share their slots alike."""

    def __init__(self, shares: list[float], blocks: list[int], fan: int = FAN) -> None:
        self.groups: list[Levels] = []
        if len(shares) <= fan:
            self.schedule = Schedule(whole_weights(shares), blocks)
            return
        order = sorted(range(len(shares)), key=lambda s: (-shares[s], s))
        size = -(-len(order) // fan)
        groups = [order[i : i + size] for i in range(0, len(order), size)]
        self.at = {s: (g, k) for g, members in enumerate(groups) for k, s in enumerate(members)}
        self.groups = [Levels([shares[s] for s in m], [blocks[s] for s in m], fan) for m in groups]
        totals = [sum(shares[s] for s in m) for m in groups]
        self.schedule = Schedule(whole_weights(totals), [sum(blocks[s] for s in m) for m in groups])

    def place(self, source: int, block: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phase, slot, release and deadline, as of the outermost schedule."""
        if not self.groups:
            return self.schedule.place(source, block)
        group, member = self.at[source]
        return self.schedule.place(group, self.groups[group].place(member, block)[1])


def lags(order: list[int], weights: list[int]) -> list[list[Fraction]]:
    """How far each source is ahead of its share after each slot."""
    total, seen, out = sum(weights), [0] * len(weights), []
    for t, s in enumerate(order, 1):
        seen[s] += 1
        out.append([Fraction(n) - Fraction(w * t, total) for n, w in zip(seen, weights)])
    return out


def _placer(schedule: Levels) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, blocks = batch.column("source_id").to_numpy(), batch.column("block").to_numpy()
            out = [np.zeros(len(blocks), np.int32), *(np.zeros(len(blocks), np.int64) for _ in range(3))]
            for s in np.unique(sources).tolist():
                rows = sources == s
                for into, values in zip(out, schedule.place(s, blocks[rows])):
                    into[rows] = values
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, out)], names=[*batch.schema.names, "phase", "slot", "release", "due"]
            )

    return run


def mix(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    other: float | None = None,
    block_bytes: int = BLOCK_BYTES,
    temper: float = TEMPER,
    fan: int = FAN,
) -> DataFrame:
    """One row per document: doc_id, row_hash, source, block, within, phase, slot, release, due.

    Documents in the order of slot, block and ``within`` are the mix; ``row_hash`` tells rows with one id apart.
    """
    targets = targets or {}
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("row_hash"),
        F.col("source").cast("string").alias("source"),
        F.greatest(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(1)).cast("long").alias("size"),
    )
    narrow = settle(narrow.withColumn("spot", F.xxhash64("doc_id", "row_hash")), "mix-rows")
    n = narrow.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    spread = narrow.withColumn("bucket", F.expr(f"cast(floor((spot / 18446744073709551616D + 0.5D) * {buckets}) as long)"))
    sums = settle(spread.groupBy("source", "bucket").agg(F.sum("size").alias("bytes")), "mix-sums")
    totals = sums.groupBy("source").agg(F.sum("bytes").alias("bytes")).orderBy("source").collect()
    if not totals:
        nothing = "doc_id long, row_hash long, source string, block long, within long, phase int, slot long, release long, due long"
        return docs.sparkSession.createDataFrame([], nothing)
    names = [r["source"] for r in totals]
    parts = shares([r["bytes"] for r in totals], [targets.get(n) for n in names], other, temper)
    schedule = Levels(parts, [-(-r["bytes"] // block_bytes) for r in totals], fan)
    ids = docs.sparkSession.createDataFrame(list(enumerate(names)), "source_id int, source string")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "bucket", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    bases = bases.join(ids, bases["source"].eqNullSafe(ids["source"])).select(
        "source_id", bases["source"], "bucket", "base"
    )
    before = Window.partitionBy("source", "bucket").orderBy("spot", "doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = local.alias("l").join(
        bases.alias("b"), F.expr("l.source <=> b.source and l.bucket = b.bucket")
    )
    start = F.col("base") + F.col("ahead")
    cut = joined.select(
        "source_id",
        F.expr(f"(base + ahead) div {block_bytes}").cast("long").alias("block"),
        (start % block_bytes).cast("long").alias("within"),
        "doc_id",
        "row_hash",
    )
    placed = cut.mapInArrow(lean(_placer(schedule)), PLACES_SQL)
    return placed.join(ids, "source_id").select(
        "doc_id", "row_hash", "source", "block", "within", "phase", "slot", "release", "due"
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """All documents in the order of the mix, their columns as they were.

    Rows are ranged by slot and sorted within their files, so reading the files in order reads the mix.
    """
    keys = ["__mix_slot", "__mix_block", "__mix_within"]  # names that documents do not have
    order = mix(docs, **settings).select(
        F.col("doc_id").alias("__mix_id"),
        F.col("row_hash").alias("__mix_hash"),
        *[F.col(c).alias(k) for c, k in zip(("slot", "block", "within"), keys)],
    )
    order = order.dropDuplicates(["__mix_id", "__mix_hash"])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__mix_id")) & (F.xxhash64("text") == F.col("__mix_hash"))
    placed = docs.join(order, same).drop("__mix_id", "__mix_hash")
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
