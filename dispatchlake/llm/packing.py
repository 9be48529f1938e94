"""Best-fit packing of token pieces into sequences by bin completion.

Sequences depend on piece lengths only, so the search runs on the histogram of lengths: ``capacity`` numbers,
however many documents there are. Best fit decreasing on the histogram gives the first incumbent. Bin
completion then fills a sequence around the largest piece left. A filling of the rest is dominated if its pieces
can be grouped into the pieces of another one; all fillings that are not are tried, one by one as the search asks
for them, least waste first, first as often as the counts allow and then less often. A branch is cut when the
waste so far cannot beat the incumbent. The search ends when the incumbent meets the lower bound, when every
branch was tried (the plan is then optimal), or after ``max_nodes`` fillings looked at, the only limit: the
incumbent is then the answer. The plan has at most a few fillings for each length. Documents find their place in it by their rank within their length, which is counted in two levels
(within a task, then over tasks), so no length, however common, meets in one task.

``pack_in_order`` keeps the order of the documents: windows of ``window`` documents that follow one another are
packed each on its own, in tasks, and the sequences are numbered window by window. A sequence never holds
documents of two windows; the price is at most the last, partly filled sequences of each window.

Defined results: a null or empty text is one piece, its end id; a document longer than the capacity is cut
into full pieces behind a first piece with the rest; repeated rows are packed each; a null id is carried
through; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from dispatchlake.llm.batches import lean
from dispatchlake.llm.encoding import END_ID, encoder
from dispatchlake.session import settle

CAPACITY = 1024
MAX_NODES = 20_000  # fillings that the search looks at
WINDOW_DOCS = 4_096  # documents that follow one another and are packed together, when order counts

Filling = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first
Plan = list[tuple[int, Filling]]  # sequences of each filling


def lower_bound(counts: list[int], capacity: int) -> int:
    """Martello and Toth's bound: pieces over half a sequence, those that cannot join them, and the volume."""
    n = [*counts, *[0] * (capacity + 1 - len(counts))]
    best = 0
    above = list(accumulate(reversed(n)))[::-1]  # pieces of a length or longer
    volume = list(accumulate(length * c for length, c in enumerate(n)))
    for k in range(capacity // 2 + 1):
        large = above[capacity - k + 1] if capacity - k + 1 <= capacity else 0
        half = capacity // 2 + 1
        middle = (above[half] if half <= capacity else 0) - large
        room = middle * capacity - (volume[capacity - k] - volume[half - 1] if capacity - k >= half else 0)
        small = volume[half - 1] - (volume[k - 1] if k else 0)
        best = max(best, large + middle + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: list[int], capacity: int) -> Plan:
    """Best fit decreasing on a histogram: equal open sequences are one group, and a step moves a whole group."""
    open_: dict[int, dict[Filling, int]] = {capacity: {}}
    for length in range(len(counts) - 1, 0, -1):
        left = counts[length]
        while left:
            room = next((r for r in range(length, capacity) if open_.get(r)), None)
            if room is None:
                per = capacity // length
                for fits, many in ((per, left // per), (left % per, 1)):
                    if fits and many:
                        groups = open_.setdefault(capacity - fits * length, {})
                        groups[((length, fits),)] = groups.get(((length, fits),), 0) + many
                break
            groups = open_[room]
            filling, many = groups.popitem()
            fits = min(room // length, left) if left < many * (room // length) else room // length
            used = min(many, left // fits)
            if many > used:
                groups[filling] = many - used
            into = open_.setdefault(room - fits * length, {})
            longer = (*filling, (length, fits))
            into[longer] = into.get(longer, 0) + used
            left -= used * fits
    return [(many, filling) for groups in open_.values() for filling, many in groups.items()]


def _sums(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """For each position the totals up to ``room`` that the lengths from there on can make, as bits."""
    inside, sums = (1 << room + 1) - 1, [1]
    for s in reversed(lengths):
        reach, copies, step = sums[-1], min(counts[s], room // s), 1
        while copies:
            step = min(step, copies)
            reach |= reach << step * s & inside
            copies -= step
            step *= 2
        sums.append(reach)
    return sums[::-1]


def dominated(filling: Filling, waste: int, spare: int) -> bool:
    """Whether a piece left over (a bit of ``spare``) can take the place of some pieces, or of none, of a filling.

    The piece must hold them, must fit with the waste, and must not be one piece of that length itself.
    """
    if spare & (1 << waste + 1) - 1:
        return True
    one = many = 0  # totals of one piece, of two or more
    for s, k in filling:
        for _ in range(k):
            many |= (one | many) << s
            one |= 1 << s
    return bool(spare & many) or any(spare & (one | many) << more for more in range(1, waste + 1))


def fillings(counts: list[int], room: int, most_waste: Callable[[], int]) -> Iterator[Filling | None]:
    """All undominated ways to fill ``room``, least waste first; None for each dominated one looked at.

    Totals are tried downwards, and only steps that can still make the total are taken. ``most_waste`` is asked
    again and again, as the incumbent gets better.
    """
    lengths = [s for s in range(min(room, len(counts) - 1), 0, -1) if counts[s]]
    sums = _sums(lengths, counts, room)
    spare = sum(1 << s for s in lengths)

    def exactly(at: int, total: int, chosen: Filling) -> Iterator[Filling]:
        if not total:
            yield chosen
            return
        for i in range(at, len(lengths)):
            if not sums[i] >> total & 1:
                return
            s = lengths[i]
            for k in range(min(counts[s], total // s), 0, -1):
                if sums[i + 1] >> total - k * s & 1:
                    yield from exactly(i + 1, total - k * s, (*chosen, (s, k)))

    for waste in range(room + 1):
        if waste > most_waste():
            return
        if not sums[0] >> room - waste & 1:
            continue
        for filling in exactly(0, room - waste, ()):
            gone = sum(1 << s for s, k in filling if k == counts[s])
            yield None if dominated(filling, waste, spare ^ gone) else filling
            if waste > most_waste():
                return


def bin_completion(counts: list[int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> Plan:
    """The best plan found for a histogram of lengths (index: length)."""
    counts = list(counts)
    incumbent = best_fit(counts, capacity)
    fewest, bound = sum(m for m, _ in incumbent), lower_bound(counts, capacity)
    volume = sum(s * c for s, c in enumerate(counts))
    nodes = 0

    def waste_left() -> int:
        """What may still be wasted if the plan is to be better than the incumbent."""
        return (fewest - 1) * capacity - volume - wasted

    def choices(left: list[int]) -> Iterator[tuple[int, Filling, int] | None]:
        """Fillings around the largest piece left: how often, the filling, its waste. ``left`` is the same at each step."""
        largest = max(s for s, c in enumerate(left) if c)
        rest_of = left[:]
        rest_of[largest] -= 1
        for rest in fillings(rest_of, capacity - largest, waste_left):
            if rest is None:
                yield None
                continue
            filling = {largest: 1}
            for s, k in rest:
                filling[s] = filling.get(s, 0) + k
            whole = tuple(sorted(filling.items(), reverse=True))
            waste = capacity - sum(s * k for s, k in whole)
            for often in range(min(left[s] // k for s, k in whole), 0, -1):
                if often * waste <= waste_left():
                    yield often, whole, waste

    # Depth first without recursion: the path can be thousands of fillings long.
    left, path, wasted, used, done = counts[:], [], 0, 0, object()
    stack = [choices(left)] if volume else []
    while stack and fewest > bound and nodes < max_nodes:
        step = next(stack[-1], done)
        if step is done:
            stack.pop()
            if path:
                often, filling = path.pop()
                for s, k in filling:
                    left[s] += often * k
                used -= often
                wasted -= often * (capacity - sum(s * k for s, k in filling))
            continue
        nodes += 1
        if step is None:
            continue
        often, filling, waste = step
        path.append((often, filling))
        for s, k in filling:
            left[s] -= often * k
        used += often
        wasted += often * waste
        if not any(left):
            if used < fewest:
                fewest, incumbent = used, list(path)
            stack.append(iter(()))
        else:
            stack.append(choices(left))
    return incumbent


PIECES_SQL = "chunk long, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(tokenizer: str | None, capacity: int, end_id: int, keep: tuple[str, ...] = ()):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, chunk = encoder(tokenizer), TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            kept = zip(*(batch.column(k).to_pylist() for k in keep)) if keep else repeat(())
            for doc, ids, more in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1)), kept):
                ids += end
                total = len(ids) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((chunk, ranks[b - a], doc, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), *more))
                    ranks[b - a] += 1
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            types += [batch.column(k).type for k in keep]
            names = [*(c.split()[0] for c in PIECES_SQL.split(", ")), *keep]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _slots(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, pieces in a sequence, first sequence and offset of each filling that has it."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for often, filling in plan:
        offset = 0
        for s, k in filling:
            slots.setdefault(s, []).append((filled.get(s, 0), k, sequence, offset))
            filled[s] = filled.get(s, 0) + often * k
            offset += s * k
        sequence += often
    return {s: tuple(np.array(c) for c in zip(*rows)) for s, rows in slots.items()}


def _placer(slots: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            present, at = np.unique(lengths[order], return_index=True)
            for s, rows in zip(present.tolist(), np.split(order, at[1:])):
                first, pieces, sequence, offset = slots[s]
                slot = np.searchsorted(first, ranks[rows], side="right") - 1
                nth, within = np.divmod(ranks[rows] - first[slot], pieces[slot])
                sequences[rows] = sequence[slot] + nth
                offsets[rows] = offset[slot] + within * s
            keep = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequences), pa.array(offsets)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


PLACED_SQL = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settle(narrow.mapInArrow(lean(_cutter(tokenizer, capacity, end_id)), PIECES_SQL), "pieces")
    counted = pieces.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    histogram = [0] * (capacity + 1)
    for row in pieces.groupBy("length").count().toLocalIterator():  # at most ``capacity`` rows
        histogram[row["length"]] = row["count"]
    slots = _slots(bin_completion(histogram, capacity, max_nodes))
    ranked = pieces.join(bases, ["length", "chunk"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.mapInArrow(lean(_placer(slots)), PLACED_SQL)


PLANNED_SQL = "window long, length long, rank long, sequence long, offset long"


def _planner(capacity: int, max_nodes: int):
    """The place of each piece of a window, by length and rank; rows (window, length, n) come sorted by window."""

    def places(window: int, histogram: list[int]) -> Iterator[pa.RecordBatch]:
        for s, (first, pieces, sequence, offset) in _slots(bin_completion(histogram, capacity, max_nodes)).items():
            rank = np.arange(histogram[s])
            slot = np.searchsorted(first, rank, side="right") - 1
            nth, within = np.divmod(rank - first[slot], pieces[slot])
            columns = np.full(len(rank), window), np.full(len(rank), s), rank, sequence[slot] + nth, offset[slot] + within * s
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["window", "length", "rank", "sequence", "offset"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, histogram = None, []
        for batch in batches:
            for window, length, n in zip(*(batch.column(c).to_pylist() for c in ("window", "length", "n"))):
                if window != at:
                    if at is not None:
                        yield from places(at, histogram)
                    at, histogram = window, [0] * (capacity + 1)
                histogram[length] = n
        if at is not None:
            yield from places(at, histogram)

    return run


def _with_spots(docs: DataFrame) -> DataFrame:
    """Id and text of each document with its file and its row there; without files, with its partition and row."""
    narrow = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    try:
        return docs.select(*narrow, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        at = docs.select(*narrow, F.monotonically_increasing_id().alias("at"))
        file = F.concat(F.lit("part-"), F.shiftright("at", 33).cast("string"))
        return at.select("doc_id", "text", file.alias("file"), F.expr("at & 8589934591L").alias("row"))


def _file_order(path: str) -> tuple[int, str]:
    """Files in the order of the tasks that wrote them; the number outgrows its zeros, so names do not sort."""
    part = re.search(r"part-(\d+)[^/]*$", path)
    return (int(part[1]) if part else -1, path)


def pack_in_order(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    max_nodes: int = MAX_NODES,
    window: int = WINDOW_DOCS,
) -> DataFrame:
    """``pack_documents`` by windows of the documents' order: sequence ids follow the files and their rows.

    The driver holds a number for each file and for each window.
    """
    spark = docs.sparkSession
    cutter = _cutter(tokenizer, capacity, end_id, ("file", "row"))
    pieces = settle(_with_spots(docs).mapInArrow(lean(cutter), PIECES_SQL + ", file string, row long"), "ordered-pieces")
    rows = {r["file"]: r["n"] for r in pieces.groupBy("file").agg((F.max("row") + 1).alias("n")).toLocalIterator()}
    files = sorted(rows, key=_file_order)
    bases = list(zip(files, accumulate([rows[f] for f in files], initial=0)))
    bases = F.broadcast(spark.createDataFrame(bases, "file string, base long"))
    spotted = pieces.join(bases, "file").withColumn("spot", F.col("base") + F.col("row"))
    spotted = spotted.withColumn("window", F.expr(f"spot div {window}"))
    histograms = spotted.groupBy("window", "length").agg(F.count(F.lit(1)).alias("n"))
    planned = settle(
        histograms.repartition("window").sortWithinPartitions("window").mapInArrow(lean(_planner(capacity, max_nodes)), PLANNED_SQL),
        "ordered-plan",
    )
    used = planned.groupBy("window").agg((F.max("sequence") + 1).alias("n"))
    sizes = sorted((r["window"], r["n"]) for r in used.toLocalIterator())
    starts = list(zip((w for w, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    starts = F.broadcast(spark.createDataFrame(starts, "window long, start_id long"))
    rank = F.row_number().over(Window.partitionBy("window", "length").orderBy("spot", "piece")) - 1
    ranked = spotted.withColumn("rank", rank.cast("long"))
    return ranked.join(planned, ["window", "length", "rank"]).join(starts, "window").select(
        "doc_id", "piece", "start", F.col("length"), "ids_crc32", (F.col("start_id") + F.col("sequence")).alias("sequence_id"), "offset"
    )
