"""Jaccard join of documents on word shingles by vertical partitioning.

Shingles have one global order: rare ones first, then by hash. A first pass over whole texts counts all
shingles in a table of fixed size (an upper bound of each shingle's count, used for the order only, so any
collision costs time but no link) and names every distinct set by a 64-bit key; equal sets are compared
once. Two sets that reach the similarity share a shingle among the first of each in the global order (prefix
filter), so a second pass sends only these prefixes, cut by shingle, to tasks that list the sets of a shingle.

Lists of up to ``FULL_LIST`` sets give all their pairs of fitting sizes. A longer list first meets its
``HUBS`` smallest members only; when those links are known, what is left are pairs of its members that are
not yet connected. They are bounded in tiles, and only pairs that the bound leaves open become rows.

Pairs are thinned by the shapes of both sets, the parities of their counts in about one cell a shingle: cells
that differ cannot be more than the symmetric difference. Of the others only as many are compared as connectedness
needs: first every set with its least partner, then the pairs that are still apart. Their sets are cut into
``FRAGMENTS`` fragments and go, once for each list of up to about ``LOT`` pairs of one set, from the texts straight to the
task that counts the partial overlaps of that list and fragment; these are added up per pair.

Defined results: a null or empty text, or one without words, has no shingles and is its own component; a row
without an id has a null component and links with nothing; repeated rows link with each other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from dispatchlake.llm.batches import lean
from dispatchlake.llm.components import components
from dispatchlake.llm.shingles import mix, shingle_sets
from dispatchlake.session import settle

WIDTH, PERCENT = 5, 80
BUCKETS = 1 << 21  # of the count table: 16 MB in a task, 2 MB on the driver, whatever the corpus is
COUNT_CHUNKS = 64
SHAPE_FROM, SHAPE_TO = 256, 1 << 16  # cells of a shape, a bit each; larger sets are only thinned less
FRAGMENTS = 4
LOT = 64  # pairs of one set for which its fragments are sent once
SEND_BYTES = 4 << 20  # of fragments in a batch
FULL_LIST, HUBS = 64, 32
HOT = 96  # ranks below are explained by chance
SALT_FROM = 9  # doublings over chance from which a shingle is spread over several lists
TILE_SETS = 1024
BROADCAST_IDS = 1_000_000  # 8 MB of ids; more are joined by a shuffle
BROADCAST_SENDS = 200_000  # some 20 MB of places that fragments are sent to
TEXTS = 512  # documents whose sets are in memory together

NAMED_SQL = "doc_id long, n long, key long, shape binary, mark long, chunk int, counts binary"
PREFIX_SQL = "token long, salt int, key long, n int"
LISTED_SQL = "a long, b long, token long, n int"
SEGMENT_SQL = "first long, lot int, fragment int, key long, n long, hashes binary"
OVERLAP_SQL = "a long, b long, members long, shared long"

Batches = Iterator[pa.RecordBatch]


def least_overlap(total: np.ndarray, percent: int) -> np.ndarray:
    """The overlap from which two sets with ``total`` members together reach the similarity."""
    return -(-percent * total // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def set_key(hashes: np.ndarray) -> int:
    total = np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Id and set of each row, in parts that bound the memory."""
    for at in range(0, batch.num_rows, TEXTS):
        part = batch.slice(at, TEXTS)
        yield from zip(part.column(0).to_pylist(), shingle_sets(part.column(1).to_pylist(), width))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _cells(n: int) -> int:
    return min(max(SHAPE_FROM, 1 << max(n - 1, 0).bit_length()), SHAPE_TO)


def _shape(hashes: np.ndarray) -> bytes:
    """The parity of the number of members in each cell; the cells are a power of two, at least the members while few."""
    cells = _cells(len(hashes))
    counts = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _shapes(raw: list[bytes]) -> np.ndarray:
    """Shapes of one length, a row each."""
    return np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw), -1)


def _differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many cells of the shapes differ, by row: never more than the sets' symmetric difference has members."""
    width = min(left.shape[1], right.shape[1])
    folded = []
    for cells in (left, right):
        while cells.shape[1] > width:  # cells taken together: their parities add up
            half = cells.shape[1] // 2
            cells = cells[:, :half] ^ cells[:, half:]
        folded.append(cells)
    return np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)


def _namer(width: int) -> Callable[[Batches], Batches]:
    """A row for each document, and for each chunk of the count table the buckets that this task has met."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("key", pa.int64()),
            ("shape", pa.binary()),
            ("mark", pa.int64()),
            ("chunk", pa.int32()),
            ("counts", pa.binary()),
        ]
    )

    def run(batches: Batches) -> Batches:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            rows = []
            waiting, size = [], 0
            for doc, hashes in _sets(batch, width):
                rows.append((doc, len(hashes), set_key(hashes), _shape(hashes)))
                waiting.append(hashes)
                size += len(hashes)
                if size > BUCKETS:
                    counts += np.bincount(_bucket(np.concatenate(waiting)), minlength=BUCKETS)
                    waiting, size = [], 0
            if size:
                np.add.at(counts, _bucket(np.concatenate(waiting)), 1)
            if rows:
                blank = pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())
                types = pa.int64(), pa.int64(), pa.int64(), pa.binary()
                named = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*named, batch.column(2), *blank], schema=schema)
        met = [(chunk, _pack_counts(part)) for chunk, part in enumerate(np.split(counts, COUNT_CHUNKS)) if part.any()]
        if met:
            blank = [pa.nulls(len(met), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())]
            chunks, parts = zip(*met)
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(chunks, pa.int32()), pa.array(parts, pa.binary())], schema=schema
            )

    return run


def _pack_counts(counts: np.ndarray) -> bytes:
    """The counts of a chunk's buckets in the narrowest type that holds them: all, or those that are not empty.

    The first byte is the bytes of a count, the next four are the number of buckets named, 0 if all counts follow.
    """
    size = np.min_scalar_type(int(counts.max())).itemsize
    held = np.flatnonzero(counts)
    if len(held) * (4 + size) >= len(counts) * size:
        held = held[:0]
    named = held.astype("<u4").tobytes()
    kept = counts[held] if len(held) else counts
    return bytes([size]) + len(held).to_bytes(4, "little") + named + kept.astype(f"<u{size}").tobytes()


def _held_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that are not empty, and their counts."""
    named = int.from_bytes(raw[1:5], "little")
    counts = np.frombuffer(raw, f"<u{raw[0]}", offset=5 + 4 * named).astype(np.int64)
    if named:
        return np.frombuffer(raw, "<u4", named, 5).astype(np.int64), counts
    held = np.flatnonzero(counts)
    return held, counts[held]


def _add_counts(batches: Batches) -> Batches:
    """Count tables of a task's rows, added up by chunk."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held, counts = _held_counts(raw)
            if chunk not in total:
                total[chunk] = np.zeros(BUCKETS // COUNT_CHUNKS, dtype=np.int64)
            total[chunk][held] += counts
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([_pack_counts(c) for c in total.values()], pa.binary())],
            names=["chunk", "counts"],
        )


def _count_sizes(batches: Batches) -> Batches:
    """How many buckets have which count."""
    for batch in batches:
        for raw in batch.column(1).to_pylist():
            counts, buckets = np.unique(_held_counts(raw)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(counts), pa.array(buckets)], names=["count", "buckets"])


def _ranker(middle: float) -> Callable[[Batches], Batches]:
    """The rank of each bucket of a chunk, one byte each."""
    chance = max(middle, 1.0) ** 0.5
    bound = middle + HOT / 6 * chance

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, found = _held_counts(raw)
                counts = np.zeros(BUCKETS // COUNT_CHUNKS)
                counts[held] = found
                steps = np.clip(np.round(4 * (counts - middle) / chance) + HOT // 3, 0, HOT - 1)
                over = HOT + np.floor(8 * np.log2(np.maximum(counts / bound, 1.0)))
                rank = np.minimum(np.where(counts > bound, over, steps), 255).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([rank.tobytes()], pa.binary())], names=["chunk", "ranks"]
                )

    return run


def levels(named: DataFrame) -> np.ndarray:
    """The rank of each bucket in the global order, 0 to 255 by its count.

    Up to ``HOT`` steps are quarters of the spread that chance gives a bucket, further ones eighths of a
    doubling. Counts are added up and ranked by chunk in tasks; a byte for each bucket comes to the driver.
    """
    parts = named.filter("chunk is not null").select("chunk", "counts")
    counts = settle(parts.repartition("chunk").mapInArrow(lean(_add_counts), "chunk int, counts binary"), "jaccard-counts")
    sizes = counts.mapInArrow(lean(_count_sizes), "count long, buckets long").groupBy("count").agg(F.sum("buckets").alias("buckets"))
    held = sizes.agg(F.sum("buckets")).first()[0] or 0
    middle = 0.0  # the median over all buckets, the empty ones included
    if 2 * held > BUCKETS:
        empty = sizes.sparkSession.createDataFrame([(0, BUCKETS - held)], sizes.schema)
        middle = float(sizes.union(empty).filter("buckets > 0").agg(F.percentile("count", 0.5, F.col("buckets"))).first()[0])
    chance = max(middle, 1.0) ** 0.5
    blank = int(np.clip(np.round(-4 * middle / chance) + HOT // 3, 0, HOT - 1))
    level = np.full(BUCKETS, blank, dtype=np.uint8)
    size = BUCKETS // COUNT_CHUNKS
    for row in counts.mapInArrow(lean(_ranker(middle)), "chunk int, ranks binary").collect():
        level[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(bytes(row["ranks"]), np.uint8)
    return level


def _lists(level: np.ndarray) -> np.ndarray:
    """Over how many lists a shingle of each rank is spread: more for each doubling of a hot one."""
    return np.maximum(1, (2.0 ** ((level.astype(float) - HOT) / 8 - SALT_FROM))).astype(np.int64)


def _prefixer(ranks: Broadcast[np.ndarray], width: int, percent: int) -> Callable[[Batches], Batches]:
    spread = _lists(np.arange(256))

    def run(batches: Batches) -> Batches:
        level = ranks.value
        done: set[int] = set()
        for batch in batches:
            tokens, salts, keys, sizes = [], [], [], []
            for doc, hashes in _sets(batch, width):
                if doc is None or not len(hashes):
                    continue
                key = set_key(hashes)
                if key in done:  # the same set in this task
                    continue
                if len(done) > 1_000_000:
                    done.clear()
                done.add(key)
                over = level[_bucket(hashes)]
                count = prefix_length(len(hashes), percent)
                first = np.argsort(over, kind="stable")[:count]  # hashes are sorted
                tokens.append(hashes[first])
                salts.append(np.mod(key, spread[over[first]]))
                keys.append(np.full(count, key))
                sizes.append(np.full(count, len(hashes)))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(salts).astype(np.int32)),
                        pa.array(np.concatenate(keys)),
                        pa.array(np.concatenate(sizes).astype(np.int32)),
                    ],
                    names=["token", "salt", "key", "n"],
                )

    return run


def _fits(n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])


def _lister(ranks: Broadcast[np.ndarray], percent: int) -> Callable[[Batches], Batches]:
    """Pairs of the sets in each list; rows come sorted by token, salt and key, and a list may span batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("token", pa.int64()), ("n", pa.int32())])
    spread = _lists(np.arange(256)) > 1

    def pairs(keys: np.ndarray, n: np.ndarray, i: list[np.ndarray], j: list[np.ndarray]) -> Batches:
        if not i:
            return
        i, j = np.concatenate(i), np.concatenate(j)
        keep = (keys[i] != keys[j]) & _fits(n, i, j, percent)
        a, b = np.minimum(keys[i], keys[j])[keep], np.maximum(keys[i], keys[j])[keep]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32())], schema=schema
            )

    def run(batches: Batches) -> Batches:
        level = ranks.value
        hold = None  # token, salt, key, n of the last list: all of it, or its hubs when it is long
        hold_long = False

        def work(token, salt, key, n, last: bool, was_long: bool):
            """Handles all lists, but keeps the last one back unless nothing follows."""
            edge = np.flatnonzero((token[1:] != token[:-1]) | (salt[1:] != salt[:-1])) + 1
            starts = np.concatenate([[0], edge])
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            # A salted list is long whatever its size: its sets meet those of other salts only as members.
            long = (sizes > FULL_LIST) | spread[level[_bucket(token[starts].view(np.uint64))]]
            long[0] |= was_long
            kept, kept_long = None, False
            row_run = np.repeat(np.arange(len(starts)), sizes)
            alive = np.ones(len(token), dtype=bool)
            if not last:
                s = starts[-1]
                kept_long = bool(long[-1])
                if kept_long:  # handled now; its hubs wait for the rest
                    kept = tuple(c[s : s + HUBS] for c in (token, salt, key, n))
                else:
                    kept = tuple(c[s:] for c in (token, salt, key, n))
                    alive[s:] = False
            i, j = [], []
            short = np.flatnonzero(alive & ~long[row_run] & (sizes[row_run] > 1))
            for step in range(1, FULL_LIST):
                short = short[short + step < len(token)]
                short = short[row_run[short] == row_run[short + step]]
                if not len(short):
                    break
                i.append(short)
                j.append(short + step)
            in_long = np.flatnonzero(alive & long[row_run])
            if len(in_long):
                for h in range(HUBS):
                    hub = starts[row_run[in_long]] + h
                    ok = hub < in_long
                    i.append(hub[ok])
                    j.append(in_long[ok])
                fresh = in_long[in_long >= held] if was_long else in_long  # held hubs were listed before
                if len(fresh):
                    out.append(
                        pa.RecordBatch.from_arrays(
                            [
                                pa.array(key[fresh]),
                                pa.nulls(len(fresh), pa.int64()),
                                pa.array(token[fresh]),
                                pa.array(n[fresh]),
                            ],
                            schema=schema,
                        )
                    )
            out.extend(pairs(key, n, i, j))
            return kept, kept_long

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in range(4)]
            held = 0
            if hold is not None:
                held = len(hold[0])
                columns = [np.concatenate([h, c]) for h, c in zip(hold, columns)]
            out: list[pa.RecordBatch] = []
            hold, hold_long = work(*columns, last=False, was_long=hold_long)
            yield from out
        if hold is not None and not hold_long:
            out, held = [], 0
            work(*hold, last=True, was_long=False)
            yield from out

    return run


def _thinner(percent: int) -> Callable[[Batches], Batches]:
    """Drops pairs whose shapes differ by more than the similarity allows."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            shapes = [batch.column(c).to_pylist() for c in ("shape_a", "shape_b")]
            widths = np.array([[len(x) for x in side] for side in shapes])
            apart = np.zeros(batch.num_rows, dtype=np.int64)
            for x, y in set(zip(*widths.tolist())):
                at = np.flatnonzero((widths[0] == x) & (widths[1] == y))
                apart[at] = _differing(*(_shapes([side[i] for i in at]) for side in shapes))
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = pa.array(apart <= total - 2 * least_overlap(total, percent))
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(keep)

    return run


def _segmenter(width: int) -> Callable[[Batches], Batches]:
    """The fragments of the wanted sets, for each list that they are sent to."""
    bounds = (np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(64 - FRAGMENTS.bit_length() + 1))
    types = pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
    names = ["first", "lot", "fragment", "key", "n", "hashes"]

    def cut(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, size = [], 0
            keys, sends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for (_, hashes), key, to in zip(_sets(batch, width), keys, sends):
                if not len(hashes) or set_key(hashes) != key:  # another text of the same id
                    continue
                parts = [(f, p.tobytes()) for f, p in enumerate(np.split(hashes, np.searchsorted(hashes, bounds))) if len(p)]
                for place in to:
                    rows += [(place["first"], place["lot"], f, key, len(hashes), p) for f, p in parts]
                    size += hashes.nbytes
                    if size > SEND_BYTES:
                        yield cut(rows)
                        rows, size = [], 0
            if rows:
                yield cut(rows)

    return run


def _count_overlaps(batches: Batches) -> Batches:
    """Partial overlaps of the first set of each list with the others.

    Rows come sorted by list and fragment, the first set's own before the others by key; a list may span batches.
    """
    own, own_n, here, last = np.zeros(0, np.uint64), 0, None, None
    for batch in batches:
        found = []
        for first, lot, fragment, key, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
            place = first, lot, fragment
            if key == first:
                own, own_n, here, last = np.frombuffer(raw, np.uint64), n, place, None
            elif place == here and key != last:  # a set that several rows have counts once
                last = key
                shared = len(np.intersect1d(own, np.frombuffer(raw, np.uint64), assume_unique=True))
                if shared:
                    found.append((first, key, own_n + n, shared))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b", "members", "shared"]
            )


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose shapes allow the similarity, with both sizes."""
    side = sets.select("key", F.col("n").alias("size"), "shape")
    for c in ("a", "b"):
        pairs = pairs.join(
            side.select(F.col("key").alias(c), F.col("size").alias(f"n_{c}"), F.col("shape").alias(f"shape_{c}")), c
        )
    return settle(pairs.mapInArrow(lean(_thinner(percent)), "a long, b long, n_a long, n_b long"), "jaccard-near")


def _few(ids: DataFrame) -> DataFrame:
    """Ids to join with whole texts: sent to all tasks while they are few, so that no text is shuffled."""
    ids = settle(ids, "jaccard-ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sends(near: DataFrame, sets: DataFrame) -> DataFrame:
    """Where the sets of the pairs (a, b) go: doc_id, key, and the lists, those of a set with many pairs in lots."""
    many = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / LOT).alias("lots")).filter("lots > 1")
    lot = F.pmod(F.xxhash64("b"), F.coalesce("lots", F.lit(1).cast("long"))).cast("int")
    lists = near.select("a", "b").join(many, "a", "left").select("b", F.col("a").alias("first"), lot.alias("lot"))
    own = lists.select(F.col("first").alias("key"), "first", "lot").distinct()
    return (
        lists.withColumnRenamed("b", "key").union(own)
        .join(sets.select("key", F.col("doc").alias("doc_id")), "key")
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("first", "lot")).alias("to"))
    )


def _wanted_texts(docs: DataFrame, sends: DataFrame) -> DataFrame:
    """The texts whose sets are sent, with their places: no text is shuffled while these are few."""
    sends = settle(sends, "jaccard-sends")
    if (sends.agg(F.sum(F.size("to"))).first()[0] or 0) <= BROADCAST_SENDS:
        texts = docs.join(F.broadcast(sends), "doc_id")
    else:
        texts = docs.join(_few(sends.select("doc_id").distinct()), "doc_id", "left_semi").join(sends, "doc_id")
    return texts.select("doc_id", "text", "key", "to")


def _overlapping(near: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs that reach the similarity: overlaps are counted by fragment and added up.

    Every set is shuffled once for each list it is in; nothing is stored in between.
    """
    place = ["first", "lot", "fragment"]
    partial = (
        _wanted_texts(docs, _sends(near, sets))
        .mapInArrow(lean(_segmenter(width)), SEGMENT_SQL)
        .repartition(*place)
        .sortWithinPartitions(*place, F.col("key") != F.col("first"), "key")
        .mapInArrow(lean(_count_overlaps), OVERLAP_SQL)
    )
    total = partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("members").alias("members"))
    reached = F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("members") - F.col("shared"))
    return settle(total.filter(reached).select("a", "b"), "jaccard-links")


def _connected(
    near: DataFrame, links: DataFrame | None, sets: DataFrame, docs: DataFrame, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links among the pairs that suffice to connect what all of them connect, and the components.

    Each set is first compared with its least partner only. Pairs that those links have connected need no
    comparison; all others are compared.
    """
    columns = F.struct("a", "n_a", "n_b")
    first = settle(
        near.groupBy("b").agg(F.min_by(columns, "a").alias("p")).select("p.a", "b", "p.n_a", "p.n_b"), "jaccard-first"
    )
    found = _overlapping(first, sets, docs, width, percent)
    links = found if links is None else links.union(found)
    roots = components(links)
    rest = near.join(first.select("a", "b"), ["a", "b"], "left_anti")
    for c in ("a", "b"):
        rest = rest.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    rest = settle(
        rest.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b", "n_a", "n_b"), "jaccard-open"
    )
    if not rest.isEmpty():
        links = links.union(_overlapping(rest, sets, docs, width, percent))
        roots = components(links)
    return links, roots


def _tile_sets(batches: Batches) -> Batches:
    """Sets sorted by cluster and size, packed in tiles of one cluster."""
    schema = pa.schema(
        [("cluster", pa.int64()), ("tile", pa.int64()), ("least", pa.int64()), ("most", pa.int64())]
        + [(c, pa.binary()) for c in ("keys", "roots", "sizes", "shapes")]
    )
    tile, rows = TaskContext.get().partitionId() << 32, []

    def cut() -> pa.RecordBatch:
        sizes = [r[3] for r in rows]
        packed = [np.array([r[i] for r in rows], dtype=np.int64).tobytes() for i in (1, 2, 3)]
        values = (rows[0][0], tile, min(sizes), max(sizes), *packed, b"".join(r[4] for r in rows))
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, values))], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("cluster", "key", "root", "n", "shape"))):
            if rows and (row[0] != rows[0][0] or len(rows) == TILE_SETS):
                yield cut()
                tile, rows = tile + 1, []
            rows.append(row)
    if rows:
        yield cut()


def _cut_shapes(sizes: np.ndarray, raw: bytes) -> list[bytes]:
    """The shapes of a tile's sets; the size of a set gives the length of its shape."""
    ends = np.cumsum([_cells(n) // 8 for n in sizes.tolist()]).tolist()
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


def _tile_pairs(percent: int) -> Callable[[Batches], Batches]:
    """Pairs of two tiles that are apart so far and whose sizes and shapes allow the similarity."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                a, b = ([np.frombuffer(row[f"{c}_{s}"], np.int64) for c in ("keys", "roots", "sizes")] for s in "ab")
                shapes = [_cut_shapes(sizes, row[f"shapes_{s}"]) for s, sizes in (("a", a[2]), ("b", b[2]))]
                widths = np.array([len(x) for x in shapes[1]])
                alike = [(at, _shapes([shapes[1][j] for j in at])) for at in (np.flatnonzero(widths == w) for w in np.unique(widths))]
                same, found = row["tile_a"] == row["tile_b"], []
                for i in range(len(a[0])):
                    own = _shapes([shapes[0][i]])
                    small, large = np.minimum(a[2][i], b[2]), np.maximum(a[2][i], b[2])
                    open_ = (a[1][i] != b[1]) & (100 * small >= percent * large)
                    if same:
                        open_[: i + 1] = False
                    for at, cells in alike:
                        k = np.flatnonzero(open_[at])
                        if len(k):
                            total = a[2][i] + b[2][at[k]]
                            j = at[k[_differing(own, cells[k]) <= total - 2 * least_overlap(total, percent)]]
                            found.append((np.full(len(j), i), j))
                if found:
                    i, j = (np.concatenate(c) for c in zip(*found))
                    turn = a[0][i] > b[0][j]
                    columns = [np.where(turn, b[k][j], a[k][i]) for k in (0, 2)] + [np.where(turn, a[k][i], b[k][j]) for k in (0, 2)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[k]) for k in (0, 2, 1, 3)], names=["a", "b", "n_a", "n_b"]
                    )

    return run


def _still_apart(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets in long lists that no links connect yet, if sizes and shapes allow the similarity.

    Lists that share members are one cluster. Its sets are compared in tiles, by shape alone, so neither a
    pair nor a list becomes a row unless it has to be verified.
    """
    ranges = placed.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("key").alias("first"))
    open_ = placed.join(ranges.filter("x < y").select("token", "first"), "token").select("key", "root", "first").distinct()
    open_ = settle(open_, "jaccard-open-members")
    clusters = components(open_.select(F.col("key").alias("a"), F.col("first").alias("b")))
    members = (
        open_.select("key", "root").distinct()
        .join(clusters.select(F.col("node").alias("key"), F.col("root").alias("cluster")), "key")
        .join(sets.select("key", "n", "shape"), "key")
    )
    order = ["cluster", "n", "key"]
    tiles_sql = "cluster long, tile long, least long, most long, keys binary, roots binary, sizes binary, shapes binary"
    tiles = settle(
        members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lean(_tile_sets), tiles_sql), "jaccard-tiles"
    )
    head = ["cluster", "tile", "least", "most"]
    left, right = (tiles.select(*[F.col(c).alias(f"{c}_{s}") for c in head]) for s in "ab")
    fits = (F.lit(100) * F.col("most_a") >= F.lit(percent) * F.col("least_b")) & (
        F.lit(100) * F.col("most_b") >= F.lit(percent) * F.col("least_a")
    )
    met = left.join(right, (F.col("cluster_a") == F.col("cluster_b")) & (F.col("tile_a") <= F.col("tile_b")) & fits)
    met = met.select("tile_a", "tile_b")
    body = ("keys", "roots", "sizes", "shapes")
    for s in "ab":
        met = met.join(tiles.select(F.col("tile").alias(f"tile_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in body]), f"tile_{s}")
    return met.mapInArrow(lean(_tile_pairs(percent)), "a long, b long, n_a long, n_b long")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """A row for each document: doc_id, mark (a hash of its text), n, key, component_id, and the key of its first set."""
    text = F.col("text").cast("string")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    narrow = marked.drop("mark")
    named = settle(marked.mapInArrow(lean(_namer(width)), NAMED_SQL), "jaccard-named")
    ranks = docs.sparkSession.sparkContext.broadcast(levels(named))  # 2 MB, whatever the corpus is
    rows = named.filter("chunk is null").drop("chunk", "counts")
    sets = settle(
        rows.filter("n > 0 and doc_id is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc"), F.min_by(F.struct("n", "shape"), "doc_id").alias("s"))
        .select("key", "doc", "s.n", "s.shape"),
        "jaccard-sets",
    )
    prefixes = narrow.mapInArrow(lean(_prefixer(ranks, width, percent)), PREFIX_SQL)
    listed = settle(
        prefixes.repartition("token", "salt")
        .sortWithinPartitions("token", "salt", "key")
        .mapInArrow(lean(_lister(ranks, percent)), LISTED_SQL),
        "jaccard-lists",
    )
    ranks.destroy()
    pairs = settle(listed.filter("b is not null").select("a", "b").distinct(), "jaccard-pairs")
    links, roots = _connected(_near(pairs, sets, percent), None, sets, narrow, width, percent)
    members = listed.filter("b is null").select("token", F.col("a").alias("key"), "n").distinct()
    if not members.isEmpty():
        placed = settle(
            members.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
                "root", F.coalesce("root", "key")
            ),
            "jaccard-members",
        )
        rest = _still_apart(placed, sets, percent)
        rest = settle(rest.join(pairs, ["a", "b"], "left_anti"), "jaccard-rest")
        if not rest.isEmpty():
            links, roots = _connected(rest, links, sets, narrow, width, percent)
    rooted = sets.select("key", "doc").join(roots.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min(F.struct("doc", "key")).alias("first"))
    by_key = rooted.join(least, "root").select(
        "key", F.col("first.doc").alias("component_id"), F.col("first.key").alias("first_key")
    )
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return rows.join(by_key, "key", "left").select(
        "doc_id",
        "mark",
        "n",
        "key",
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("first_key")).otherwise(F.col("key")).alias("first_key"),
    )


def similar_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id reachable by links)."""
    return _grouped(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def without_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Of each component the document with the least id, all columns as they were.

    Documents without shingles or id are kept. An id on rows of different texts is judged row by row; rows that
    repeat both id and text all stay. Only the rows that go are joined back, so Spark can broadcast
    them while they are few.
    """
    found = _grouped(docs, width, percent)
    gone = found.filter((F.col("doc_id") != F.col("component_id")) | (F.col("key") != F.col("first_key")))
    gone = _few(gone.select(F.col("doc_id").alias("__gone_id"), F.col("mark").alias("__gone_mark")).distinct())
    here = (F.col("doc_id").cast("long") == F.col("__gone_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__gone_mark"))
    return docs.join(gone, here, "left_anti")
