"""Ranked lexical search by the Best Position Algorithm.

A term is a run of bytes other than ASCII signs, blanks and controls; A-Z count as a-z. A first pass over whole texts
writes one index row per document: its number of terms, and the query terms it holds with their occurrences. From
these rows come the statistics of the corpus. The second pass reads them in slices of bounded size. In a slice each
term has an impact list, highest impact first. A search reads the lists of its terms in step; every document met is
looked up in the other lists at once (direct access), which marks its positions there as seen too. A list's best
position ends its unbroken run of seen positions, and no document unseen so far can score more than the impacts at
all best positions together. Once this bound is strictly below the k-th score, the slice has nothing left to add.
A document lies in one slice, so the best of all slices are exact; the k-th score of earlier slices of a
task counts in later ones.

Queries are worked in blocks of bounded vocabulary, each against all documents.

Defined results: a null or empty text, or one without terms, is no document (it counts nowhere); an item without
terms, or whose terms no document holds, gets no rows; a document row without an id counts in the statistics
but is not ranked; each document row ranks by itself, so a repeated id can come twice; each item row is a query by
itself, also when its id repeats or is null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlake.session import settle

TOP = 20
BLOCK_TERMS = 200_000  # terms of the queries worked together: some 20 MB in a task
SLICE_DOCS, SLICE_POSTINGS = 16_384, 2_000_000
FIRST_STEP = 256  # positions read from each list in the first step; doubles from step to step
DENSE_SHARE = 8  # lists that hold a document in so many are looked up by an array
TEXTS = 256  # documents whose terms are in memory together
LONG_TEXT = 1 << 22  # bytes from which the terms of a text are not listed but streamed

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
INDEX_SQL = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND_SQL = "query long, doc_id long, score long"

Batches = Iterator[pa.RecordBatch]


def terms(text: str | None) -> Iterator[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(raw) < LONG_TEXT:
        return iter(TERM.findall(raw))
    return (m.group() for m in TERM.finditer(raw))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _indexer(vocabulary: dict[bytes, int]) -> Callable[[Batches], Batches]:
    """Index rows of all documents with terms."""
    size = max(1, len(vocabulary))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                lengths, found, counts = [], [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    held = Counter(terms(text))
                    lengths.append(sum(held.values()))
                    mine = held.keys() & vocabulary.keys()
                    found.append(np.fromiter((vocabulary[t] for t in mine), np.int64, len(mine)) + k * size)
                    counts.append(np.fromiter((held[t] for t in mine), np.int32, len(mine)))
                key, tf = np.concatenate(found), np.concatenate(counts)
                order = np.argsort(key)
                key, tf = key[order], tf[order]
                offsets = np.searchsorted(key, np.arange(len(lengths) + 1) * size).astype(np.int32)
                row = pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array((key % size).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf)),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )
                yield row.filter(pa.array(np.array(lengths) > 0))

    return run


class Slice:
    """Impact lists of a few documents, and the positions that documents have in them."""

    def __init__(self, docs: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        self.docs = docs
        by_impact = np.lexsort((doc, -impact, term))
        self.by_impact, self.impact = doc[by_impact], impact[by_impact]
        held = term[by_impact]
        starts = np.flatnonzero(np.diff(held, prepend=-1))
        self.list_of = dict(zip(held[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(held)])))
        self.memo: dict[int, tuple] = {}

    def of(self, term: int) -> tuple | None:
        """Documents and impacts of a term's list, highest impact first, and what finds a document's position."""
        if term not in self.list_of:
            return None
        if term not in self.memo:
            a, b = self.list_of[term]
            docs = self.by_impact[a:b]
            if len(docs) * DENSE_SHARE >= len(self.docs):
                finder = np.full(len(self.docs), -1, dtype=np.int32)
                finder[docs] = np.arange(len(docs), dtype=np.int32)
            else:
                order = np.argsort(docs)
                finder = (docs[order], order)
            self.memo[term] = docs, self.impact[a:b], finder
        return self.memo[term]


def positions(finder, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the documents are in a list, and where."""
    if isinstance(finder, np.ndarray):
        at = finder[docs]
        hit = np.flatnonzero(at >= 0)
        return hit, at[hit]
    held, order = finder
    at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
    hit = np.flatnonzero(held[at] == docs)
    return hit, order[at[hit]]


def best_positions(part: Slice, query: list[tuple[int, int]], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the slice among which are its ``top`` best with a score of ``floor`` at least, and their scores.

    ``query`` has pairs (term, factor); a document's score is the sum of factor times impact over the terms.
    """
    lists = [(found, factor) for term, factor in query if factor > 0 and (found := part.of(term))]
    best = [0] * len(lists)
    seen_at = [np.zeros(len(found[0]), dtype=bool) for found, _ in lists]
    seen = np.zeros(len(part.docs), dtype=bool)
    kept, scores, step = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), FIRST_STEP
    while True:
        fresh = []
        for (found, _), at in zip(lists, best):
            docs = found[0][at : at + step]
            docs = docs[~seen[docs]]
            seen[docs] = True
            fresh.append(docs)
        docs = np.concatenate(fresh) if fresh else kept[:0]
        if not len(docs):
            break  # every list is read to its end
        score = np.zeros(len(docs), dtype=np.int64)
        bound = 0
        for i, ((_, impacts, finder), factor) in enumerate(lists):
            hit, at = positions(finder, docs)
            score[hit] += impacts[at] * factor
            seen_at[i][at] = True
            rest = seen_at[i][best[i] :]
            ahead = int(rest.argmin()) if len(rest) else 0
            best[i] = best[i] + ahead if len(rest) and not rest[ahead] else len(seen_at[i])
            if best[i] < len(impacts):
                bound += int(impacts[max(best[i] - 1, 0)]) * factor
        kept, scores = np.concatenate([kept, docs]), np.concatenate([scores, score])
        if len(scores) >= top:
            kth = int(np.partition(scores, len(scores) - top)[len(scores) - top])
            held = scores >= max(kth, floor)  # ties stay: the id decides later
            kept, scores = kept[held], scores[held]
            if bound < kth:
                break
        if bound < floor:
            break
        step *= 2
    held = (scores > 0) & (scores >= floor)
    return kept[held], scores[held]


def _first(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


def _searcher(
    queries: list[tuple[int, list[tuple[int, int]]]], weights: np.ndarray, n_docs: int, n_terms: int, top: int
) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def search(rows: list[tuple[np.ndarray, ...]]) -> None:
            ids, n, sizes, term, tf = (np.concatenate(c) for c in zip(*rows))
            m = 75 + 25 * n * n_docs // n_terms
            doc = np.repeat(np.arange(len(ids)), sizes)
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
            part = Slice(ids, doc, term, impact)
            for number, query in queries:
                before = found.get(number)
                floor = int(before[1][-1]) if before is not None and len(before[1]) == top else 1
                docs, scores = best_positions(part, query, top, floor)
                if len(docs):
                    docs = ids[docs]
                    if before is not None:
                        docs, scores = np.concatenate([before[0], docs]), np.concatenate([before[1], scores])
                    found[number] = _first(docs, scores, top)

        rows, docs, postings = [], 0, 0
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            step = 1024
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                term, tf = part.column(2), part.column(3)
                sizes = term.value_lengths().to_numpy()
                rows.append(
                    (
                        part.column(0).to_numpy(),
                        part.column(1).to_numpy(),
                        sizes,
                        term.flatten().to_numpy(),
                        tf.flatten().to_numpy().astype(np.int64),
                    )
                )
                docs, postings = docs + len(sizes), postings + int(sizes.sum())
                if docs >= SLICE_DOCS or postings >= SLICE_POSTINGS:
                    search(rows)
                    rows, docs, postings = [], 0, 0
        if rows:
            search(rows)
        for number, (ids, scores) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), number)), pa.array(ids), pa.array(scores)], names=["query", "doc_id", "score"]
            )

    return run


def _blocks(items: DataFrame) -> Iterator[tuple[dict[bytes, int], list[tuple[int, list[tuple[int, int]]]]]]:
    """Queries in blocks: the vocabulary, and (query, pairs of term and occurrences) of each."""
    vocabulary: dict[bytes, int] = {}
    queries: list[tuple[int, list[tuple[int, int]]]] = []
    for row in items.toLocalIterator():
        held = Counter(terms(row["text"]))
        if not held:
            continue
        if queries and len(vocabulary.keys() | held.keys()) > BLOCK_TERMS:
            yield vocabulary, queries
            vocabulary, queries = {}, []
        queries.append((row["query"], [(vocabulary.setdefault(t, len(vocabulary)), c) for t, c in held.items()]))
    if queries:
        yield vocabulary, queries


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the documents that rank highest for each item."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = settle(
        items.select(
            F.monotonically_increasing_id().alias("query"),
            F.col("item_id").cast("long").alias("item_id"),
            F.col("text").cast("string").alias("text"),
        ),
        "ranking-items",
    )
    found = spark.createDataFrame([], FOUND_SQL)
    for vocabulary, queries in _blocks(asked):
        index = settle(narrow.mapInArrow(_indexer(vocabulary), INDEX_SQL), "ranking-index")
        total = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            break
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # of one block
            weights[row["term"]] = weight(total["docs"], row["count"])
        step = index.mapInArrow(_searcher(queries, weights, total["docs"], total["terms"], top), FOUND_SQL)
        found = found.union(settle(step, "ranking-found"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
