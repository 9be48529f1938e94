"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists all vocabulary pieces in a text, ordered by their end. For each place the
dynamic programme keeps the best score of a segmentation up to there and its number of pieces, nothing else.
The tokenizer's tie rule: a later start replaces an earlier one only with a greater score, so among equal
scores the longest piece wins. A character that no piece covers alone may also be unknown, at ten below the
least score, and counts as its UTF-8 bytes.

Spaces are written as the piece mark, one in front of the text. No piece of the vocabulary reaches from
another character into a mark (checked when it is loaded), so a text falls apart before every such mark, and
the counts of its parts add up. Scores of the public vocabulary are whole numbers, so no sum is rounded and
the parts' best paths are those of the text. Counts of parts are kept, in two generations of bounded size.

Defined results: a null or empty text has no tokens; repeated rows are counted each; a null id is carried
through; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
GENERATION = 400_000
LONG_PART = 64
PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def read_pieces(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, without control, unknown and byte pieces."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    ids = range(model.get_piece_size())
    usual = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in usual]


class Counter:
    """Counts tokens of texts with one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        whole = all(s == int(s) for _, s in pieces)
        self.parted = whole and not any(MARK in p.lstrip(MARK) for p, _ in pieces)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def viterbi(self, text: str) -> int:
        """The number of tokens on the best path through a marked text."""
        n = len(text)
        best: list[float | None] = [0.0, *[None] * n]
        count = [0] * (n + 1)
        single, unknown = self.single, self.unknown
        matches = self.automaton.iter(text)
        end, match = next(matches, (n, None))
        for j in range(1, n + 1):
            top, pieces, first = None, 0, j
            if text[j - 1] not in single:
                top, pieces, first = best[j - 1] + unknown, count[j - 1] + len(text[j - 1].encode("utf-8", "replace")), j - 1
            while end == j - 1 and match is not None:
                length, score = match
                start = j - length
                total = best[start] + score
                if top is None or total > top or (total == top and start < first):
                    top, pieces, first = total, count[start] + 1, start
                end, match = next(matches, (n, None))
            best[j], count[j] = top, pieces
        return count[n]

    def part(self, part: str) -> int:
        n = self.old.get(part)
        if n is None:
            n = self.viterbi(part)
        if len(part) <= LONG_PART:
            self.young[part] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = (MARK + text).replace(" ", MARK)
        if not self.parted:
            return self.viterbi(marked)
        parts = PART.findall(marked)
        known = list(map(self.young.get, parts))
        if None in known:
            known = [self.part(p) if n is None else n for p, n in zip(parts, known)]
            if len(self.young) > GENERATION:
                self.old, self.young = self.young, {}
        return sum(known)


_COUNTERS: dict[str | None, Counter] = {}


def counter(path: str | None = None) -> Counter:
    """One counter for each vocabulary file and worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(read_pieces(path))
    return _COUNTERS[path]


def _counting(path: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            counts = [count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_counting(vocabulary), "doc_id long, n_tokens long")
