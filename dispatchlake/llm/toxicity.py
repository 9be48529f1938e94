"""Toxicity from a learned lexicon: misspelled terms by a Levenshtein automaton, abuse apart from quotation.

The lexicon is learned from labelled documents: words and word beginnings (stems, written ``abcd*``) that
stand, outside of quotation, in toxic documents far more often than chance explains, whatever the language. It goes into a trie; for
a word that is no term itself, a bit-parallel Levenshtein automaton of the word runs along the trie and cuts
branches that are too far. Each hit is judged by a window of words around it: quotation marks or words of
reporting beside it make it a quotation, a second person makes it an address. A logistic model over these
counts gives the score.

Only labels whose document's ``crc32(doc_id as text) mod 3`` is not 1 are learned from, at most ``sample``
of either class, by hash of the id: the bound of the fit. All documents are scored, whole.

Defined results: a null or empty text has no hits and the score of that; a null id counts as held out; repeated
rows are scored each; several labels of one document count as toxic if one is; without labels of both classes
every score is the share of toxic ones (0.5 without any); other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlake.llm.batches import lean
from dispatchlake.session import settle

SAMPLE = 20_000  # labelled documents of each class that the fit sees at most
CUT_SCORE = 0.7
STEMS = (3, 4, 5, 6, 7, 8)
MIN_PURE = 0.97  # share of toxic documents among those with a term outside of quotation
MIN_CLEAN = 2  # clean documents from which a word beside a term is a plain word
EVIDENCE = 3.0  # nats beyond what the number of candidates asks for
FUZZY_FROM = 5  # letters from which a misspelling counts
EDITS = 1
WINDOW = 4  # words on either side of a hit
MEMO = 200_000
HELD_TERMS = 200_000  # of a counting task

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”„«»‘’]")
REPORTING = frozenset("said says called term word quote quoted wrote sagte sagt wort mot dit dijo palabra".split())
ADDRESS = frozenset("you your youre yourself u ur du dich dein ihr euch tu te toi vous votre usted tus".split())

FEATURES = ("exact", "fuzzy", "quoted", "addressed")
FEATURE_SQL = "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES)
TERMS_SQL = "term string, toxic long, docs long"

Batches = Iterator[pa.RecordBatch]


class Lexicon:
    """Terms in a trie, looked up exactly, by stem, or within ``EDITS`` edits.

    ``spared`` words are plain words near a term: they are no misspellings, others near that term are.
    """

    def __init__(self, terms: list[str], spared: frozenset[str] = frozenset()) -> None:
        self.spared = spared
        self.words = {t for t in terms if not t.endswith("*")}
        self.stems = {t[:-1] for t in terms if t.endswith("*")}
        self.trie: dict = {}
        for term in self.words:
            if len(term) >= FUZZY_FROM:
                node = self.trie
                for c in term:
                    node = node.setdefault(c, {})
                node[""] = term
        fuzzy = [t for t in self.words if len(t) >= FUZZY_FROM]
        self.heads = {(len(t), t[: len(t) // 2]) for t in fuzzy}
        self.tails = {(len(t), t[len(t) // 2 :]) for t in fuzzy}
        self.memo: dict[str, int] = {}

    def may_be_near(self, word: str) -> bool:
        """False if no term can be within one edit: that edit leaves the first or the last half of a term whole."""
        return any(
            (n, word[: n // 2]) in self.heads or (n, word[-(n - n // 2) :]) in self.tails
            for n in range(len(word) - EDITS, len(word) + EDITS + 1)
        )

    def near(self, word: str, edits: int = EDITS) -> set[str]:
        """The terms of the trie within ``edits`` edits.

        Bit i of state e: the first i letters of the word match the path so far with e edits.
        """
        places: dict[str, int] = {}
        for i, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << (i + 1)
        whole, full = 1 << len(word), (1 << (len(word) + 1)) - 1
        start = [1]
        for _ in range(edits):
            start.append(start[-1] | start[-1] << 1 & full)
        stack, found = [(self.trie, start)], set()
        while stack:
            node, state = stack.pop()
            for c, child in node.items():
                if not c:
                    if state[-1] & whole:
                        found.add(child)
                    continue
                here = places.get(c, 0)
                after = [state[0] << 1 & here]
                for e in range(1, edits + 1):
                    after.append(
                        (state[e] << 1 & here | state[e - 1] | state[e - 1] << 1 | after[e - 1] << 1) & full
                    )
                if after[-1]:
                    stack.append((child, after))
        return found

    def look(self, word: str) -> int:
        """0: no term, 1: a term, 2: a misspelled one."""
        kind = self.memo.get(word)
        if kind is None:
            if word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) > n):
                kind = 1
            elif word in self.spared:
                kind = 0
            else:
                kind = 2 * (len(word) >= FUZZY_FROM - EDITS and self.may_be_near(word) and bool(self.near(word)))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = kind
        return kind

    def hits(self, text: str) -> tuple[int, int, int, int]:
        """Exact, misspelled, quoted and addressed hits of a whole text."""
        low = text.lower()
        words = WORD.findall(low)
        memo, look = self.memo, self.look
        kinds = {w: k for w in set(words) if (k := memo.get(w) if w in memo else look(w))}
        if not kinds:
            return 0, 0, 0, 0
        exact = fuzzy = quoted = addressed = 0
        spans = [m.span() for m in WORD.finditer(low)]
        for i, w in enumerate(words):
            kind = kinds.get(w)
            if not kind:
                continue
            first, last = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
            around = words[first:i] + words[i + 1 : last]
            before, behind = low[spans[first][0] : spans[i][0]], low[spans[i][1] : spans[last - 1][1]]
            if (QUOTES.search(before) and QUOTES.search(behind)) or not REPORTING.isdisjoint(around):
                quoted += 1
                continue
            addressed += not ADDRESS.isdisjoint(around)
            exact += kind == 1
            fuzzy += kind == 2
        return exact, fuzzy, quoted, addressed


def unquoted(low: str) -> set[str]:
    """The words of a text in lower case that stand outside of quotation at least once, as ``Lexicon.hits`` sees it."""
    words = WORD.findall(low)
    reporting = [i for i, w in enumerate(words) if w in REPORTING]
    quotes = QUOTES.search(low) is not None
    if not reporting and not quotes:
        return set(words)
    quoted = {j for i in reporting for j in range(i - WINDOW, i + WINDOW + 1) if j != i}
    if quotes:
        spans = [m.span() for m in WORD.finditer(low)]
        starts = [s for s, _ in spans]
        gaps = sorted({bisect_left(starts, m.start()) for m in QUOTES.finditer(low)})  # before which word
        for a in gaps:  # a word i has a quote before it at a and one behind it at b
            for b in gaps[bisect_left(gaps, a + 1) : bisect_left(gaps, a + 2 * WINDOW + 1)]:
                quoted.update(i for i in range(a, b) if 0 < a and b < len(words) and i - a < WINDOW and b - i <= WINDOW)
    return {w for i, w in enumerate(words) if i not in quoted}


def _count_terms(batches: Batches) -> Batches:
    """Partial counts of terms outside of quotation; they go out whenever many terms are held, so a task's memory is bounded."""
    toxic, docs = Counter(), Counter()

    def out() -> pa.RecordBatch:
        columns = (list(docs), pa.string()), ([toxic[t] for t in docs], pa.int64()), (list(docs.values()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(*c) for c in columns], names=["term", "toxic", "docs"])

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = unquoted((text or "").lower())
            terms = words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))
            docs.update(terms)
            if label:
                toxic.update(terms)
            if len(docs) > HELD_TERMS:
                yield out()
                toxic.clear()
                docs.clear()
    if docs:
        yield out()


def _words_near(terms: list[str]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        lexicon = Lexicon(terms)
        for batch in batches:
            near = [word for word in batch.column(0).to_pylist() if lexicon.look(word) == 2]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["term"])

    return run


def _featurer(terms: list[str], spared: list[str], keep: list[str] = ()) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        lexicon = Lexicon(terms, frozenset(spared))
        for batch in batches:
            rows = [lexicon.hits(t or "") for t in batch.column("text").to_pylist()]
            columns = zip(*rows) if rows else [()] * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), *(batch.column(k) for k in keep)],
                names=["doc_id", *FEATURES, *keep],
            )

    return run


def held_out() -> Column:
    """Whether a document's label is kept for the test."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_sample(labels: DataFrame, sample: int) -> DataFrame:
    """Ids and labels to learn from: at most ``sample`` of each class, so safe to broadcast."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    parts = [
        known.filter(rule).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", F.lit(v).alias("toxic"))
        for rule, v in (("toxic > 0", 1), ("toxic <= 0", 0))
    ]
    return parts[0].union(parts[1])


def specific(docs: dict[str, int], most: float = 0.9) -> list[str]:
    """Terms without stems of which one longer term has nearly all documents: the longer one says more."""
    largest: dict[str, int] = {}
    for term, n in docs.items():
        word = term.rstrip("*")
        for k in STEMS:
            if len(word) > k or (len(word) == k and not term.endswith("*")):
                largest[word[:k] + "*"] = max(largest.get(word[:k] + "*", 0), n)
    return sorted(t for t, n in docs.items() if not t.endswith("*") or largest.get(t, 0) < most * n)


def learn_terms(texts: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], list[str]]:
    """Terms with enough evidence, without those that a shorter stem covers; and the spared words near them.

    A spared word stands in ``MIN_CLEAN`` clean documents or more, and in toxic ones no more often than chance
    has it. Only occurrences outside of quotation count, for terms and for spared words. Both come
    from the bounded sample, and so are bounded themselves.
    """
    if not n_toxic or not n_clean:
        return [], []
    base = n_toxic / (n_toxic + n_clean)
    counted = settle(
        texts.mapInArrow(lean(_count_terms), TERMS_SQL)
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs")),
        "toxicity-terms",
    )
    least = math.ceil(EVIDENCE / -math.log(base))
    share = F.col("toxic") / F.col("docs")
    clean = F.col("docs") - F.col("toxic")
    nats = F.col("toxic") * F.log(share / base) + F.when(clean > 0, clean * F.log((1 - share) / (1 - base))).otherwise(0.0)
    strong = counted.filter((F.col("toxic") >= least) & (share >= MIN_PURE)).withColumn("nats", nats)
    # The candidates that the evidence has to beat: at most the distinct terms of the bounded sample.
    candidates = counted.filter(F.col("docs") >= least).count()
    rows = strong.filter(F.col("nats") >= math.log(max(candidates, 1)) + EVIDENCE).select("term", "docs").toLocalIterator()
    docs = {r["term"]: r["docs"] for r in rows}
    terms = specific(docs)
    stems = {t[:-1] for t in terms if t.endswith("*")}
    covered = lambda t: any(t.rstrip("*")[:n] in stems for n in STEMS if len(t.rstrip("*")) > n)
    terms = [t for t in terms if not (t.endswith("*") and covered(t))]
    plain = (clean >= MIN_CLEAN) & (share <= base) & F.expr("length(term) >= 4 and not endswith(term, '*')")
    spared = counted.filter(plain).select("term").mapInArrow(lean(_words_near(terms)), "term string")
    return terms, sorted(r["term"] for r in spared.toLocalIterator())


def design(x: np.ndarray) -> np.ndarray:
    """Model inputs from hit counts: whether there are any of a kind, and how many on a log scale."""
    x = np.asarray(x, dtype=float).reshape(-1, len(FEATURES))
    return np.hstack([np.ones((len(x), 1)), x > 0, np.log1p(x)])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge keeps separable data finite."""
    z = design(x)
    share = (y.sum() + 0.5) / (len(y) + 1)
    w = np.zeros(z.shape[1])
    w[0] = math.log(share / (1 - share))
    pull = np.full(z.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(pull), z.T @ (y - p) - pull * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[str], list[float]]:
    """Terms, spared terms and weights, from the bounded sample alone."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = settle(training_sample(labels, sample), "toxicity-sample")
    seen = narrow.join(F.broadcast(chosen), "doc_id")
    sizes = {r["toxic"]: r["count"] for r in seen.groupBy("toxic").count().toLocalIterator()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    terms, spared = learn_terms(seen.select("text", "toxic"), n_toxic, n_clean)
    if n_toxic and n_clean:
        counted = seen.mapInArrow(lean(_featurer(terms, spared, ["toxic"])), f"{FEATURE_SQL}, toxic int")
        rows = counted.groupBy(*FEATURES, "toxic").count().collect()  # of the sample: bounded
        x = np.repeat([[r[f] for f in FEATURES] for r in rows], [r["count"] for r in rows], axis=0)
        y = np.repeat([float(r["toxic"]) for r in rows], [r["count"] for r in rows])
        return terms, spared, fit(x, y).tolist()
    share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    return terms, spared, [math.log(share / (1 - share)), *[0.0] * (2 * len(FEATURES))]


def _score(weights: list[float]) -> Column:
    logit = F.lit(weights[0])
    for i, f in enumerate(FEATURES):
        logit = logit + F.when(F.col(f) > 0, F.lit(weights[1 + i])).otherwise(0.0)
        logit = logit + F.log1p(F.col(f).cast("double")) * F.lit(weights[1 + len(FEATURES) + i])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and the hit counts behind the score."""
    terms, spared, weights = learned(docs, labels, sample)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = narrow.mapInArrow(lean(_featurer(terms, spared)), FEATURE_SQL).withColumn("score", _score(weights))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"),
        *FEATURES,
    )


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents below the cut, all their columns as they were; narrow, so no text is shuffled."""
    terms, spared, weights = learned(docs, labels, sample)
    model = np.array(weights)

    def run(batches: Batches) -> Batches:
        lexicon = Lexicon(terms, frozenset(spared))
        for batch in batches:
            hits = [lexicon.hits(str(t) if t is not None else "") for t in batch.column("text").to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(design(hits) @ model, -700, 700)))
            yield batch.filter(pa.array(scores < CUT_SCORE))

    return docs.mapInArrow(lean(run), docs.schema)
