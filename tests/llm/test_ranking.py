"""Ranked search against scoring every document, with the edge cases that its docstring defines."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from dispatchlake.llm import ranking

DOC = "doc_id long, text string, n long, score long, query long, rank int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], DOC)


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, query long, score long")


def split(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(docs, asked, top=20):
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    out = []
    for item, text in asked:
        scored = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in split(text):
                if t in c:
                    df = sum(t in x for _, x in held)
                    score += ranking.weight(n_docs, df) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_equals_scoring_all(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SLICE_DOCS", 100)
    monkeypatch.setattr(ranking, "LONG_TEXT", 5000)
    rnd = random.Random(2)
    word = lambda: f"w{int(rnd.paretovariate(0.7)) % 300}"
    docs = [(i, " ".join(word() for _ in range(rnd.choice([1, 5, 30, 90])))) for i in range(500)]
    docs += [(600 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(700, None), (701, ""), (702, " -;\t"), (703, " ".join(word() for _ in range(9000)))]
    docs += [(7, docs[8][1]), (7, docs[7][1]), (None, docs[7][1]), (704, "Ünï w1W2\x00w3|W4 W4")]
    asked = [(i, " ".join(word() for _ in range(rnd.choice([1, 4, 40])))) for i in range(30)]
    asked += [(40, docs[7][1]), (41, None), (42, ""), (43, "nowhere"), (44, "w1 W1 w1 w2"), (45, "ünï w4"), (None, "w5")]
    got = found(ranking.search(documents(spark, docs), items(spark, asked)))
    assert got == brute(docs, asked)


def test_blocks_of_queries_and_repeated_items(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 3)
    docs = [(i, f"a{i % 3} b{i % 5} c") for i in range(40)]
    asked = [(1, "a1 b2"), (2, "a0 a1 a2 b0 b1"), (3, "c"), (1, "b4 b4")]
    assert found(ranking.search(documents(spark, docs), items(spark, asked), 5)) == brute(docs, asked, 5)


def test_search_of_empty_tables(spark):
    none = ranking.search(documents(spark, []), items(spark, [(1, "a")]))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranking.search(documents(spark, [(1, "a")]), items(spark, [])).count() == 0


def test_search_stops_before_the_end_of_its_lists():
    rnd = np.random.default_rng(1)
    docs, terms = np.arange(10_000), 4
    part = ranking.Slice(
        docs, np.tile(docs, terms), np.repeat(np.arange(terms), len(docs)), rnd.pareto(1, len(docs) * terms).astype(np.int64)
    )
    kept, scores = ranking.best_positions(part, [(t, 1) for t in range(terms)], 20, 1)
    whole = np.zeros(len(docs), dtype=np.int64)
    for t in range(terms):
        whole[part.of(t)[0]] += part.of(t)[1]
    assert sorted(scores.tolist())[-20:] == sorted(whole.tolist())[-20:]
    assert len(kept) < 1000


@pytest.mark.parametrize("step", [1, 3, 256])
def test_best_positions_equal_full_scores(monkeypatch, step):
    monkeypatch.setattr(ranking, "FIRST_STEP", step)
    rnd = np.random.default_rng(step)
    for _ in range(60):
        docs, terms = int(rnd.integers(1, 60)), int(rnd.integers(1, 6))
        held = rnd.random((docs, terms)) < rnd.random(terms)
        doc, term = np.nonzero(held)
        impact = rnd.integers(0, 30, len(doc))
        part = ranking.Slice(np.arange(docs), doc, term, impact)
        factor = rnd.integers(0, 4, terms).tolist()
        whole = np.zeros(docs, dtype=np.int64)
        np.add.at(whole, doc, impact * np.array(factor)[term])
        floor = int(rnd.integers(1, 40))
        kept, scores = ranking.best_positions(part, list(enumerate(factor)), 5, floor)
        assert (whole[kept] == scores).all() and len(set(kept.tolist())) == len(kept)
        best = [i for i in np.lexsort((np.arange(docs), -whole))[:5] if whole[i] >= floor]
        assert set(best) <= set(kept.tolist())
