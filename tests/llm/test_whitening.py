"""Whitening against numpy, with the edge cases that its docstring defines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlake.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x long, values string, index long, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3) for i, v in rows], SCHEMA)


def brute(vectors):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, (x - s / n) @ axes / np.sqrt(values), values / values.sum()


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 256)  # many blocks
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((700, 20)) @ rnd.standard_normal((20, 20))
    x[40:300] = x[3]  # one vector holds a third of the rows
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 20), (903, [float("inf")] * 20), (904, [])]
    repeated = [(5, x[5].tolist()), (5, x[6].tolist()), (None, x[7].tolist())]
    got = whitening.whiten(table(spark, rows + odd + repeated)).toPandas()
    n, deviation, white, explained = brute(x)
    assert len(got) == (700 + 3) * 16 and set(got.component) == set(range(1, 17))
    assert (got.n == n).all() and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    once = got[(got.vec_id < 700) & (got.vec_id != 5)]
    for c in range(16):
        mine = once[once.component == c + 1].sort_values("vec_id")
        ids = mine.vec_id.astype(int).to_numpy()
        assert len(ids) == 699
        assert mine.deviation.tolist() == [deviation[i] for i in ids]
        assert abs(mine.explained.iloc[0] - explained[c]) < 1e-9
        w = mine.whitened.to_numpy()
        sign = np.sign(w[0] * white[ids[0], c])
        assert np.abs(w * sign - white[ids, c]).max() < 1e-6
    assert got.vec_id.isna().sum() == 16 and (got.vec_id == 5).sum() == 48


def test_whitening_of_few_equal_and_none(spark):
    assert whitening.whiten(table(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(table(spark, [(0, None)])).count() == 0
    empty = whitening.whiten(table(spark, []))
    assert empty.count() == 0 and "whitened" in empty.columns
    line = whitening.whiten(table(spark, [(0, [0.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0])])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(0, [0.0, 0.0]), (1, [1.0])])).count()


def test_whitening_takes_every_row_of_the_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = whitening.whiten(df)
    assert got.count() == 16 * df.filter(whitening.finite("embedding")).count()
    assert got.agg(F.max("identity_error")).first()[0] < 1e-4
