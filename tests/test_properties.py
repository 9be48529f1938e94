"""Random inputs against brute force."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dispatchlake.functions.rates import mean_2dp, percent_2dp
from dispatchlake.operators import keyed

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50), st.sampled_from("xyz")), max_size=40)
SCHEMA = "order_id int, amount int, status string"


def half_up(value: Fraction) -> float:
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


@FEW
@given(target=ROWS, source=ROWS)
def test_merge_equals_a_dictionary(spark, target, source):
    held = {r[0]: r for r in target}
    load = {}
    for r in source:
        load[r[0]] = max(load.get(r[0], r), r)
    expected = sorted({**held, **load}.values())
    got = keyed.merge_upsert(
        spark.createDataFrame(list(held.values()), SCHEMA), spark.createDataFrame(source, SCHEMA), ["order_id"]
    )
    assert sorted(map(tuple, got.collect())) == expected


@FEW
@given(rows=ROWS)
def test_latest_equals_a_dictionary(spark, rows):
    numbered = [(*r, i) for i, r in enumerate(rows)]
    best = {}
    for r in numbered:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: (x[1], x[3]))
    got = keyed.latest_per_key(spark.createDataFrame(numbered, SCHEMA + ", offset int"), ["order_id"], ["amount", "offset"])
    assert sorted(map(tuple, got.collect())) == sorted(best.values())


@FEW
@given(pairs=st.lists(st.tuples(st.integers(0, 10**13), st.integers(1, 10**9)), min_size=1, max_size=60))
def test_rates_are_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, n long").select(
        "a",
        "n",
        mean_2dp(F.col("a").cast("decimal(28,2)"), F.col("n")).alias("mean"),
        percent_2dp(F.least("a", "n"), F.col("n")).alias("pct"),
    )
    for r in df.collect():
        assert r.mean == half_up(Fraction(r.a, r.n))
        assert r.pct == half_up(Fraction(100 * min(r.a, r.n), r.n))


def test_rates_of_nothing_are_null(spark):
    row = spark.range(1).select(percent_2dp(F.lit(0), F.lit(0)).alias("p")).first()
    assert row.p is None
