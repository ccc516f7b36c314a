"""Sums and means that do not depend on the order of rows."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_CHECK
from ventilake import catalog
from ventilake.functions.exact import exact_mean, exact_sum
from ventilake.plans import daily
from ventilake.plans import household as t4
from ventilake.sources import driver_tables as dtab

SCHEMA = "k int, v double"


def _sums(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = df.groupBy("k").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()
    return {r["k"]: (r["s"], r["m"]) for r in out}


def _half_up(v):
    """The value as a decimal with ten digits after the point, from its shortest text."""
    return Decimal(repr(v)).quantize(Decimal("1e-10"), rounding="ROUND_HALF_UP")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9, allow_subnormal=False), min_size=1, max_size=40), st.randoms())
def test_sum_equals_decimals_in_any_order(spark, values, rnd):
    want = float(sum(map(_half_up, values), Decimal(0)))
    for parts in (1, 5):
        rnd.shuffle(values)
        s, m = _sums(spark, [(1, v) for v in values], parts)[1]
        assert s == want and m == want / len(values)


def test_cancelling_and_tied_values(spark):
    rows = [(1, 1e9), (1, 0.1), (1, 0.2), (1, -1e9)] * 50 + [(2, 11.5656), (2, 11.5657)] * 30
    random.Random(4).shuffle(rows)
    for parts in (1, 3, 16):
        out = _sums(spark, rows, parts)
        assert out[1][0] == float(Fraction(15)) and out[2] == (float(Decimal("693.939")), 11.56565)


def test_values_without_a_decimal_and_nulls(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1.0), (1, nan), (2, inf), (2, 5.0), (3, inf), (3, -inf), (4, None), (5, None), (5, 2.5), (6, 1e18), (6, 1.0), (7, 1e300)]
    out = _sums(spark, rows, 2)
    assert math.isnan(out[1][0]) and out[2] == (inf, inf) and math.isnan(out[3][0])
    assert out[4] == (None, None) and out[5] == (2.5, 2.5) and out[6] == (1e18, 5e17) and out[7] == (1e300, 1e300)


@pytest.mark.parametrize("job", ["balance", "range"])
def test_household_rows_are_the_same_bits_for_any_partitioning(spark, job):
    dims = catalog._dimensions(spark, SF_CHECK)
    raw = dtab.logement_readings(spark, SF_CHECK)
    lo, hi = catalog._day_span(raw)
    seen = []
    for parts in (1, 7, 64):
        some = raw.repartition(parts, F.xxhash64("rid", F.lit(parts))).sortWithinPartitions(F.xxhash64("rid", F.lit(parts)))
        out = t4.household_balance(some, dims) if job == "balance" else daily.run_range(some, dims, lo, hi)
        seen.append(sorted(map(str, out.collect())))
    assert len(seen[0]) > 5000 and seen[0] == seen[1] == seen[2]
