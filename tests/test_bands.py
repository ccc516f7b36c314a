"""Breakpoints with their winners against a scan of all bands."""

import random

import pytest
from pyspark.sql import functions as F

from test_household import _as_set
from ventilake import catalog
from ventilake.operators import bands as bd
from ventilake.operators import lookups as lk
from ventilake.plans import household as t4
from ventilake.sources import driver_tables as dtab

from conftest import SF_SMALL

BANDS = "capteur_facteur string, borne_inf double, borne_sup double, fct1 double, fct2 double"
NAMES = ("fct1", "fct2")


def _bands(rnd):
    """Overlaps, gaps, ties in every column, empty and null ends, and one sensor without a band."""
    rows = []
    for s, n in (("a", 1), ("b", 6), ("c", 40), ("d", 300), ("e", 90)):
        for _ in range(n):
            low = rnd.choice([None, float(rnd.randrange(40)), rnd.random() * 40])
            size = rnd.choice([0.0, 0.5, 3.0, -1.0, 15.0, 60.0, float(rnd.randrange(9))])
            rows.append((s, low, (low or 0.0) + size if rnd.random() < 0.95 else None, float(rnd.randrange(3)), rnd.choice([None, 1.0, 2.0])))
    rows += rows[5:20] + [("f", 3.0, 3.0, 1.0, 1.0), (None, 0.0, 9.0, 1.0, 1.0), ("g", float("-inf"), float("inf"), 7.0, 7.0)]
    return rows


def _scan(rows, s, x):
    clean = [tuple(0.0 if v is None else v for v in r[1:]) for r in rows if r[0] is not None and r[0] == s]
    held = [b for b in clean if x is not None and b[0] <= x < b[1]]
    return max(held) if held else None


@pytest.mark.parametrize("most", [1000, 30, 1, 0])
def test_equals_a_scan_of_all_bands(spark, most):
    rnd = random.Random(7)
    rows = _bands(rnd)
    values = sorted({v for r in rows for v in r[1:3] if v is not None}) + [rnd.random() * 60 - 5 for _ in range(150)]
    values += [None, float("nan"), float("inf"), float("-inf")]
    readings = [(k, s, v) for k, (s, v) in enumerate((s, v) for s in ["a", "b", "c", "d", "e", "f", "g", "z", None] for v in values)]
    df = spark.createDataFrame(readings, "rid long, capteur string, x double")
    out = lk.band_lookup(df, spark.createDataFrame(rows, BANDS), NAMES, "capteur", "x", "b_", most)
    assert out.columns == ["rid", "capteur", "x", "b_matched", "b_borne_inf", "b_borne_sup", "b_fct1", "b_fct2"]
    got = {r["rid"]: tuple(r)[4:] if r["b_matched"] else None for r in out.collect()}
    assert len(got) == len(readings)
    for k, s, v in readings:
        assert got[k] == _scan(rows, s, v), (s, v)


def test_pages_of_several_breakpoints(spark):
    rows = _bands(random.Random(9))
    pages = bd.band_pages(spark.createDataFrame(rows, BANDS), NAMES, most=50, page=7)
    sizes = [len(r["points"]) for r in pages.pages.collect()]
    assert max(sizes) <= 7 and len(sizes) > 20
    assert {r["capteur_facteur"] for r in pages.starts.collect()} == {"d", "e"}
    df = spark.createDataFrame([(s, float(v) / 3) for s in "cde" for v in range(-9, 180)], "capteur string, x double")
    out = bd.paged_winner(df, pages, "capteur", F.col("x"), "w", page=7).collect()
    for r in out:
        want = _scan(rows, r["capteur"], r["x"]) if r["capteur"] in "de" else None
        assert (tuple(r["w"]) if r["w"] else None) == want, (r["capteur"], r["x"])


def test_a_million_bands_of_one_sensor(spark):
    n = 1_000_000
    k = F.col("id").cast("double")
    # bands of length 1 to 50 that start at every whole number but 0, and one over all of them
    bands = spark.range(1, n).select(F.lit("s").alias("capteur_facteur"), k.alias("borne_inf"), (k + 1 + F.col("id") % 50).alias("borne_sup"), k.alias("fct1"))
    bands = bands.union(spark.range(1).select(F.lit("s"), F.lit(-5.0), F.lit(2.0 * n), F.lit(-1.0)))
    bands = bands.union(spark.range(1).select(F.lit("t"), F.lit(0.0), F.lit(1.0), F.lit(4.0)))
    df = spark.range(-10, 2 * n + 10, 997).select(F.lit("s").alias("capteur"), (F.col("id") + 0.25).alias("x"))
    df = df.union(spark.createDataFrame([("t", 0.5), ("t", 1.0)], "capteur string, x double"))
    pages = bd.band_pages(bands, ("fct1",))
    assert pages.pages.agg(F.max(F.size("points"))).first()[0] <= bd.PAGE
    # what is held as arrays of one sensor: only the small one's
    assert [r["capteur_facteur"] for r in bd.band_index(bands, ("fct1",), pages).collect()] == ["t"]
    out = lk.band_lookup(df, bands, ("fct1",), "capteur", "x", "b_")
    want = F.when(F.col("capteur") == "t", F.when(F.col("x") < 1, 4.0)).otherwise(
        F.when((F.col("x") < -5) | (F.col("x") >= 2 * n), None)
        .when((F.col("x") >= 1) & (F.col("x") < n), F.floor("x").cast("double")).otherwise(
            # beyond the last start: the latest band that reaches so far
            F.when(F.col("x") < n + 49, F.lit(None)).otherwise(-1.0))
    )
    checked = out.where((F.col("x") < n) | (F.col("x") >= n + 49)).where(~F.col("b_fct1").eqNullSafe(want))
    assert checked.count() == 0 and out.count() == df.count()


def test_household_transform_with_pages(spark):
    brut, dims = catalog._brut_logement(spark, SF_SMALL), dtab.dimensions(spark, SF_SMALL)
    pages = t4.band_pages(dims, most=2)
    assert all(p is not None for p in pages.values())
    some = catalog.present(t4.household_balance(brut, dims, pages=pages))
    assert _as_set(some) == _as_set(catalog.present(t4.household_balance(brut, dims)))
    assert t4.band_pages(dims) == {"facteur_debit_position2": None, "facteur_debit_pression2": None}
