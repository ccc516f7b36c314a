"""Household transform: fixture values, strategy equality, range runs, plans."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ventilake import catalog
from ventilake.operators import virtual as vr
from ventilake.plans import daily
from ventilake.plans import household as t4
from ventilake.sources import driver_tables as dtab

TS = "2021-02-03 10:00:00"


def _dims(spark):
    capteur = spark.createDataFrame(
        [
            ("ea", "L1", "Sejour", "EA", True),
            ("b1", "L1", "Cuisine", "Bouche", True),
            ("bw", "L1", "WC", "Bouche", True),
            ("ot", "L1", "Chambre", "Ambiance", True),
            ("gv", "L1", "Chambre", "Bouche", False),
            ("x1", "L2", "Sejour", "Bouche", True),
            ("nl", None, "Sejour", "EA", True),
        ],
        "id_capteur string, logement string, piece string, type string, reel boolean",
    )
    ft = spark.createDataFrame(
        [(s, 1.0) for s in ("ea", "b1", "bw", "ot", "gv", "x1", "nl")], "capteur_facteur string, fct1 double"
    )
    fp1 = spark.createDataFrame([("b1", 0.1)], "capteur_facteur string, fct1 double")
    fp2 = spark.createDataFrame(
        [
            ("b1", 1.0, 0.5, 0.0, 0.0, 0.0, 300.0, 0.0),
            ("b1", 9.0, 0.0, 0.0, 0.0, 250.0, 400.0, None),
            ("ea", 2.0, 0.0, 0.0, 0.0, 0.0, 600.0, 3.0),
            ("gv", 0.1, 1.0, 0.0, 0.0, 0.0, 1000.0, 0.0),
        ],
        "capteur_facteur string, fct1 double, fct2 double, fct3 double, fct4 double, "
        "borne_inf double, borne_sup double, valeur_defaut double",
    )
    fq2 = spark.createDataFrame(
        [("b1", 0.5, 0.0, 0.0, 0.0, 600.0), ("gv", 0.25, 0.0, 0.0, 0.0, 600.0)],
        "capteur_facteur string, fct1 double, fct2 double, fct3 double, borne_inf double, borne_sup double",
    )
    fs = spark.createDataFrame([("L1", 1.5), ("L2", 2.0)], "logement_facteur string, fct1 double")
    return {
        "capteur": capteur,
        "facteur_temperature": ft,
        "facteur_debit_position1": fp1,
        "facteur_debit_position2": fp2,
        "facteur_debit_pression2": fq2,
        "facteur_somme_surface_equivalente": fs,
    }


def _readings(spark):
    rows = [
        (1, "ea", 2600.0, 400.0, 100.0, 200.0, 409.0),
        (2, "b1", 2400.0, 420.0, 280.0, 100.0, 409.0),
        (3, "bw", 2200.0, 380.0, 100.0, 100.0, 409.0),
        (4, "ot", 2000.0, 300.0, 100.0, 100.0, 409.0),
        (5, "gv", 0.0, 0.0, 0.0, 0.0, 0.0),
        (6, "x1", 2000.0, 300.0, 100.0, 100.0, 409.0),
        (7, "nl", 2000.0, 300.0, 100.0, 100.0, 409.0),
    ]
    df = spark.createDataFrame(
        rows, "rid long, capteur string, temperature double, hr double, debit_position_1 double, "
        "debit_pression_1 double, co2 double"
    )
    return df.withColumn("date", F.lit(TS).cast("timestamp_ntz"))


def test_fixture_household(spark):
    out = t4.household_balance(_readings(spark), _dims(spark))
    rows = {r["capteur"]: r for r in out.collect()}
    # the sensor without household is dropped
    assert set(rows) == {"ea", "b1", "bw", "ot", "gv", "x1"}
    temps = [0.01 * t - 1.0 for t in (2600.0, 2400.0, 2200.0, 2000.0)] + [0.0]
    assert rows["gv"]["temperature"] == pytest.approx(sum(temps) / 5)  # virtual: mean incl. its own 0.0
    assert rows["ea"]["temperature"] == pytest.approx(25.0)
    # b1: raw position 280 is in [0,300) and [250,400); the highest lower bound wins;
    # its default is null -> polynomial 9.0; pressure band 0.5 -> produit (1+0.5)*9
    assert rows["b1"]["debit_position_2"] == pytest.approx(9.0)
    assert rows["b1"]["debit_produit"] == pytest.approx(13.5)
    assert rows["bw"]["debit_position_2"] == 0.0  # WC
    # ea: default value 3.0 > 0 replaces the formula; surface = 3/sqrt(2)
    assert rows["ea"]["debit_position_2"] == 3.0
    assert rows["ea"]["surface_equivalente_ea"] == pytest.approx(3.0 / math.sqrt(2))
    # virtual Bouche: band on household hr, f1*hr + f2; pressure band on raw 0
    hr_mean = rows["gv"]["hr"]
    assert rows["gv"]["debit_position_2"] == pytest.approx(0.1 * hr_mean + 1.0)
    s = sum(r["debit_produit"] for k, r in rows.items() if k != "x1")
    for k in ("ea", "b1", "bw", "ot", "gv"):
        assert rows[k]["somme_debits_extraits"] == pytest.approx(max(s, 0.0))
        assert rows[k]["somme_surface_equivalente"] == pytest.approx(1.5 + 3.0)
    assert rows["b1"]["pression_reelle"] == pytest.approx(max(s, 0.0) / 4.5**2)
    # household without air inlet: surface 0 -> null pressure and flow
    assert rows["x1"]["somme_surface_equivalente"] == 0.0
    assert rows["x1"]["pression_reelle"] is None and rows["x1"]["debit_reelle"] is None


def _as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_range_equals_union_of_days(spark):
    raw = dtab.logement_readings(spark, SF_SMALL)
    dims = dtab.dimensions(spark, SF_SMALL)
    d0, d1, d2 = dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12)
    both = daily.run_range(raw, dims, d0, d2)
    sep = daily.run_range(raw, dims, d0, d1).unionByName(daily.run_range(raw, dims, d1, d2))
    assert _as_set(catalog.present(both)) == _as_set(catalog.present(sep))


def test_virtual_rows_on_minute_grid(spark):
    raw = dtab.logement_readings(spark, SF_SMALL)
    capteur = dtab.capteur(spark, SF_SMALL)
    g = vr.virtual_readings(capteur, raw, "2024-01-10", "2024-01-12")
    rows = g.collect()
    assert all(r["date"].second == 0 and r["date"].microsecond == 0 for r in rows)
    assert all(dt.datetime(2024, 1, 10) <= r["date"] < dt.datetime(2024, 1, 12) for r in rows)
    virtual = {r["id_capteur"] for r in capteur.where(~F.col("reel")).collect()}
    firsts = {(r["capteur"], r["date"]) for r in rows if r["date"].hour == 0 and r["date"].minute == 0}
    assert firsts == {(v, dt.datetime(2024, 1, d)) for v in virtual for d in (10, 11)}
    assert len(rows) == len({(r["capteur"], r["date"]) for r in rows})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm(spark):
    for name, fn in catalog.queries().items():
        if name == "day_replace":
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "Python" not in plan and "ArrowEval" not in plan, name


def _moves_of_readings(df) -> int:
    """Exchanges that move readings in the plan that ran: not those of partial
    aggregates, of dimension tables or of the carry, nor reused ones."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    dims = ("id_capteur", "capteur_facteur", "logement_facteur", "__bk", "__fk", "logement#")
    moves = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line or "Reused" in line:
            continue
        below = "\n".join(lines[i + 1 : i + 4])
        if "HashAggregate" in below or "__seed_" in below:
            continue
        if any(d in line for d in dims) and "date#" not in line:
            continue
        moves += 1
    return moves


def _without_broadcast(spark, make):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        return make()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_household_plan_moves_readings_three_times(spark):
    """Broadcast off: once by sensor, once by household-minute for each of the two join-backs."""
    readings, dims = dtab.logement_readings(spark, SF_SMALL), dtab.dimensions(spark, SF_SMALL)
    df = t4.household_balance(readings, dims)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in optimized and "Window" not in optimized
    assert _without_broadcast(spark, lambda: _moves_of_readings(t4.household_balance(readings, dims))) <= 3


def test_carry_does_not_shuffle_readings_again(spark):
    assert _without_broadcast(spark, lambda: _moves_of_readings(catalog.QUERIES["sentinel_seeded"](spark, SF_SMALL))) == 1


def test_day_slice_pushes_filter_and_prunes_columns(spark):
    df = catalog.QUERIES["day_slice"](spark, SF_SMALL)
    phys = _plan(df)
    assert "PushedFilters: [IsNotNull(ts)" in phys or "PushedFilters: [" in phys
    scan = [line for line in phys.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan  # unused column not read


def test_real_only_means_and_strict(spark):
    readings, dims = _readings(spark), _dims(spark)
    out = {r["capteur"]: r for r in t4.household_balance(readings, dims, real_only=True).collect()}
    temps = [0.01 * t - 1.0 for t in (2600.0, 2400.0, 2200.0, 2000.0)]
    assert out["gv"]["temperature"] == pytest.approx(sum(temps) / 4)
    t4.household_balance(readings, dims, strict=True)  # all factors present
    dims2 = dict(dims)
    dims2["facteur_temperature"] = dims["facteur_temperature"].where(F.col("capteur_facteur") != "ea")
    with pytest.raises(ValueError, match="facteur_temperature:ea"):
        t4.household_balance(readings, dims2, strict=True)


def test_same_result_without_broadcast(spark):
    """Dimensions above the broadcast threshold fall back to shuffle joins
    with the same result (forced here by disabling broadcasts)."""
    brut = catalog._brut_logement(spark, SF_SMALL)
    dims = dtab.dimensions(spark, SF_SMALL)
    expected = _as_set(catalog.present(t4.household_balance(brut, dims)))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = catalog.present(t4.household_balance(brut, dims))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert _as_set(df) == expected
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_household_minute(spark):
    """20,000 readings in ONE household-minute give the totals computed by hand."""
    sensors = ["ea", "b1", "bw", "ot", "gv"]
    ids = spark.range(20_000)
    readings = ids.select(
        F.col("id").alias("rid"),
        F.element_at(F.array(*[F.lit(s) for s in sensors]), (F.col("id") % 5 + 1).cast("int")).alias("capteur"),
        F.lit(TS).cast("timestamp_ntz").alias("date"),
        (F.lit(2000.0) + F.col("id") % 700).alias("temperature"),
        (F.lit(300.0) + F.col("id") % 150).alias("hr"),
        (F.col("id") % 600).cast("double").alias("debit_position_1"),
        (F.col("id") % 400).cast("double").alias("debit_pression_1"),
        F.lit(409.0).alias("co2"),
    )
    rows = t4.household_stages(readings, _dims(spark))["final"].collect()
    assert len(rows) == 20_000
    total = sum(r["debit_produit"] for r in rows)
    assert {r["somme_debits_extraits"] for r in rows} == {rows[0]["somme_debits_extraits"]}
    assert rows[0]["somme_debits_extraits"] == pytest.approx(max(total, 0.0), rel=1e-9)
    mean = sum(0.0 if r["capteur"] == "gv" else r["temperature"] for r in rows) / len(rows)
    assert {round(r["temperature"], 6) for r in rows if r["capteur"] == "gv"} == {round(mean, 6)}


def test_no_job_runs_while_plans_are_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans")
    try:
        for name in ("household_balance", "household_flow_sum", "sentinel_repair", "ingest_readings"):
            catalog.queries()[name](spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
