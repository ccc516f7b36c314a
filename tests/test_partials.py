"""Stored partial sums per household-day: equal to the direct query, made anew where their day was replaced."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from test_household import _dims
from ventilake.functions import exact
from ventilake.operators import household as hh
from ventilake.operators import lookups as lk
from ventilake.plans import partials as pt
from ventilake.plans.household import BANDS, calibrated_climate, day_range
from ventilake.sinks import stores
from ventilake.sinks import tables as sink
from ventilake.sources import acq

D = [dt.date(2021, 2, k) for k in range(1, 12)]
SCHEMA = acq.brut_schema("logement")


def _raw(spark, days, shift=0.0, sensors=("ea", "b1", "bw", "gv", "x1", "nl", "other")):
    rows = [
        (2000.0 + 37 * k + shift + d.day, 400.0 + 13 * k, 100.0, 200.0, 409.0, dt.datetime.combine(d, dt.time(k, 7)), s, d)
        for d in days
        for s in sensors
        for k in range(5)
    ]
    # a null measure, a null date, and the next midnight in the file of the day
    rows += [(None, None, 1.0, 1.0, 1.0, dt.datetime.combine(d, dt.time(9)), "ea", d) for d in days]
    rows += [(2222.0, 444.0, 1.0, 1.0, 1.0, None, "ea", d) for d in days]
    rows += [(2500.0, 500.0, 1.0, 1.0, 1.0, dt.datetime.combine(d + dt.timedelta(days=1), dt.time()), "b1", d) for d in days]
    return spark.createDataFrame(rows, SCHEMA)


def _direct(spark, store, dims, lo, hi):
    raw = day_range(store.read(spark, "brut_logement", SCHEMA), lo, hi)
    out = hh.daily_real_hr(calibrated_climate(raw, lk.sensor_dimension(dims, BANDS)))
    return sorted((r["jour"], r["logement"], r["hr_moyen"]) for r in out.collect())


def _stored(spark, store, lo, hi):
    return sorted((r["jour"], r["logement"], r["hr_moyen"]) for r in pt.real_means(spark, store, lo, hi).collect())


@pytest.mark.parametrize("values", [[0.1, 0.2, 0.3, None], [2.0**60, 2.0**61, 2.0], [math.nan, 1.0], [math.inf, 2.0], [None, None], [1e16, 0.1] * 9])
@pytest.mark.parametrize("parts", [1, 2, 5])
def test_merged_partials_equal_the_whole(spark, values, parts):
    df = spark.createDataFrame([(i % parts, v) for i, v in enumerate(values)], "part INT, v DOUBLE")
    whole = df.agg(exact.exact_sum(F.col("v")).alias("s"), exact.exact_mean(F.col("v")).alias("m"), F.count("v").alias("n")).first()
    p = F.col("p")
    some = df.groupBy("part").agg(exact.partial_sum(F.col("v")).alias("p"))
    got = some.agg(exact.merged_sum(p).alias("s"), exact.merged_mean(p).alias("m"), exact.merged_count(p).alias("n")).first()
    for a, b in zip(whole, got):
        assert a == b or (math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("make", [stores.FolderStore, stores.ManifestStore])
def test_only_replaced_days_are_made_anew(spark, make):
    store, dims, lo, hi = make(sink.shared_dir(spark, "partials")), _dims(spark), D[0], D[9]
    assert pt.refresh(spark, store, dims, lo, hi) == []  # nothing is stored yet
    assert _stored(spark, store, lo, hi) == []
    store.replace(_raw(spark, D[:9]), "brut_logement", lo, hi, ("capteur",))
    assert pt.refresh(spark, store, dims, lo, hi) == D[:9]
    assert _stored(spark, store, lo, hi) == _direct(spark, store, dims, lo, hi)
    assert pt.refresh(spark, store, dims, lo, hi) == []

    # two days that do not touch are replaced, a third loses all its rows
    store.replace(_raw(spark, [D[2]], 50.0), "brut_logement", D[2], D[3])
    store.replace(_raw(spark, [D[6]], 90.0, ("x1",)), "brut_logement", D[6], D[7])
    store.replace(_raw(spark, [D[4]]).limit(0), "brut_logement", D[4], D[5])
    assert _stored(spark, store, lo, hi) != _direct(spark, store, dims, lo, hi)
    assert {D[2], D[6]} <= set(pt.refresh(spark, store, dims, lo, hi)) <= {D[2], D[4], D[6]}
    assert _stored(spark, store, lo, hi) == _direct(spark, store, dims, lo, hi)
    assert pt.refresh(spark, store, dims, lo, hi) == []
    # a range in the middle takes the midnight from the file of the day before
    assert _stored(spark, store, D[3], D[7]) == _direct(spark, store, dims, D[3], D[7])


def test_other_factors_make_all_days_stale(spark):
    store, dims = stores.ManifestStore(sink.shared_dir(spark, "partials")), _dims(spark)
    store.replace(_raw(spark, D[:3]), "brut_logement", D[0], D[3])
    pt.refresh(spark, store, dims, D[0], D[3])
    dims["facteur_temperature"] = dims["facteur_temperature"].withColumn("fct1", F.col("fct1") + 0.5)
    assert pt.refresh(spark, store, dims, D[0], D[3]) == D[:3]
    assert _stored(spark, store, D[0], D[3]) == _direct(spark, store, dims, D[0], D[3])
    # a null is not the text that stands for it, and one sensor more counts
    prints = []
    for reel in ("true", "null", "false"):
        one = dims["capteur"].withColumn("reel", F.expr(f"CASE WHEN id_capteur = 'ea' THEN {reel} ELSE reel END"))
        prints.append(pt.factors_print(lk.sensor_dimension(dims | {"capteur": one}, {})))
    prints.append(pt.factors_print(lk.sensor_dimension(dims | {"capteur": dims["capteur"].union(dims["capteur"].limit(1))}, {})))
    assert prints[1] == prints[2] and len(set(prints)) == 3  # null is read as not real


def test_a_run_stopped_before_the_switch_is_seen(spark, monkeypatch):
    store, dims = stores.ManifestStore(sink.shared_dir(spark, "partials")), _dims(spark)
    store.replace(_raw(spark, D[:3]), "brut_logement", D[0], D[3])
    pt.refresh(spark, store, dims, D[0], D[3])
    before = _stored(spark, store, D[0], D[3])
    store.replace(_raw(spark, [D[1]], 70.0), "brut_logement", D[1], D[2])
    with monkeypatch.context() as m:
        m.setattr(stores.ManifestStore, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            pt.refresh(spark, store, dims, D[0], D[3])
    assert _stored(spark, store, D[0], D[3]) == before
    assert pt.refresh(spark, store, dims, D[0], D[3]) == [D[1]]
    assert _stored(spark, store, D[0], D[3]) == _direct(spark, store, dims, D[0], D[3])


def test_means_read_partial_sums_only(spark):
    store, dims = stores.ManifestStore(sink.shared_dir(spark, "partials")), _dims(spark)
    store.replace(_raw(spark, D[:5]), "brut_logement", D[0], D[5])
    pt.refresh(spark, store, dims, D[0], D[5])
    out = pt.real_means(spark, store, D[0], D[4], "mois")
    assert all(pt.PARTIALS in f for f in out.inputFiles())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Join" not in plan
    got = {r["logement"]: r for r in out.collect()}
    raw = day_range(store.read(spark, "brut_logement", SCHEMA), D[0], D[4])
    real = calibrated_climate(raw, lk.sensor_dimension(dims, BANDS)).where("reel")
    whole = real.groupBy("logement").agg(
        exact.exact_mean(F.col("temperature")).alias("t"), exact.exact_mean(F.col("hr")).alias("h"), F.count("hr").alias("n")
    )
    for r in whole.collect():
        g = got.pop(r["logement"])
        assert (g["temperature_moyenne"], g["hr_moyen"], g["mesures_hr"]) == (r["t"], r["h"], r["n"])
    assert not got and {r["mois"] for r in out.collect()} == {dt.date(2021, 2, 1)}


def test_command_line_keeps_partial_sums(spark, tmpdir_fresh):
    import os

    from test_sources_sinks import _write
    from ventilake.__main__ import DIMENSIONS, main

    root, dims_dir, dims = os.path.join(tmpdir_fresh, "acq"), os.path.join(tmpdir_fresh, "dims"), _dims(spark)
    _write(root, "Salle 1 162 le 03 02 2021.acq", ["03/02/2021 10:00\t2600\t400\t100\t200\t409"])
    sensor = spark.createDataFrame([("162", "L1", "Sejour", "EA", True)], dims["capteur"].schema)
    dims["capteur"] = dims["capteur"].union(sensor)
    factor = spark.createDataFrame([("162", 1.0)], dims["facteur_temperature"].schema)
    dims["facteur_temperature"] = dims["facteur_temperature"].union(factor)
    for name in DIMENSIONS:
        dims[name].coalesce(1).write.parquet(os.path.join(dims_dir, name))
    store = sink.shared_dir(spark, "cli_partials")
    args = ["run", "2021-02-03", "2021-02-04", "--acq", root, "--store", store, "--dims", dims_dir, "--partials"]
    assert pt.PARTIALS in main(args, spark=spark)
    rows = pt.real_means(spark, store, "2021-02-03", "2021-02-04").collect()
    assert [(r["jour"], r["logement"], r["mesures_hr"]) for r in rows] == [(34, "L1", 1)]
