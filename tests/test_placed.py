"""Readings stored by household and slot: the transform gives the same rows and moves no reading."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from test_household import _dims
from test_partials import D, SCHEMA, _raw
from ventilake.operators import virtual as vr
from ventilake.plans import placed as pl
from ventilake.plans.household import day_range, household_balance
from ventilake.sinks import stores
from ventilake.sinks import tables as sink


def _filled(spark, make, days=D[:4]):
    store, dims, hi = make(sink.shared_dir(spark, "placed")), _dims(spark), days[-1] + dt.timedelta(days=1)
    raw = _raw(spark, days)
    store.replace(raw, "brut_logement", days[0], hi)
    ghosts = vr.virtual_readings(dims["capteur"], raw.drop("day"), days[0], hi)
    store.replace(sink.with_day(ghosts), "brut_virtuel", days[0], hi)
    return store, dims


def _rows(df):
    return sorted(map(str, df.collect()))


def _direct(spark, store, dims, lo, hi):
    sources = [store.read(spark, t, SCHEMA) for t in pl.SOURCES]
    return _rows(household_balance(day_range(sources[0].unionByName(sources[1]), lo, hi), dims))


def _moved(df, table):
    """The exchanges and broadcasts of a static plan that have the table's scan below them."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:|+\-*()\d]*", x)[0]) for x in lines]
    out = []
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = [x for j, x in enumerate(lines[i + 1 :], i + 1) if all(d > depth[i] for d in depth[i + 1 : j + 1])]
            out += [line] if any(table in x for x in below) else []
    return out, [x for x in lines if table in x]


@pytest.mark.parametrize("make", [stores.FolderStore, stores.ManifestStore])
def test_the_same_rows_as_the_transform(spark, make):
    store, dims = _filled(spark, make)
    for lo, hi, slots, buckets in ((D[0], D[4], 16, 8), (D[1], D[3], 1, 3)):
        table = pl.place(spark, store, dims, lo, hi, slots, buckets)
        got = _rows(pl.placed_balance(table, dims, slots, buckets))
        assert got and got == _direct(spark, store, dims, lo, hi)
    assert pl.placed_balance(pl.place(spark, store, dims, D[8], D[9]), dims).count() == 0


def test_no_reading_is_moved(spark):
    store, dims = _filled(spark, stores.ManifestStore)
    table = pl.place(spark, store, dims, D[0], D[4], buckets=8)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", *pl.SETTINGS)}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sensors of any number
        for k, v in pl.SETTINGS.items():
            spark.conf.set(k, v)
        name = re.search(r"place_[0-9a-f]{32}", "".join(table.inputFiles()))[0]
        moved, scans = _moved(pl.placed_balance(table, dims, buckets=8), name)
        assert scans and all("Bucketed: true" in x for x in scans) and moved == []
        assert _rows(pl.placed_balance(table, dims, buckets=8)) == _direct(spark, store, dims, D[0], D[4])
        # the check sees what it should: the same rows, grouped by something else, do move
        assert _moved(table.groupBy("capteur").count(), name)[0]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_table_is_written_once_and_found_by_another_session(spark):
    store, dims = _filled(spark, stores.ManifestStore)
    table = pl.place(spark, store, dims, D[0], D[4], buckets=4)
    files, want = sorted(table.inputFiles()), _rows(pl.placed_balance(table, dims, buckets=4))
    name = re.search(r"place_[0-9a-f]{32}", files[0])[0]
    spark.sql(f"DROP TABLE {name}")  # external: the catalog of a new session does not know it
    again = pl.place(spark, store, dims, D[0], D[4], buckets=4)
    assert sorted(again.inputFiles()) == files and _rows(pl.placed_balance(again, dims, buckets=4)) == want


def test_replaced_days_and_moved_sensors_ask_for_another_table(spark):
    store, dims = _filled(spark, stores.ManifestStore)
    pl.place(spark, store, dims, D[0], D[4], buckets=4)
    store.replace(_raw(spark, [D[1]], 90.0), "brut_logement", D[1], D[2])
    table = pl.place(spark, store, dims, D[0], D[4], buckets=4)
    assert _rows(pl.placed_balance(table, dims, buckets=4)) == _direct(spark, store, dims, D[0], D[4])
    dims["capteur"] = dims["capteur"].withColumn("logement", F.when(F.col("id_capteur") == "b1", "L2").otherwise(F.col("logement")))
    table = pl.place(spark, store, dims, D[0], D[4], buckets=4)
    assert _rows(pl.placed_balance(table, dims, buckets=4)) == _direct(spark, store, dims, D[0], D[4])


def test_a_hot_household_lies_in_many_buckets(spark):
    hot = spark.range(5000).select(
        F.lit("ea").alias("capteur"), F.expr("timestamp_ntz'2021-02-01 00:00:00' + make_interval(0,0,0,0,0,id)").alias("date")
    )
    at = pl.with_place(hot, pl.households(_dims(spark)["capteur"])).groupBy(*pl.PLACE).count().collect()
    assert len(at) == pl.SLOTS and max(r["count"] for r in at) < 2 * 5000 / pl.SLOTS


def test_a_sensor_goes_to_the_slots_that_hold_its_readings_alone(spark, monkeypatch):
    store, dims = _filled(spark, stores.ManifestStore)
    idle = spark.range(1000).select(F.concat(F.lit("idle"), "id").alias("id_capteur"), F.lit("L1").alias("logement"))
    dims["capteur"] = dims["capteur"].unionByName(idle, allowMissingColumns=True)
    table = pl.place(spark, store, dims, D[0], D[4], buckets=4)
    sent, climate = [], pl.calibrated_climate
    monkeypatch.setattr(pl, "calibrated_climate", lambda readings, sensors, at: sent.append(sensors) or climate(readings, sensors, at))
    got = _rows(pl.placed_balance(table, dims, buckets=4))
    assert got and got == _direct(spark, store, dims, D[0], D[4])
    here = {(r["capteur"], r["logement"], r[pl.SLOT]) for r in table.collect()}
    assert sorted(sent[0].select("id_capteur", *pl.PLACE).collect()) == sorted(here)
