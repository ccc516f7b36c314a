"""T4 over co-located storage: readings bucketed by household and slot, so the transform moves none of them.

The joins and aggregates of the household transform all work within one
household-minute.  :func:`place` stores the readings of a range of days with their
household and a slot (a hash of the minute, ``SLOTS`` of them), bucketed and sorted by
(household, slot).  The sensors are joined on (household, slot, sensor): one row per
sensor and slot that hold readings is shuffled to the buckets instead of the readings.
These places are few columns of few rows, found within the buckets and written first;
a sensor without readings goes nowhere.  Means, totals and their join-backs are grouped by (household, slot, minute),
which lies within a bucket as well.  With ``SETTINGS`` no reading is moved, whether the
sensors are broadcast or not; without them the rows are the same.  A household that holds a third of all rows is
spread over its slots.

A placed table is named after all that it was made from: the stamps of the raw days
(``stamps`` of the store, which change when a day is replaced), the households of the
sensors, slots and buckets.  So :func:`place` finds a table that is up to date by its
name, in any session, and a replaced day or a moved sensor asks for another.  A
folder whose write did not end has no ``_SUCCESS`` and is written again.

Cases: readings of a sensor without household, without a date or with an
unknown sensor are not placed, as the transform drops them; an empty range gives an empty table;
sensors listed twice under one household give their rows twice, as in the transform.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import lookups as lk
from ..sinks.stores import FolderStore, ManifestStore, as_store
from ..sinks.tables import hadoop_path
from ..sources import acq
from .daily import day_range_bounds
from .household import BANDS, MEASURES, OUTPUT_COLUMNS, calibrated_climate, climate_stages, day_range

SLOTS = 16
BUCKETS = 64
SLOT = "creneau"
PLACE = ("logement", SLOT)
#: without it Spark shuffles both sides of a join that are placed by some of its keys only;
#: set it for the session that runs the transform (``build_session(**SETTINGS)``)
SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
KEYS = (*PLACE, "date")
SOURCES = ("brut_logement", "brut_virtuel")


def slot_of(date: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(date), F.lit(slots)).cast("int")


def households(capteur: DataFrame) -> DataFrame:
    """Sensors and the households they are in, each pair once."""
    return capteur.where("id_capteur is not null and logement is not null").select("id_capteur", "logement").distinct()


def _households_print(pairs: DataFrame) -> str:
    sums = [F.sum(F.xxhash64(F.lit(k), "id_capteur", "logement").cast("decimal(38,0)")) for k in range(2)]
    return ":".join(str(x) for x in pairs.agg(F.count(F.lit(1)), *sums).first())


def with_place(readings: DataFrame, pairs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The readings with household and slot, one row per household of the sensor."""
    rows = readings.where("date is not null").join(pairs, readings["capteur"] == pairs["id_capteur"], "inner")
    return rows.drop("id_capteur").withColumn(SLOT, slot_of(F.col("date"), slots))


def place(
    spark,
    store: str | FolderStore | ManifestStore,
    dims: dict[str, DataFrame],
    day_from,
    day_to,
    slots: int = SLOTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The placed readings of the dates ``[day_from, day_to)``, written unless they are stored already.

    ``buckets``: as many as tasks should read the range."""
    store = as_store(store)
    lo, hi = day_range_bounds(day_from, day_to)
    first = lo - dt.timedelta(days=1)  # its files may hold the first midnight
    pairs = households(dims["capteur"])
    made_of = [sorted((str(d), s) for d, s in store.stamps(spark, t, first, hi).items()) for t in SOURCES]
    text = repr((made_of, str(lo), str(hi), _households_print(pairs), slots, buckets))
    name = f"place_{hashlib.sha256(text.encode()).hexdigest()[:32]}"
    path = os.path.join(store.path("brut_place"), name)
    columns = ("capteur", "date", *MEASURES, *PLACE)
    success = hadoop_path(spark, f"{path}/_SUCCESS")
    if not success.getFileSystem(spark._jsc.hadoopConfiguration()).exists(success):
        schema = acq.brut_schema("logement")
        days = [day_range(store.read(spark, t, schema, first, hi), lo, hi) for t in SOURCES]
        rows = with_place(days[0].unionByName(days[1]), pairs, slots).select(*columns)
        # a task per bucket writes one file; the same hash as that of the buckets
        out = rows.repartition(buckets, *PLACE).write.bucketBy(buckets, *PLACE).sortBy(*KEYS)
        out.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    elif not spark.catalog.tableExists(name):
        types = {"capteur": "STRING", "date": "TIMESTAMP_NTZ", "logement": "STRING", SLOT: "INT"}
        declared = ", ".join(f"{c} {types.get(c, 'DOUBLE')}" for c in columns)
        clustered = f"CLUSTERED BY ({', '.join(PLACE)}) SORTED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {name} ({declared}) USING parquet {clustered} LOCATION '{path}'")
    return spark.table(name)


def places(placed: DataFrame) -> DataFrame:
    """Sensor, household and slot of the placed readings, each once, kept in the checkpoint folder."""
    return placed.select("capteur", *PLACE).distinct().checkpoint(eager=True)


def placed_balance(
    placed: DataFrame, dims: dict[str, DataFrame], slots: int = SLOTS, buckets: int = BUCKETS, real_only: bool = False, pages=None
) -> DataFrame:
    """T4 on placed readings: the rows of ``household.household_balance`` (:func:`places` runs a job).

    ``slots``: those of the placed table, read from its rows.
    ``pages`` (``household.band_pages``): sensors with very many bands are looked up by a
    join of their own, which may move the readings."""
    sensors = lk.sensor_dimension(dims, BANDS, pages)
    at = places(placed).withColumnRenamed("capteur", "id_capteur")
    every = sensors.join(at, ["id_capteur", "logement"])
    climate = calibrated_climate(placed, every.repartition(buckets, *PLACE), PLACE)
    return climate_stages(climate, real_only, pages, KEYS)["final"].select(*OUTPUT_COLUMNS)
