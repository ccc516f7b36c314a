"""Registered queries: one per operator key of the blueprint, on driver tables.

Each query takes ``(spark, sf_dir)``, reads the whole driver tables through
``sources.driver_tables`` and runs a library operator or job.  Double
columns are rounded half-up to 4 decimals for the cross-engine comparison
(``present``); nothing else is changed for presentation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import formulas as fx
from .functions import naming as nm
from .operators import household as hh
from .operators import lookups as lk
from .operators import repair as rp
from .operators import virtual as vr
from .plans import daily, ingest, partials, placed
from .plans import household as t4
from .plans import weather as t5
from .sinks import stores
from .sinks import tables as sink
from .sources import acq
from .sources import driver_tables as dtab
from .sources import tables as src

SAMPLE_DAY = dt.date(2024, 1, 10)
LOG = dtab.LOGEMENT_MEASURES


def present(df: DataFrame) -> DataFrame:
    """Round every double column half-up to 4 decimals (NaN kept)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            c = F.col(f.name)
            r = F.floor(c * 10000.0 + 0.5) / 10000.0
            cols.append(F.when(F.isnan(c), c).otherwise(r).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- shared inputs -------------------------------------------------------------

_DIMENSIONS: dict[str, tuple[SparkSession, dict[str, DataFrame]]] = {}


def _dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension frames of a folder, built once per session (lazy plans only)."""
    hit = _DIMENSIONS.get(sf_dir)
    if hit is not None and hit[0] is spark:
        return hit[1]
    dims = dtab.dimensions(spark, sf_dir)
    _DIMENSIONS[sf_dir] = (spark, dims)
    return dims


def _per_day_repair(df: DataFrame, measures) -> DataFrame:
    """Per-file repair of driver readings: one file = one sensor-day."""
    return rp.repair_per_day(df, measures, tiebreak=("rid",))


def _brut_logement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household raw table: readings repaired with seeds from earlier days (T1+T3)."""
    return rp.repair_seeded(dtab.logement_readings(spark, sf_dir), LOG, tiebreak=("rid",))


def _stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return t4.household_stages(_brut_logement(spark, sf_dir), _dimensions(spark, sf_dir))


def _climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phase 1 of T4 only."""
    sensors = lk.sensor_dimension(_dimensions(spark, sf_dir), t4.BANDS)
    return t4.calibrated_climate(_brut_logement(spark, sf_dir), sensors)


def _day_span(df: DataFrame) -> tuple[dt.date, dt.date]:
    """[first day, last day + 1) of a table: one aggregated row to the driver."""
    lo, hi = df.agg(F.min("date"), F.max("date")).first()
    return lo.date(), hi.date() + dt.timedelta(days=1)


# -- sources / sinks -----------------------------------------------------------


def q_ingest_readings(spark, sf_dir):
    lines = dtab.acq_lines(spark, sf_dir)
    out = ingest.ingest_lines(lines, LOG, tiebreak=("rid",))
    return out.select("rid", "file_name", "capteur", "date", *LOG)


def q_file_routing(spark, sf_dir):
    names = dtab.acq_lines(spark, sf_dir).select("file_name").distinct()
    return acq.route_files(names)


def q_parse_timestamp(spark, sf_dir):
    lines = dtab.acq_lines(spark, sf_dir)
    return lines.select("rid", F.col("Date").alias("date_text"), nm.parse_acq_timestamp("Date").alias("date"))


def q_day_slice(spark, sf_dir):
    return src.slice_days(dtab.logement_readings(spark, sf_dir), SAMPLE_DAY)


def q_batch_day(spark, sf_dir):
    lines = dtab.acq_lines(spark, sf_dir)
    brut = ingest.ingest_lines(lines, LOG, tiebreak=("rid",))
    return ingest.batch_day(brut, by=("file_name",))


def q_day_replace(spark, sf_dir):
    """Load all raw days, then reload a range of two days twice: the sample
    day repaired, the day after it without rows any more."""
    path = sink.shared_dir(spark, "day_replace")
    raw = dtab.logement_readings(spark, sf_dir)
    sink.replace_days(sink.with_day(raw), path)
    reload = sink.with_day(src.slice_days(_per_day_repair(raw, LOG), SAMPLE_DAY))
    for _ in range(2):
        sink.replace_range(reload, path, SAMPLE_DAY, SAMPLE_DAY + dt.timedelta(days=2))
    return spark.read.parquet(path)


def q_range_run(spark, sf_dir):
    raw = dtab.logement_readings(spark, sf_dir)
    lo, hi = _day_span(raw)
    return daily.run_range(raw, _dimensions(spark, sf_dir), lo, hi)


# -- windows / repair ----------------------------------------------------------


def q_lag_previous(spark, sf_dir):
    """W1 within each file of the original: per sensor-day."""
    raw = dtab.logement_readings(spark, sf_dir).withColumn("__day", nm.day_of("date"))
    out = rp.lag_previous(raw, ["temperature", "hr"], by=("capteur", "__day"), order=("date", "rid"))
    return out.select("rid", "capteur", "date", "temperature", "hr", "temperature_prev", "hr_prev")


def q_sentinel_repair(spark, sf_dir):
    return _per_day_repair(dtab.logement_readings(spark, sf_dir), LOG)


def q_sentinel_seeded(spark, sf_dir):
    return _brut_logement(spark, sf_dir)


def q_virtual_readings(spark, sf_dir):
    raw = dtab.logement_readings(spark, sf_dir)
    lo, hi = _day_span(raw)
    return vr.virtual_readings(dtab.capteur(spark, sf_dir), raw, lo, hi)


def q_virtual_fill(spark, sf_dir):
    f = _stages(spark, sf_dir)["filled"]
    return f.select("rid", "capteur", "logement", "date", "reel", "temperature", "hr")


# -- lookups -------------------------------------------------------------------


def q_join_sensor_dim(spark, sf_dir):
    raw = dtab.logement_readings(spark, sf_dir)
    return lk.join_sensor_dim(raw, dtab.capteur(spark, sf_dir))


def q_missing_factors(spark, sf_dir):
    rd = lk.join_sensor_dim(dtab.logement_readings(spark, sf_dir), dtab.capteur(spark, sf_dir))
    return lk.missing_factors(
        rd,
        dtab.facteur_temperature(spark, sf_dir),
        dtab.facteur_somme_surface_equivalente(spark, sf_dir),
        dtab.station_readings(spark, sf_dir),
    )


def q_calibrate_climate(spark, sf_dir):
    c = _climate(spark, sf_dir)
    co2 = F.when(F.col("reel"), fx.co2("raw_co2", "type")).otherwise(F.lit(0.0))
    return c.select("rid", "capteur", "date", "temperature", "hr", co2.alias("co2"))


def q_calibrate_flow(spark, sf_dir):
    f = _stages(spark, sf_dir)["flow"]
    return f.select(
        "rid", "capteur", "date", "debit_position_1", "debit_pression_1", "debit_produit", "surface_equivalente_ea"
    )


def q_band_lookup(spark, sf_dir):
    f = _stages(spark, sf_dir)["flow"]
    return f.select("rid", "capteur", "date", "debit_position_2", "debit_pression_2")


def q_absolute_humidity(spark, sf_dir):
    f = _stages(spark, sf_dir)["flow"]
    return f.select("rid", "capteur", "date", "humidite_absolue")


# -- household aggregates ------------------------------------------------------


def q_household_mean(spark, sf_dir):
    return hh.household_means(_climate(spark, sf_dir))


def q_household_flow_sum(spark, sf_dir):
    f = hh.flow_sum(_stages(spark, sf_dir)["flow"])
    return f.select("rid", "capteur", "logement", "date", "type", "somme_debits_extraits")


def q_household_surface_sum(spark, sf_dir):
    f = hh.surface_sum(_stages(spark, sf_dir)["flow"])
    return f.select("rid", "capteur", "logement", "date", "type", "somme_surface_equivalente")


def q_household_balance(spark, sf_dir):
    return t4.household_balance(_brut_logement(spark, sf_dir), _dimensions(spark, sf_dir))


def q_household_balance_placed(spark, sf_dir):
    """T4 from readings stored by household and slot: written once, then read without moving them."""
    store, dims = stores.ManifestStore(sink.shared_dir(spark, "placed")), _dimensions(spark, sf_dir)
    raw = _brut_logement(spark, sf_dir).drop("rid")
    lo, hi = _day_span(raw)
    store.replace(sink.with_day(raw), "brut_logement", lo, hi, ("capteur", "date"))
    return placed.placed_balance(placed.place(spark, store, dims, lo, hi), dims)


def q_daily_real_hr(spark, sf_dir):
    return hh.daily_real_hr(_climate(spark, sf_dir))


def q_daily_hr_partials(spark, sf_dir):
    """A7 from stored partial sums: all raw days are stored, the sample day is
    replaced by its first twelve hours, and only its partial sums are made anew."""
    store, dims = stores.ManifestStore(sink.shared_dir(spark, "partials")), _dimensions(spark, sf_dir)
    raw = _brut_logement(spark, sf_dir).drop("rid")
    lo, hi = _day_span(raw)
    store.replace(sink.with_day(raw), "brut_logement", lo, hi, ("capteur", "date"))
    partials.refresh(spark, store, dims, lo, hi)
    stored = store.read(spark, "brut_logement", acq.brut_schema("logement"))
    morning = src.slice_days(stored, SAMPLE_DAY).where(F.hour("date") < 12)
    store.replace(morning, "brut_logement", SAMPLE_DAY, SAMPLE_DAY + dt.timedelta(days=1), ("capteur", "date"))
    partials.refresh(spark, store, dims, lo, hi)
    return partials.real_means(spark, store, lo, hi)


# -- weather station and fan box -----------------------------------------------


def _brut_station(spark, sf_dir):
    return _per_day_repair(dtab.station_readings(spark, sf_dir), dtab.STATION_MEASURES)


def q_wind_sector(spark, sf_dir):
    w = t5.wind(_brut_station(spark, sf_dir))
    return w.select("rid", "capteur", "date", "orientation", "bousole")


def q_wind_speed_class(spark, sf_dir):
    w = t5.wind(_brut_station(spark, sf_dir))
    return w.select("rid", "capteur", "date", "vitesse_vent", "tranche_vent")


def q_weather_station(spark, sf_dir):
    return t5.weather_station(_brut_station(spark, sf_dir), dtab.facteur_temperature(spark, sf_dir))


def q_calibrate_fanbox(spark, sf_dir):
    brut = _per_day_repair(dtab.caisson_readings(spark, sf_dir), dtab.CAISSON_MEASURES)
    return t5.calibrate_fanbox(brut)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_readings": q_ingest_readings,
    "file_routing": q_file_routing,
    "parse_timestamp": q_parse_timestamp,
    "day_slice": q_day_slice,
    "day_replace": q_day_replace,
    "batch_day": q_batch_day,
    "range_run": q_range_run,
    "lag_previous": q_lag_previous,
    "sentinel_repair": q_sentinel_repair,
    "sentinel_seeded": q_sentinel_seeded,
    "virtual_readings": q_virtual_readings,
    "virtual_fill": q_virtual_fill,
    "join_sensor_dim": q_join_sensor_dim,
    "missing_factors": q_missing_factors,
    "calibrate_climate": q_calibrate_climate,
    "calibrate_flow": q_calibrate_flow,
    "band_lookup": q_band_lookup,
    "absolute_humidity": q_absolute_humidity,
    "household_mean": q_household_mean,
    "household_flow_sum": q_household_flow_sum,
    "household_surface_sum": q_household_surface_sum,
    "household_balance": q_household_balance,
    "household_balance_placed": q_household_balance_placed,
    "daily_real_hr": q_daily_real_hr,
    "daily_hr_partials": q_daily_hr_partials,
    "wind_sector": q_wind_sector,
    "wind_speed_class": q_wind_speed_class,
    "weather_station": q_weather_station,
    "calibrate_fanbox": q_calibrate_fanbox,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf_dir: present(fn(spark, sf_dir))

    return {k: wrap(v) for k, v in QUERIES.items()}
