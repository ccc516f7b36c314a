"""A1/A7 over stored days: mergeable partial sums per household-day.

``partiel_logement`` keeps, for every file day of ``brut_logement``, one row per
household and date with what its real sensors give to sums and means of
temperature and hr (``functions.exact.PARTIAL``: a decimal sum, a count, and a
plain sum where values have no such decimal).  A mean over any span of dates then
adds partial rows, one per household and day instead of one per reading, and
has the same bits as the direct query.

Each file day also holds one row without a household that names what the day was
made from: the stamp of its raw day (``stamps`` of the store, which changes with
every replacement) and a fingerprint of the sensors and temperature factors.
:func:`refresh` makes anew exactly the days of which either differs, in one write
whatever their number.  Rows and stamp of a day are written together, so a run that
is stopped leaves days that the next one sees as stale.

Cases: readings of a household that is null, or without a date, are in no group; a
household-day whose values are all null has count 0 and mean null; days without raw rows
keep their stamp row only.  A change of any sensor or temperature factor makes
all days stale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import PARTIAL, merged_count, merged_mean, partial_sum
from ..operators import lookups as lk
from ..sinks.stores import FolderStore, ManifestStore, as_store
from ..sinks.tables import DAY
from ..sources import acq
from .daily import day_range_bounds
from .household import calibrated_climate

PARTIALS = "partiel_logement"
VALUES = ("temperature", "hr")
SCHEMA = f"date DATE, logement STRING, {', '.join(f'{v} {PARTIAL}' for v in VALUES)}, source STRING, {DAY} DATE"

#: spans of dates that means can be asked for
PERIODS = {
    "jour": lambda date: F.dayofyear(date),
    "mois": lambda date: F.trunc(date, "month"),
    "annee": lambda date: F.year(date),
}


def household_day_partials(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Partial sums of the real sensors' values by file day, date and household.

    ``readings``: raw household readings with the file day in ``day``; ``sensors``:
    :func:`lookups.sensor_dimension`."""
    # the file day rides along as the row's number, which the transform passes on
    numbered = readings.withColumn("rid", F.unix_date(DAY).cast("bigint"))
    real = calibrated_climate(numbered, sensors).where("reel")
    groups = real.groupBy(
        F.date_from_unix_date(F.col("rid").cast("int")).alias(DAY), F.col("date").cast("date").alias("date"), "logement"
    )
    return groups.agg(*[partial_sum(F.col(v)).alias(v) for v in VALUES])


def factors_print(sensors: DataFrame) -> str:
    """A text that changes with the sensors or temperature factors (one aggregated row to the driver)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("id_capteur", "logement", "reel", "__fct_t")]
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in ("id_capteur", "logement", "reel", "__fct_t")])
    hashes = [F.sum(F.xxhash64(F.lit(k), nulls, *parts).cast("decimal(38,0)")) for k in range(2)]
    row = sensors.agg(F.count(F.lit(1)), *hashes).first()
    return ":".join(str(x) for x in row)


def stale_days(spark, store, table: str, source: dict[dt.date, str], lo: dt.date, hi: dt.date) -> list[dt.date]:
    """The file days of ``[lo, hi)`` whose partial sums are missing or not made from ``source``."""
    kept = store.read(spark, table, SCHEMA, lo, hi).where("source is not null").select(DAY, "source")
    made = {r[0]: r[1] for r in kept.collect()}  # one row per day
    return sorted(d for d in source.keys() | made.keys() if made.get(d) != source.get(d, _NO_ROWS))


_NO_ROWS = "-"


def refresh(
    spark, store: str | FolderStore | ManifestStore, dims: dict[str, DataFrame], day_from, day_to
) -> list[dt.date]:
    """Bring the partial sums of the file days ``[day_from, day_to)`` up to date; the days made anew."""
    store = as_store(store)
    lo, hi = day_range_bounds(day_from, day_to)
    sensors = lk.sensor_dimension(dims, {})
    factors = factors_print(sensors)
    source = {d: f"{stamp} {factors}" for d, stamp in store.stamps(spark, "brut_logement", lo, hi).items()}
    days = stale_days(spark, store, PARTIALS, source, lo, hi)
    if not days:
        return []
    raw = store.read(spark, "brut_logement", acq.brut_schema("logement"), days[0], days[-1] + dt.timedelta(days=1))
    made = household_day_partials(raw.where(F.col(DAY).isin(days)), sensors)
    marks = spark.createDataFrame([(source.get(d, _NO_ROWS), d) for d in days], f"source STRING, {DAY} DATE")
    out = made.unionByName(marks, allowMissingColumns=True).select("date", "logement", *VALUES, "source", DAY)
    store.replace_some(out, PARTIALS, days, ("logement",))
    return days


def merge_partials(partials: DataFrame, *keys: Column) -> DataFrame:
    """Means and counts of the partial rows by ``keys`` and household."""
    aggs = [merged_mean(F.col("temperature")).alias("temperature_moyenne"), merged_mean(F.col("hr")).alias("hr_moyen")]
    return partials.groupBy(*keys, "logement").agg(*aggs, merged_count(F.col("hr")).alias("mesures_hr"))


def real_means(spark, store: str | FolderStore | ManifestStore, day_from, day_to, period: str = "jour") -> DataFrame:
    """Means of the real sensors per household and ``period`` over the dates ``[day_from, day_to)``.

    Reads the partial sums only, of the file days of the range and the one before
    (a file may hold the next midnight).  ``period`` "jour" is the day of the year,
    as in ``operators.household.daily_real_hr``, so equal days of several years are one
    group.  :func:`refresh` those days first."""
    lo, hi = day_range_bounds(day_from, day_to)
    rows = as_store(store).read(spark, PARTIALS, SCHEMA, lo - dt.timedelta(days=1), hi).where("source is null")
    inside = rows.where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    return merge_partials(inside, PERIODS[period](F.col("date")).alias(period))
