"""Readings of virtual (not physically present) sensors on the minute grid.

For every virtual sensor and every day of the range the first minute of the
day is always emitted; any later minute of the day is emitted when some
reading of the sensor's household exists at that minute.

The original walked the 1,440 minutes of each day with one ``count(*)``
query per minute.  Here the household minutes come from the readings
themselves (one pre-aggregated ``distinct``), joined to the virtual sensors
of the household; no minute grid is materialised, so the work grows with
the readings and not with sensors x 1,440.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import day_of, ntz_literal

MEASURES = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def virtual_readings(capteur: DataFrame, readings: DataFrame, day_from, day_to) -> DataFrame:
    """Ghost rows (all measures 0.0) for days in ``[day_from, day_to)``.

    ``readings`` needs ``capteur`` and ``date``; the household of each
    reading comes from ``capteur``.
    """
    start, end = _as_date(day_from), _as_date(day_to)
    if end <= start:
        raise ValueError("empty day range")
    last = end - dt.timedelta(days=1)
    lo = dt.datetime.combine(start, dt.time())
    hi = dt.datetime.combine(end, dt.time())

    virtual = capteur.where(~F.coalesce(F.col("reel"), F.lit(False))).select(
        F.col("id_capteur").alias("capteur"), "logement"
    )
    first_minutes = virtual.select(
        "capteur", F.explode(F.sequence(F.lit(start), F.lit(last))).alias("day")
    ).select("capteur", F.col("day").cast("timestamp_ntz").alias("date"))

    dim = capteur.select(F.col("id_capteur").alias("__id"), F.col("logement").alias("__log"))
    minutes = (
        readings.select("capteur", "date")
        .where(
            (F.col("date") >= ntz_literal(lo))
            & (F.col("date") < ntz_literal(hi))
            & (F.col("date") == F.date_trunc("minute", "date").cast("timestamp_ntz"))
            & (F.col("date") != day_of("date"))
        )
        .join(dim, F.col("capteur") == F.col("__id"), "inner")
        .select(F.col("__log").alias("logement"), "date")
        .distinct()
    )
    later_minutes = virtual.join(minutes, "logement", "inner").select("capteur", "date")
    ghosts = first_minutes.unionByName(later_minutes)
    return ghosts.select("capteur", "date", *[F.lit(0.0).alias(m) for m in MEASURES])
