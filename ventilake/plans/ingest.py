"""Ingest .acq lines into raw tables (parse, box id, sentinel repair).

The repair runs per file (one box, one day), exactly the unit the original
repaired, in hour buckets with carried values.  ``with_seeds`` adds T3:
leading errors of a file take the last good value of the days before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming as nm
from ..operators import repair as rp


#: order of lines of the same minute where they carry no line number
TIE = "__tie"


def ingest_lines(lines: DataFrame, measures: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Parse ``Date``, take the box id from ``file_name`` as ``capteur``,
    repair error codes within each file.

    Lines are taken in order of date (nulls first), then ``tiebreak`` (one
    integral column); without one, in a fixed order of their measures, so
    lines of the same minute give the same result in every run."""
    text = lines.withColumnRenamed("Date", "__date_text")
    parsed = text.withColumns(
        {"date": nm.parse_acq_timestamp("__date_text"), "capteur": nm.box_id("file_name")}
    ).drop("__date_text")
    if not tiebreak:
        parsed = parsed.withColumn(TIE, F.xxhash64(*measures))
    bucket = F.date_trunc("hour", F.col("date")).cast("timestamp_ntz")
    return rp.repair_bucketed(parsed, measures, ("file_name",), bucket, "date", tiebreak or (TIE,)).drop(TIE)


def batch_day(brut: DataFrame, by: Sequence[str] = ("file_name",)) -> DataFrame:
    """First timestamp of each batch and the day it starts (the day to replace)."""
    return brut.groupBy(*by).agg(F.min("date").alias("batch_start")).withColumn(
        "batch_day", F.col("batch_start").cast("date")
    )


def file_days(lines: DataFrame, measures: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Raw rows with the ``day`` of their file (a file may end with a reading of the next midnight)."""
    return ingest_lines(lines, measures, tiebreak).withColumn("day", nm.file_day("file_name"))


def rejected(lines: DataFrame) -> DataFrame:
    """The lines of ``read_acq_checked`` that are not loaded: ``file_name, line, reason, day`` of their file."""
    return lines.where("reason is not null").select("file_name", "line", "reason", nm.file_day("file_name").alias("day"))


def with_seeds(brut: DataFrame, state: DataFrame | None, measures: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """T3 for files of one or more days: ``brut`` seeded, and its own last good values.

    Leading errors of a file take the sensor's last good value of earlier
    days: those of ``state`` (stored last good values of days before the
    range; None if there are none) and of the earlier files of the range."""
    own = rp.last_good(brut, measures)
    known = own if state is None else state.select(*own.columns).unionByName(own)
    seeds = rp.seeds_by_day(known, brut.select("capteur", "day"), measures)
    return rp.apply_seeds(brut, seeds, measures, ("capteur", "day")), own
