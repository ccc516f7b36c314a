"""S2/T1 over an archive that grows: only the days whose files changed are loaded.

``fichiers_charges`` keeps path, size and modification time of every file that was
loaded, by the day in its name.  A run compares it with the listing of the
archive (``sources.acq.list_acq``, which opens no file): a day with a new, changed or
removed file is loaded again as a whole by ``run_files``, any other is left alone.

The listing is taken before the files are read and stored after their days are:
a file that changes meanwhile, or a run that is stopped, is seen by the next run.
Days are loaded as when they are named to ``run_files``; later days whose leading
errors were filled from a day that changed keep what they were filled with, unless
``through`` asks to load them again too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import HOUSEHOLD_BOXES
from ..sinks.stores import FolderStore, ManifestStore, as_store
from ..sinks.tables import DAY
from ..sources import acq
from .daily import KINDS, day_range_bounds, run_files

LOADED = "fichiers_charges"
LOADED_SCHEMA = f"path STRING, size LONG, modified TIMESTAMP, {DAY} DATE"


def listing(spark, acq_root: str, day_from=None, day_to=None, boxes: Sequence[str] = HOUSEHOLD_BOXES) -> DataFrame:
    """All files that the chain reads, of the three kinds: columns of ``LOADED_SCHEMA``."""
    return reduce(DataFrame.union, [acq.list_acq(spark, acq_root, k, day_from, day_to, boxes) for k in KINDS]).distinct()


def changed_days(files: DataFrame, loaded: DataFrame) -> list[dt.date]:
    """The days on which the files are not those that were loaded, in order (one row per day reaches the driver)."""
    columns = ["path", "size", "modified", DAY]
    sides = files.select(*columns, F.lit(1).alias("n")).union(loaded.select(*columns, F.lit(-1).alias("n")))
    unlike = sides.groupBy(*columns).agg(F.sum("n").alias("n")).where("n != 0")
    return sorted(r[0] for r in unlike.select(DAY).distinct().collect())


def spans(days: Sequence[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Ranges ``[from, to)`` of days that follow each other."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in days:
        after = day + dt.timedelta(days=1)
        out = [*out[:-1], (out[-1][0], after)] if out and out[-1][1] == day else [*out, (day, after)]
    return out


def run_changed(
    spark,
    acq_root: str,
    store: str | FolderStore | ManifestStore,
    dims: dict[str, DataFrame],
    day_from,
    day_to,
    boxes: Sequence[str] | None = None,
    through: bool = False,
    **options,
) -> list[tuple[dt.date, dt.date]]:
    """``run_files`` over the days of ``[day_from, day_to)`` whose files changed since they were loaded.

    ``through``: over all days from the first such day on.  ``options`` go to
    ``run_files``.  Returns the ranges that were loaded, none if nothing changed."""
    store, boxes = as_store(store), boxes or HOUSEHOLD_BOXES
    lo, hi = day_range_bounds(day_from, day_to)
    # kept: what is stored afterwards is what was there before the files were read
    files = listing(spark, acq_root, lo, hi, boxes).checkpoint(eager=True)
    days = changed_days(files, store.read(spark, LOADED, LOADED_SCHEMA, lo, hi))
    ranges = spans(days)
    if through and ranges:
        ranges = [(ranges[0][0], hi)]
    for first, end in ranges:
        run_files(spark, acq_root, store, dims, first, end, boxes, **options)
        store.replace(files, LOADED, first, end, ("path",))
    return ranges
