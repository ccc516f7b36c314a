"""A range of days in one job (instead of one driver loop per day).

Raw household readings of the range are repaired with seeds carried from
earlier days, the ghost readings of virtual sensors are added, and the
household transform runs once over the whole range; every output row carries
its ``day`` so the sink can replace days idempotently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import HOUSEHOLD_BOXES
from ..operators import household as hh
from ..operators import lookups as lk
from ..operators import repair as rp
from ..operators import virtual as vr
from ..sinks import tables as sink
from ..sinks.stores import FolderStore, ManifestStore, as_store
from ..sources import acq
from .household import band_pages, check_factors, day_range, household_balance
from .ingest import file_days, rejected, with_seeds
from .weather import calibrate_fanbox, weather_station

MEASURES = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")
KINDS = ("logement", "station", "caisson")
TABLES = (
    *[f"brut_{k}" for k in KINDS],
    "brut_virtuel",
    "dernier_bon",
    "etat",
    *[f"test_{k}" for k in KINDS],
    "facteurs_manquants",
    *[f"rejets_{k}" for k in KINDS],
)


def run_range(readings: DataFrame, dims: dict[str, DataFrame], day_from, day_to) -> DataFrame:
    """``readings``: raw household readings (rid, capteur, date, measures).

    The days before the range are read for the last good values only, one
    aggregated row per sensor; windows run over the range."""
    raw = day_range(readings, day_from, day_to)
    lo, _ = day_range_bounds(day_from, day_to)
    seeds = rp.seed_values(readings, MEASURES, dt.datetime.combine(lo, dt.time()), tiebreak=("rid",))
    brut = rp.apply_seeds(rp.repair_seeded(raw, MEASURES, tiebreak=("rid",)), seeds, MEASURES)
    # ghost minutes only need (sensor, date), which the repair does not change
    ghosts = vr.virtual_readings(dims["capteur"], raw, day_from, day_to)
    brut_all = brut.unionByName(ghosts, allowMissingColumns=True)
    out = household_balance(brut_all, dims)
    return out.withColumn("day", F.col("date").cast("date"))


def run_files(
    spark,
    acq_root: str,
    store: str | FolderStore | ManifestStore,
    dims: dict[str, DataFrame],
    day_from,
    day_to,
    boxes=None,
    strict: bool = False,
    real_only: bool = False,
    quarantine: bool = False,
) -> dict[str, str]:
    """The whole daily chain for ``[day_from, day_to)``, from .acq files to outputs.

    ``store`` (a folder, or a store of ``sinks.stores``) holds parquet tables, all
    partitioned by ``day``: the raw tables
    ``brut_logement``, ``brut_station``, ``brut_caisson`` by the day of the
    *file* (a file may hold a reading of the next midnight; it stays with its
    file), ``brut_virtuel`` (ghost rows), ``dernier_bon`` (last good values
    per sensor and file day, which seed later days), ``etat`` (the same merged to
    one row per sensor, as of the first day after a run), ``test_logement``,
    ``test_station``, ``test_caisson`` and the report ``facteurs_manquants``.
    Every step replaces all days of the range, also those that have no rows
    any more, and no other day; transforms read the file days of the range and
    the one before.  A range gives the same tables as its days run in order.

    ``strict``: stop before the outputs if a required factor is missing (the
    report is written).  ``real_only``: household means over real sensors only.
    ``quarantine``: lines that do not parse go to ``rejets_<kind>`` with their file,
    text and reason instead of being stored with nulls, so the lines of the files
    are the rows stored and those rejected.
    Returns the table paths.
    """
    boxes = boxes or HOUSEHOLD_BOXES
    sink.shared_dir(spark)  # a clear error if the cluster names no shared folder
    store = as_store(store)
    paths = {name: store.path(name) for name in TABLES}
    lo, hi = day_range_bounds(day_from, day_to)

    def readings(table, kind):
        """Rows of the range by date: file days of the range and the day before."""
        days = store.read(spark, table, acq.brut_schema(kind), lo - dt.timedelta(days=1), hi)
        return day_range(days, lo, hi).drop("day")

    # 1. raw tables: one scan per kind over all files of the range
    for kind in KINDS:
        measures = acq.MEASURES[kind]
        if quarantine:
            lines = acq.read_acq_checked(spark, acq_root, kind, lo, hi, boxes)
            store.replace(rejected(lines), f"rejets_{kind}", lo, hi, ("file_name",))
            lines = lines.where("reason is null").drop("line", "reason")
        else:
            lines = acq.read_acq(spark, acq_root, kind, lo, hi, boxes)
        brut = file_days(lines, measures)
        if kind == "logement":
            state = state_before(spark, store, measures, lo)
            # written once to the shared folder: four steps read it
            brut, own = with_seeds(brut.checkpoint(eager=True), state, measures)
            store.replace(own, "dernier_bon", lo, hi, ("capteur",))
            # later states were made without these days
            after = rp.compact_state(state.unionByName(own), measures, hi)
            store.replace(after, "etat", lo + dt.timedelta(days=1), dt.date.max, ("capteur",))
        store.replace(brut.drop("file_name"), f"brut_{kind}", lo, hi, ("capteur", "date"))

    # 2. ghost readings of virtual sensors, from the household readings just
    #    stored, into their own table (a virtual sensor's file readings, if
    #    any, stay untouched)
    logement = readings("brut_logement", "logement")
    ghosts = vr.virtual_readings(dims["capteur"], logement, lo, hi)
    store.replace(sink.with_day(ghosts), "brut_virtuel", lo, hi, ("capteur",))

    # 3. the factors that the readings of the range miss
    station, caisson = readings("brut_station", "station"), readings("brut_caisson", "caisson")
    known = hh.keyed(lk.join_sensor_dim(logement, dims["capteur"]))
    missing = lk.missing_factors(
        known, dims["facteur_temperature"], dims["facteur_somme_surface_equivalente"], station
    )
    store.replace(missing.withColumn(sink.DAY, F.lit(lo)), "facteurs_manquants", lo, hi)
    if strict:
        schema = f"factor_table STRING, key STRING, {sink.DAY} DATE"
        check_factors(store.read(spark, "facteurs_manquants", schema, lo, lo + dt.timedelta(days=1)))

    # 4. transforms, each replacing its output days
    rows = logement.unionByName(readings("brut_virtuel", "logement"))
    out = household_balance(rows, dims, real_only=real_only, pages=band_pages(dims))
    store.replace(sink.with_day(out), "test_logement", lo, hi)
    st = weather_station(station, dims["facteur_temperature"])
    store.replace(sink.with_day(st), "test_station", lo, hi)
    store.replace(sink.with_day(calibrate_fanbox(caisson)), "test_caisson", lo, hi)
    return paths


def last_good_schema(measures) -> str:
    values = ", ".join(f"{m} DOUBLE, {m}_date TIMESTAMP_NTZ" for m in measures)
    return f"capteur STRING, usable DATE, {values}, day DATE"


def state_before(spark, store, measures, day: dt.date) -> DataFrame:
    """The last good values that the days from ``day`` on are seeded from.

    The newest merged state up to that day, one row per sensor, and the rows of
    the files since then; not the history."""
    schema = last_good_schema(measures)
    known = max((d for d in store.days(spark, "etat") if d <= day), default=None)
    since = store.read(spark, "dernier_bon", schema, known, day)
    if known is None:
        return since
    return store.read(spark, "etat", schema, known, known + dt.timedelta(days=1)).unionByName(since)


def day_range_bounds(day_from, day_to):
    def as_date(d):
        if isinstance(d, dt.datetime):
            return d.date()
        if isinstance(d, dt.date):
            return d
        return dt.date.fromisoformat(str(d))

    return as_date(day_from), as_date(day_to)
