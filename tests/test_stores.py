"""Versioned days behind a manifest, merged state, and streams with late files."""

import datetime as dt
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from test_household import _dims
from test_sources_sinks import _write
from ventilake.operators import repair as rp
from ventilake.plans.daily import last_good_schema, run_files
from ventilake.sinks import stores
from ventilake.sinks import tables as sink
from ventilake.sources import acq
from ventilake.sources.tables import read_table
from ventilake.streaming.acq_ingest import start_ingest, stream_schema

SCHEMA = "rid LONG, v DOUBLE, day DATE"
DAY0 = dt.date(2024, 1, 1)


def _rows(spark, days, v, per_day=2):
    rows = [(k, v, DAY0 + dt.timedelta(days=d)) for d in days for k in range(per_day)]
    return spark.createDataFrame(rows, SCHEMA)


def _kept(store, spark, *span):
    rows = store.read(spark, "t", SCHEMA, *span).collect()
    out = {}
    for r in rows:
        out.setdefault((r["day"] - DAY0).days, []).append(r["v"])
    return {d: sorted(set(v)) for d, v in sorted(out.items())}


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 12)), max_size=12))
@settings(max_examples=200)
def test_entries_name_one_version_per_day(loads):
    entries, want = [], {}
    for k, (lo, n) in enumerate(loads):
        entries = stores.put(entries, stores.Entry(DAY0 + dt.timedelta(days=lo), DAY0 + dt.timedelta(days=lo + n), f"v{k}"))
        want |= {lo + i: f"v{k}" for i in range(n)}
    got = {}
    for e in entries:
        assert e.day_from < e.day_to
        for i in range((e.day_to - e.day_from).days):
            assert got.setdefault((e.day_from - DAY0).days + i, e.version) == e.version
    assert got == want and sum((e.day_to - e.day_from).days for e in entries) == len(got)


@pytest.mark.parametrize("make", [stores.FolderStore, stores.ManifestStore])
def test_stores_replace_and_read_ranges(spark, make):
    store, day = make(sink.shared_dir(spark, "stores")), lambda k: DAY0 + dt.timedelta(days=k)
    assert _kept(store, spark) == {} and store.days(spark, "t") == []
    store.replace(_rows(spark, range(6), 1.0), "t", day(0), day(6))
    for _ in range(2):  # day 3 has no rows any more; rows outside the range are not written
        store.replace(_rows(spark, (2, 4, 5), 2.0), "t", day(2), day(5), ("rid",))
        assert _kept(store, spark) == {0: [1.0], 1: [1.0], 2: [2.0], 4: [2.0], 5: [1.0]}
    assert _kept(store, spark, day(1), day(5)) == {1: [1.0], 2: [2.0], 4: [2.0]}
    assert set(store.days(spark, "t")) >= {day(0), day(1), day(2), day(4), day(5)}
    store.replace(_rows(spark, (), 3.0), "t", day(0), dt.date.max)
    assert _kept(store, spark) == {}


def test_a_job_killed_before_the_switch_leaves_the_old_days(spark, monkeypatch):
    store, hi = stores.ManifestStore(sink.shared_dir(spark, "killed")), DAY0 + dt.timedelta(days=3)
    store.replace(_rows(spark, range(3), 1.0), "t", DAY0, hi)
    reader = store.read(spark, "t", SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(stores.ManifestStore, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.replace(_rows(spark, (0, 1), 2.0), "t", DAY0, hi)
    assert _kept(store, spark) == {0: [1.0], 1: [1.0], 2: [1.0]}
    store.replace(_rows(spark, (0, 1), 2.0), "t", DAY0, hi)
    assert _kept(store, spark) == {0: [2.0], 1: [2.0]}
    # a reader that began before the switch goes on with the days it saw
    assert {r["v"] for r in reader.collect()} == {1.0}
    assert len(store.vacuum(spark, "t")) == 2 and _kept(store, spark) == {0: [2.0], 1: [2.0]}


def test_a_taken_manifest_number_is_passed_over(spark, monkeypatch):
    """A second writer switched between this one's reading and renaming: both ranges are there."""
    store, day = stores.ManifestStore(sink.shared_dir(spark, "taken")), lambda k: DAY0 + dt.timedelta(days=k)
    store.replace(_rows(spark, range(4), 1.0), "t", day(0), day(4))
    read, calls = stores.ManifestStore.manifest, []

    def late(self, spark_, table):
        out = read(self, spark_, table)
        if not calls:
            calls.append(1)
            store.replace(_rows(spark, (1,), 2.0), "t", day(1), day(2))
        return out

    monkeypatch.setattr(stores.ManifestStore, "manifest", late)
    store.replace(_rows(spark, (2,), 3.0), "t", day(2), day(3))
    assert _kept(store, spark) == {0: [1.0], 1: [2.0], 2: [3.0], 3: [1.0]}


def test_a_year_is_replaced_without_a_job_per_day(spark):
    store, tracker = stores.ManifestStore(sink.shared_dir(spark, "year")), spark.sparkContext.statusTracker()
    for k in range(2):
        spark.sparkContext.setJobGroup(f"year-{k}", "replace")
        store.replace(_rows(spark, range(0, 365, 7), float(k), 1).coalesce(1), "t", DAY0, DAY0 + dt.timedelta(days=365))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(tracker.getJobIdsForGroup(f"year-{k}")) <= 4
    out = store.read(spark, "t", SCHEMA, DAY0 + dt.timedelta(days=350))
    assert [r["v"] for r in out.collect()] == [1.0, 1.0, 1.0]


def _line(stamp, t):
    return f"{stamp}\t{t}\t400\t100\t200\t409"


def test_the_chain_on_a_manifest_store(spark, tmpdir_fresh):
    root = tmpdir_fresh
    _write(root, "Salle 1 162 le 03 02 2021.acq", [_line("03/02/2021 10:00", 2600), _line("04/02/2021 00:00", 2610)])
    _write(root, "Salle 1 162 le 04 02 2021.acq", [_line("04/02/2021 00:01", 61440), _line("04/02/2021 00:02", 2710)])
    dims = _dims(spark)
    dims["capteur"] = dims["capteur"].union(spark.createDataFrame([("162", "L1", "Sejour", "EA", True)], dims["capteur"].schema))
    tables = []
    for store in (stores.FolderStore(sink.shared_dir(spark, "f")), stores.ManifestStore(sink.shared_dir(spark, "m"))):
        for a, b in ((3, 4), (4, 5), (3, 4)):
            run_files(spark, root, store, dims, f"2021-02-{a:02d}", f"2021-02-{b:02d}")
        out_schema = spark.read.parquet(store.path("test_logement")).drop("version").schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out_schema if f.name != "day") + ", day DATE"
        brut = acq.brut_schema("logement")
        tables.append([sorted(map(str, store.read(spark, n, s).collect())) for n, s in (("brut_logement", brut), ("brut_virtuel", brut), ("test_logement", ddl))])
    assert tables[0] == tables[1] and all(tables[0])


@settings(max_examples=6, deadline=None)
@given(st.randoms(use_true_random=False))
def test_merged_state_gives_the_seeds_of_the_whole_history(spark, rnd):
    measures = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")
    rows = []
    for d in range(12):
        for s in "abc":
            if rnd.random() < 0.7:
                usable = d + (rnd.random() < 0.3)
                when = dt.datetime.combine(DAY0, dt.time()) + dt.timedelta(days=usable, minutes=rnd.randrange(3))
                values = [x for _ in measures for x in ((float(rnd.randrange(9)), when) if rnd.random() < 0.6 else (None, None))]
                rows.append((s, DAY0 + dt.timedelta(days=usable), *values, DAY0 + dt.timedelta(days=d)))
    state = spark.createDataFrame(rows, last_good_schema(measures))
    asks = spark.createDataFrame([(s, DAY0 + dt.timedelta(days=d)) for s in "abcd" for d in range(8, 14)], "capteur string, day date")
    want = sorted(map(str, rp.seeds_by_day(state, asks, measures).collect()))
    merged = state.where("false")
    for at in (3, 4, 8):
        as_of = DAY0 + dt.timedelta(days=at)
        merged = rp.compact_state(merged.unionByName(state.where(F.col("day") < F.lit(as_of)).subtract(merged)), measures, as_of)
        assert merged.count() <= 6
    both = merged.select(*state.columns).unionByName(state.where(F.col("day") >= F.lit(as_of)))
    assert sorted(map(str, rp.seeds_by_day(both, asks, measures).collect())) == want


def _files():
    """Three days of two sensors, with leading errors, a midnight reading and a file of errors alone."""
    bad = "61440\t61440\t61440\t61440\t61440"
    return {
        "Salle 1 162 le 01 02 2021.acq": [_line("01/02/2021 10:00", 2100), _line("02/02/2021 00:00", 2150)],
        "Salle 1 162 le 02 02 2021.acq": [f"02/02/2021 00:00\t{bad}", "02/02/2021 11:00\t2200\t61440\t61440\t220\t61440"],
        "Salle 1 162 le 03 02 2021.acq": [f"03/02/2021 08:00\t{bad}", f"03/02/2021 09:00\t{bad}"],
        "Salle 1 162 le 04 02 2021.acq": [f"04/02/2021 08:00\t{bad}", _line("04/02/2021 09:00", 2400)],
        "Salle 2 093 le 02 02 2021.acq": [_line("02/02/2021 10:00", 3200)],
        "Salle 2 093 le 04 02 2021.acq": [f"04/02/2021 00:00\t{bad}"],
    }


def test_late_files_give_the_table_of_a_run_in_order(spark):
    files = _files()
    in_order = sorted(files, key=lambda n: (n[-14:-4].split()[::-1], n))
    shuffled = [in_order[i] for i in (5, 3, 0, 4, 2, 1)]
    tables = []
    for batches in ([in_order], [[n] for n in in_order], [[n] for n in shuffled] + [shuffled[2:3]]):
        landing, table = tempfile.mkdtemp(prefix="ventilake-late-"), sink.shared_dir(spark, "late_table")
        ckpt = sink.shared_dir(spark, "late_ckpt")
        for k, names in enumerate(batches):
            for n in names:  # a file that comes again lands in another folder
                _write(os.path.join(landing, str(k)), n, files[n])
            start_ingest(spark, landing, "logement", table, ckpt, seeded=True).awaitTermination(120)
        rows = read_table(spark, table, stream_schema("logement")).collect()
        tables.append(sorted(map(str, (sorted(r.asDict().items()) for r in rows))))
    assert len(tables[0]) == 10 and tables[0] == tables[1] == tables[2]
    by = {(r["capteur"], r["date"].day, r["date"].hour): r["temperature"] for r in rows}
    # the midnight reading of 01/02 seeds 03/02 on, but not 02/02
    assert by[("162", 3, 8)] == 2200.0 and by[("162", 4, 8)] == 2200.0 and by[("093", 4, 0)] == 3200.0
    hr = {(r["date"].day, r["date"].hour): r["hr"] for r in rows if r["capteur"] == "162"}
    assert hr[(2, 11)] == 400.0 and hr[(4, 8)] == 400.0
    # the state holds files and sensors, not readings
    etat = spark.read.parquet(f"{table}_etat/etat")
    assert (etat.groupBy("day", "capteur").count().agg(F.max("count")).first()[0] or 0) <= 2


def test_a_micro_batch_reads_no_history(spark, monkeypatch):
    """Readings of stored files are opened only where a late file changes their seeds."""
    from ventilake.streaming import acq_ingest

    opened = []
    kept = acq_ingest.read_table
    monkeypatch.setattr(acq_ingest, "read_table", lambda s, path, schema=None: opened.append(path) or kept(s, path, schema))
    files, landing, table = _files(), tempfile.mkdtemp(prefix="ventilake-nohist-"), sink.shared_dir(spark, "nohist")
    ckpt = sink.shared_dir(spark, "nohist_ckpt")
    names = sorted(files, key=lambda n: n[-14:-4].split()[::-1])
    for n in names:
        _write(landing, n, files[n])
        start_ingest(spark, landing, "logement", table, ckpt, seeded=True).awaitTermination(120)
    assert opened == []
