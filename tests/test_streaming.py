"""File-stream ingest: new files are processed once; reprocessing is idempotent."""

import os
import tempfile

from ventilake.sinks import tables as sink
from ventilake.sources.tables import read_table
from ventilake.streaming.acq_ingest import start_ingest, stream_schema

from test_sources_sinks import STATION_LINES, _write


def test_stream_ingest_available_now(spark):
    landing = tempfile.mkdtemp(prefix="ventilake-landing-")
    table = sink.shared_dir(spark, "stream_table")
    ckpt = sink.shared_dir(spark, "stream_ckpt")
    _write(landing, "Station météo 05 le 03 02 2021.acq", STATION_LINES)
    q = start_ingest(spark, landing, "station", table, ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(table)
    assert first.count() == len(STATION_LINES)
    _write(os.path.join(landing, "later"), "Station météo 07 le 04 02 2021.acq", STATION_LINES[:2])
    q = start_ingest(spark, landing, "station", table, ckpt)
    q.awaitTermination(120)
    rows = read_table(spark, table, stream_schema("station")).collect()
    assert len(rows) == len(STATION_LINES) + 2
    assert {r["capteur"] for r in rows} == {"05", "07"}
    # a fresh checkpoint reprocesses every file; the partition replace keeps the table unchanged
    q = start_ingest(spark, landing, "station", table, sink.shared_dir(spark, "stream_ckpt2"))
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == len(STATION_LINES) + 2


def test_stream_seeds_leading_errors_from_table(spark):
    landing = tempfile.mkdtemp(prefix="ventilake-landing-")
    table = sink.shared_dir(spark, "stream_seed_table")
    ckpt = sink.shared_dir(spark, "stream_seed_ckpt")
    _write(landing, "Salle 1 162 le 03 02 2021.acq", ["03/02/2021 23:00\t2600\t400\t100\t200\t409"])
    start_ingest(spark, landing, "logement", table, ckpt, seeded=True).awaitTermination(120)
    _write(landing, "Salle 1 162 le 04 02 2021.acq", [
        "04/02/2021 00:00\t61440\t61440\t61440\t61440\t61440",
        "04/02/2021 00:01\t2700\t410\t110\t210\t419",
    ])
    start_ingest(spark, landing, "logement", table, ckpt, seeded=True).awaitTermination(120)
    rows = {r["date"].day * 10000 + r["date"].minute: r for r in read_table(spark, table, stream_schema("logement")).collect()}
    first_of_day = rows[4 * 10000 + 0]
    assert first_of_day["temperature"] == 2600.0 and first_of_day["co2"] == 409.0
    assert rows[4 * 10000 + 1]["temperature"] == 2700.0


def test_late_file_leaves_its_neighbours(spark):
    landing = tempfile.mkdtemp(prefix="ventilake-landing-")
    table = sink.shared_dir(spark, "stream_late_table")
    ckpt = sink.shared_dir(spark, "stream_late_ckpt")
    _write(landing, "Salle 1 162 le 04 02 2021.acq", ["04/02/2021 00:00\t2600\t400\t100\t200\t409", "04/02/2021 00:01\t2601\t400\t100\t200\t409"])
    start_ingest(spark, landing, "logement", table, ckpt).awaitTermination(120)
    # a late file of the day before that ends with the next midnight, and a second file of the same sensor-day
    _write(landing, "Salle 1 162 le 03 02 2021.acq", ["03/02/2021 23:59\t2500\t400\t100\t200\t409", "04/02/2021 00:00\t2501\t400\t100\t200\t409"])
    _write(landing, "Salle 2 162 le 04 02 2021.acq", ["04/02/2021 00:02\t2602\t400\t100\t200\t409"])
    start_ingest(spark, landing, "logement", table, ckpt).awaitTermination(120)
    rows = read_table(spark, table, stream_schema("logement")).collect()
    assert sorted(r["temperature"] for r in rows) == [2500.0, 2501.0, 2600.0, 2601.0, 2602.0]
