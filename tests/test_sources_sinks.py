"""File ingest (.acq), routing by file name, JDBC round trip, idempotent day replace."""

import os

from pyspark.sql import functions as F

from ventilake.functions.fixed import SENTINEL
from ventilake.plans import ingest
from ventilake.sinks import tables as sink
from ventilake.sources import acq
from ventilake.sources import tables as src

STATION_LINES = [
    "03/02/2021 00:00\t4500\t61440\t512\t10\t400",
    "03/02/2021 00:01\t4510\t800\t1023\t10\t400",
    "03/02/2021 00:02\t61440\t61440\t64\t10\t400",
    "03/02/2021 00:03\t61440\t805\t65\t10\t400",
    "bad\tx\t1\t1\t1\t1",
]


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_read_and_ingest_station_files(spark, tmpdir_fresh):
    root = tmpdir_fresh
    _write(root, "Station météo 05 le 03 02 2021.acq", STATION_LINES)
    _write(os.path.join(root, "sub"), "Station météo 07 le 04 02 2021.acq", STATION_LINES[:2])
    _write(root, "Salle 1 162 le 03 02 2021.acq", ["03/02/2021 00:00\t1\t2\t3\t4\t5"])
    _write(root, "notes.txt", ["x"])
    lines = acq.read_acq(spark, root, "station")
    assert sorted({r["file_name"] for r in lines.collect()}) == [
        "Station météo 05 le 03 02 2021.acq",
        "Station météo 07 le 04 02 2021.acq",
    ]
    brut = ingest.ingest_lines(lines, acq.MEASURES["station"])
    rows = brut.where(F.col("capteur") == "05").orderBy(F.col("date").asc_nulls_first()).collect()
    # the unparsable line has a null date and sorts first within its file
    assert rows[0]["date"] is None
    good = [r for r in rows if r["date"] is not None]
    assert [r["temperature"] for r in good] == [4500.0, 4510.0, 4510.0, 4510.0]
    assert [r["hr"] for r in good] == [1.0, 800.0, 800.0, 805.0]
    assert all(r["orientation"] != SENTINEL for r in good)
    one_day = acq.read_acq(spark, root, "station", day_from="2021-02-04", day_to="2021-02-05")
    assert {r["file_name"] for r in one_day.collect()} == {"Station météo 07 le 04 02 2021.acq"}
    first = ingest.batch_day(brut).where(F.col("file_name").startswith("Station météo 05")).first()
    assert str(first["batch_day"]) == "2021-02-03"


def test_household_file_pattern_and_box(spark, tmpdir_fresh):
    names = spark.createDataFrame(
        [
            ("Salle 1 162 le 03 02 2021.acq",),
            ("Salle 1 999 le 03 02 2021.acq",),
            ("caisson 12 le 03 02 2021.acq",),
            ("Station météo 05 le 03 02 2021.acq",),
            ("random.acq",),
        ],
        "file_name string",
    )
    out = {r["file_name"]: r for r in acq.route_files(names).collect()}
    assert out["Salle 1 162 le 03 02 2021.acq"]["is_logement"]
    assert out["Salle 1 162 le 03 02 2021.acq"]["box"] == "162"
    assert not out["Salle 1 999 le 03 02 2021.acq"]["is_logement"]
    assert out["caisson 12 le 03 02 2021.acq"]["is_caisson"]
    assert out["Station météo 05 le 03 02 2021.acq"]["is_station"]
    assert out["random.acq"]["box"] == "" and out["random.acq"]["file_day"] is None


def test_file_name_with_plus_and_spaces(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "Station météo A+B 09 le 03 02 2021.acq", STATION_LINES[:1])
    lines = acq.read_acq(spark, tmpdir_fresh, "station")
    assert lines.first()["file_name"] == "Station météo A+B 09 le 03 02 2021.acq"


def _readings(spark):
    return spark.createDataFrame(
        [
            (1, "a", "2024-01-01 10:00:00", 1.0),
            (2, "a", "2024-01-02 10:00:00", 2.0),
            (3, "b", "2024-01-02 23:59:00", 3.0),
            (4, "b", "2024-01-03 00:00:00", 4.0),
        ],
        "rid long, capteur string, d string, v double",
    ).withColumn("date", F.col("d").cast("timestamp_ntz")).drop("d")


def test_replace_days_is_idempotent(spark):
    path = sink.shared_dir(spark, "test_replace")
    df = _readings(spark)
    sink.replace_days(sink.with_day(df), path)
    new_day = df.where(F.col("rid") == 2).withColumn("v", F.lit(20.0))
    sink.replace_days(sink.with_day(new_day), path)
    once = sorted((r["rid"], r["v"]) for r in spark.read.parquet(path).collect())
    sink.replace_days(sink.with_day(new_day), path)
    twice = sorted((r["rid"], r["v"]) for r in spark.read.parquet(path).collect())
    # day 2024-01-02 now only holds the reloaded row; the next midnight (rid 4) is kept
    assert once == twice == [(1, 1.0), (2, 20.0), (4, 4.0)]
    sliced = src.read_day_table(spark, path, "2024-01-03")
    assert [r["rid"] for r in sliced.collect()] == [4]


def test_replace_range_empties_days_without_rows(spark):
    import datetime as dt

    path = sink.shared_dir(spark, "test_range")
    df = sink.with_day(_readings(spark))
    sink.replace_days(df, path)
    before = {r["rid"] for r in spark.read.parquet(path).collect()}
    kept = df.where("rid = 2")
    for _ in range(2):
        sink.replace_range(kept, path, dt.date(2024, 1, 2), dt.date(2024, 1, 4))
        # the day of rid 4 (2024-01-03) has no rows any more, the day of rid 1 is outside the range
        assert sorted(r["rid"] for r in spark.read.parquet(path).collect()) == [1, 2]
    assert before == {1, 2, 3, 4}


def test_day_predicates_cover_the_range_once():
    for splits in (1, 2, 13, 100_000):
        p = src.day_predicates("2024-01-02", splits=splits)
        bounds = [tuple(x.split("'")[1::2]) for x in p]
        assert bounds[0][0] == "2024-01-02 00:00:00" and bounds[-1][1] == "2024-01-03 00:00:00"
        assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:])) and all(a < b for a, b in bounds)


def test_append_partitioned(spark):
    path = sink.shared_dir(spark, "test_append")
    sink.append(sink.with_day(_readings(spark)), path)
    sink.append(sink.with_day(_readings(spark)), path)
    assert spark.read.parquet(path).count() == 8


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:ventilake_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = _readings(spark).select(
        F.col("rid").alias("RID"), F.col("capteur").alias("CAPTEUR"), F.col("date").cast("timestamp").alias("DATE"),
        F.col("v").alias("V"),
    )
    sink.jdbc_append(df, url, "BRUT", props)
    back = src.read_jdbc_days(spark, url, "BRUT", props, "2024-01-02", date="DATE", splits=2)
    assert back.rdd.getNumPartitions() == 2
    assert sorted(r["RID"] for r in back.collect()) == [2, 3]


def test_jdbc_replace_day(spark):
    url = "jdbc:derby:memory:ventilake_replace;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = _readings(spark).select(
        F.col("rid").alias("RID"), F.col("date").cast("timestamp").alias("DATE"), F.col("v").alias("V")
    )
    sink.jdbc_append(df, url, "TEST_LOGEMENT", props)
    new_day = df.where(F.col("RID") == 2).withColumn("V", F.lit(20.0))
    sink.jdbc_replace_day(new_day, url, "TEST_LOGEMENT", props, "2024-01-02", "2024-01-03", date="DATE")
    sink.jdbc_replace_day(new_day, url, "TEST_LOGEMENT", props, "2024-01-02", "2024-01-03", date="DATE")
    rows = sorted((r["RID"], r["V"]) for r in spark.read.jdbc(url, "TEST_LOGEMENT", properties=props).collect())
    assert rows == [(1, 1.0), (2, 20.0), (4, 4.0)]


def test_jdbc_subquery_with_dimension_join(spark):
    """S3: the day slice of a subquery joining readings and sensors, read by
    two connections (one predicate each)."""
    url = "jdbc:derby:memory:ventilake_sub;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = _readings(spark).select(
        F.col("rid").alias("RID"), F.col("capteur").alias("CAPTEUR"), F.col("date").cast("timestamp").alias("DATE")
    )
    sink.jdbc_append(df, url, "BRUT_LOGEMENT", {**props, "createTableColumnTypes": "CAPTEUR VARCHAR(32)"})
    cap = spark.createDataFrame([("a", "L1"), ("b", "L2")], "ID_CAPTEUR string, LOGEMENT string")
    sink.jdbc_append(
        cap, url, "CAPTEUR", {**props, "createTableColumnTypes": "ID_CAPTEUR VARCHAR(32), LOGEMENT VARCHAR(32)"}
    )
    query = "(SELECT b.RID, b.DATE, c.LOGEMENT FROM BRUT_LOGEMENT b JOIN CAPTEUR c ON b.CAPTEUR = c.ID_CAPTEUR) AS Q"
    out = src.read_jdbc_days(spark, url, query, props, "2024-01-02", date="DATE", splits=2)
    assert sorted((r["RID"], r["LOGEMENT"]) for r in out.collect()) == [(2, "L1"), (3, "L2")]


def test_day_selection_prunes_files(spark, tmpdir_fresh):
    """Filters on the file name are applied to the file listing: only the
    files of the selected kind and days are opened."""
    for day in ("03", "04", "05"):
        _write(tmpdir_fresh, f"Station météo 05 le {day} 02 2021.acq", [f"{day}/02/2021 00:00\t1\t2\t3\t4\t5"])
    _write(tmpdir_fresh, "caisson 12 le 04 02 2021.acq", ["04/02/2021 00:00\t0\t0\t0\t100\t200\t5"])
    df = acq.read_acq(spark, tmpdir_fresh, "station", day_from="2021-02-04", day_to="2021-02-05")
    assert df.count() == 1
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()

    def nodes(p):
        yield p
        if p.nodeName() == "AdaptiveSparkPlan":
            yield from nodes(p.executedPlan())
        it = p.children().iterator()
        while it.hasNext():
            yield from nodes(it.next())

    scans = [n for n in nodes(plan) if "Scan" in n.nodeName()]
    assert scans
    assert scans[0].metrics().apply("numFiles").value() == 1


def test_day_table_slice_prunes_partitions(spark):
    path = sink.shared_dir(spark, "test_prune")
    sink.replace_days(sink.with_day(_readings(spark)), path)
    df = src.read_day_table(spark, path, "2024-01-02")
    assert sorted(r["rid"] for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_household_and_fanbox_layouts(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "Salle 1 162 le 03 02 2021.acq", [
        "03/02/2021 10:00\t2600\t400\t100\t200\t409",
        "03/02/2021 10:01\t61440\t410\t61440\t210\t419",
    ])
    _write(tmpdir_fresh, "caisson 12 le 03 02 2021.acq", [
        "03/02/2021 10:00\t1\t2\t3\t100\t200\t5",
        "03/02/2021 10:01\t1\t2\t3\t61440\t201\t6",
    ])
    log = ingest.ingest_lines(acq.read_acq(spark, tmpdir_fresh, "logement"), acq.MEASURES["logement"])
    assert set(log.columns) == {"file_name", "date", "capteur", *acq.MEASURES["logement"]}
    rows = sorted((r["date"].minute, r["temperature"], r["debit_position_1"], r["co2"]) for r in log.collect())
    assert rows == [(0, 2600.0, 100.0, 409.0), (1, 2600.0, 100.0, 419.0)]
    fan = ingest.ingest_lines(acq.read_acq(spark, tmpdir_fresh, "caisson"), acq.MEASURES["caisson"])
    assert "vide1" not in fan.columns
    rows = sorted((r["capteur"], r["date"].minute, r["puissance"], r["pression"], r["consommation"]) for r in fan.collect())
    assert rows == [("12", 0, 100.0, 200.0, 5.0), ("12", 1, 100.0, 201.0, 6.0)]
