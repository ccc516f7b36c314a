"""Sentinel repair: equal to the original lag/adjust/fill chain; seeded fill."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ventilake.functions.fixed import SENTINEL
from ventilake.operators import repair as rp


def four_step(df, colname):
    """The original chain: lag, temp_adjust, zeroNonZero, forward fill (per series)."""
    w = Window.partitionBy("capteur").orderBy("date")
    m = df.withColumn("prev", F.lag(colname, 1).over(w))
    m = m.withColumn("adj", F.when(F.col(colname) == SENTINEL, F.col("prev")).otherwise(F.col(colname)))
    m = m.withColumn(
        "znz", F.when((F.col(colname) == SENTINEL) & (F.col("adj") == SENTINEL), F.lit(None)).otherwise(F.col("adj"))
    )
    return m.withColumn(
        colname, F.last("znz", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("prev", "adj", "znz")


series = st.lists(st.sampled_from([SENTINEL, 1.0, 2.0, 3.0]), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(series, min_size=1, max_size=4))
def test_repair_equals_four_step_chain(spark, all_series):
    rows = [
        (str(s), i, v)
        for s, values in enumerate(all_series)
        for i, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "capteur string, date int, v double")
    a = {r["capteur"] + ":" + str(r["date"]): r["v"] for r in rp.repair_sentinels(df, ["v"], by=("capteur",)).collect()}
    b = {r["capteur"] + ":" + str(r["date"]): r["v"] for r in four_step(df, "v").collect()}
    # the chain keeps the previous *raw* value on a single error; it differs only
    # where the previous raw value is itself a repaired error -- never, since
    # consecutive errors become null and are forward filled from the last good one
    assert a == b


def test_leading_errors_stay_null(spark):
    df = spark.createDataFrame(
        [("s", 1, SENTINEL), ("s", 2, SENTINEL), ("s", 3, 5.0), ("s", 4, SENTINEL), ("s", 5, None)],
        "capteur string, date int, v double",
    )
    out = [r["v"] for r in rp.repair_sentinels(df, ["v"], by=("capteur",)).orderBy("date").collect()]
    assert out == [None, None, 5.0, 5.0, 5.0]


def _ts(day, hour):
    return f"2024-01-{day:02d} {hour:02d}:00:00"


def test_seeded_equals_full_history_fill(spark):
    rnd = random.Random(7)
    rows = []
    rid = 0
    for s in range(5):
        for day in range(1, 6):
            for hour in range(0, 24, 3):
                rid += 1
                v = SENTINEL if rnd.random() < 0.4 else float(rnd.randint(0, 9))
                rows.append((rid, str(s), _ts(day, hour), v))
    df = spark.createDataFrame(rows, "rid long, capteur string, d string, v double").withColumn(
        "date", F.col("d").cast("timestamp_ntz")
    ).drop("d")
    seeded = {r["rid"]: r["v"] for r in rp.repair_seeded(df, ["v"], tiebreak=("rid",)).collect()}
    full = {
        r["rid"]: r["v"]
        for r in rp.repair_sentinels(df, ["v"], by=("capteur",), order=["date", "rid"]).collect()
    }
    assert seeded == full


def test_seed_values_from_history(spark):
    hist = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", 3.0), ("a", "2024-01-01 11:00:00", SENTINEL), ("b", "2024-01-02 00:00:00", 9.0)],
        "capteur string, d string, v double",
    ).withColumn("date", F.col("d").cast("timestamp_ntz")).drop("d")
    batch = spark.createDataFrame(
        [("a", "2024-01-02 00:00:00", None), ("b", "2024-01-02 01:00:00", None)],
        "capteur string, d string, v double",
    ).withColumn("date", F.col("d").cast("timestamp_ntz")).drop("d")
    seeds = rp.seed_values(hist, ["v"], "2024-01-02 00:00:00")
    out = {r["capteur"]: r["v"] for r in rp.apply_seeds(batch, seeds, ["v"]).collect()}
    # b's only history row is not before the batch start
    assert out == {"a": 3.0, "b": None}


def test_lag_previous(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), ("t", 1, 5.0)], "capteur string, date int, v double")
    out = {(r["capteur"], r["date"]): r["v_prev"] for r in rp.lag_previous(df, ["v"]).collect()}
    assert out == {("s", 1): None, ("s", 2): 1.0, ("t", 1): None}


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),  # sensor
            st.one_of(st.none(), st.integers(0, 5 * 60)),  # minute of the day, or an unparsable date
            st.sampled_from([SENTINEL, None, 1.0, 2.0, 3.0]),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_bucketed_equals_single_window(spark, rows):
    data = [
        (i, str(s), None if m is None else f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00", v)
        for i, (s, m, v) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, "rid long, capteur string, d string, v double").withColumn(
        "date", F.col("d").cast("timestamp_ntz")
    ).drop("d")
    bucket = F.date_trunc("hour", F.col("date")).cast("timestamp_ntz")
    a = {r["rid"]: r["v"] for r in rp.repair_bucketed(df, ["v"], ("capteur",), bucket, tiebreak=("rid",)).collect()}
    b = {r["rid"]: r["v"] for r in rp.repair_sentinels(df, ["v"], by=("capteur",), order=["date", "rid"]).collect()}
    assert a == b


def test_per_day_and_ingest_equal_one_window_per_file(spark):
    from ventilake.plans import ingest

    rnd = random.Random(3)
    rows = []
    for rid in range(200):
        day = rnd.randint(1, 3)
        minute = rnd.randint(0, 5 * 60)
        v = rnd.choice([SENTINEL, None, 1.0, 2.0, 3.0])
        rows.append((rid, str(rnd.randint(0, 2)), f"2024-01-{day:02d} {minute // 60:02d}:{minute % 60:02d}:00", v))
    df = spark.createDataFrame(rows, "rid long, capteur string, d string, v double").withColumn(
        "date", F.col("d").cast("timestamp_ntz")
    ).drop("d")
    whole = rp.repair_sentinels(df.withColumn("f", F.to_date("date")), ["v"], by=("capteur", "f"), order=["date", "rid"])
    a = {r["rid"]: r["v"] for r in whole.collect()}
    b = {r["rid"]: r["v"] for r in rp.repair_per_day(df, ["v"], tiebreak=("rid",)).collect()}
    assert a == b
    lines = df.select(
        "rid",
        F.concat(F.lit("Salle 1 "), F.col("capteur"), F.lit(" le "), F.date_format("date", "dd MM yyyy"), F.lit(".acq")).alias("file_name"),
        F.date_format("date", "dd/MM/yyyy HH:mm").alias("Date"),
        "v",
    )
    c = {r["rid"]: r["v"] for r in ingest.ingest_lines(lines, ["v"], ("rid",)).collect()}
    assert c == a


def test_lines_of_one_minute_have_a_fixed_order(spark):
    from ventilake.plans import ingest

    rows = [("Salle 1 9 le 01 01 2024.acq", "01/01/2024 00:00", v) for v in (1.0, 2.0, 3.0, SENTINEL)]
    rows.append(("Salle 1 9 le 01 01 2024.acq", "01/01/2024 00:01", SENTINEL))
    results = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        lines = spark.createDataFrame(order, "file_name string, Date string, v double").repartition(3)
        out = ingest.ingest_lines(lines, ["v"])
        results.add(tuple(sorted((r["date"].minute, r["v"] or 0.0) for r in out.collect())))
    assert len(results) == 1
