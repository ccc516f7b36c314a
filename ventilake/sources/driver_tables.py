"""Mapping of the driver's parquet tables onto the sensor data model.

The checks and the benchmark run on generic tables (``events``, ``customer``,
``supplier``, ``part``).  This module derives, with plain column
expressions, the tables the pipelines expect:

============================  ==================================================
readings (brut_*)             ``events``: sensor = user_id, minute grid = hour of
                              ts, raw counts = affine functions of ``value``,
                              error code 61440 for error events
capteur                       ``customer``: eight sensors to a household, type
                              from the market segment, virtual when the balance
                              is < 0
facteur_temperature,          ``supplier`` (fewer suppliers than sensors, so
facteur_debit_position1       some sensors have no factor)
facteur_debit_position2       ``part``: 4 bands per sensor, with overlaps/gaps
facteur_debit_pression2       ``part``: 3 bands per sensor
facteur_somme_surface_eq.     ``customer``: the first sensor of each household
                              (none where its nation is 3)
============================  ==================================================

The same derivations are written in SQL in ``ventilake.oracle`` for the
independent check.  Only the columns used are read, so the parquet scans are
pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import SENTINEL

READING_KEYS = ("rid", "capteur", "date")
LOGEMENT_MEASURES = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")
STATION_MEASURES = ("temperature", "hr", "orientation", "vitesse_vent", "co2")
CAISSON_MEASURES = ("puissance", "pression", "consommation")


# Declared schemas of the driver tables read here: no footer reads to infer them.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _err(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(SENTINEL)).otherwise(value)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _raw_columns() -> dict[str, Column]:
    v = F.col("value")
    error = F.col("event_type") == "error"
    cols = [
        F.col("event_id").alias("rid"),
        F.col("user_id").cast("string").alias("capteur"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date"),
        _err(error, F.lit(1500.0) + F.floor(v * 10.0)).alias("temperature"),
        _err(error | ((F.col("event_type") == "view") & (v < 25.0)), F.lit(200.0) + F.floor(v)).alias("hr"),
        _err(error, F.floor(v * 2.0).cast("double")).alias("debit_position_1"),
        _err(error | ((F.col("event_type") == "click") & (v > 400.0)), F.floor(v * 1.5).cast("double")).alias(
            "debit_pression_1"
        ),
        _err(error, F.lit(300.0) + F.floor(v)).alias("co2"),
        _err(error, F.floor(v * 2.0).cast("double")).alias("orientation"),
        _err(error | ((F.col("event_type") == "purchase") & (v < 10.0)), F.floor(v / 10.0).cast("double")).alias(
            "vitesse_vent"
        ),
        _err(error, F.floor(v * 2.0).cast("double")).alias("puissance"),
        _err(error, F.lit(61.0) + F.floor(v * 1.5)).alias("pression"),
        _err(error, v).alias("consommation"),
    ]
    names = ["rid", "capteur", "date", *LOGEMENT_MEASURES, "orientation", "vitesse_vent", *CAISSON_MEASURES]
    return dict(zip(names, cols))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw measure columns of all three reading kinds, with error codes."""
    return _events(spark, sf_dir).select(*_raw_columns().values())


def logement_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir).select(*READING_KEYS, *LOGEMENT_MEASURES)


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir).select(*READING_KEYS, *STATION_MEASURES)


def caisson_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir).select(*READING_KEYS, *CAISSON_MEASURES)


def acq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of .acq files as the file reader returns them.

    One file per (box, kind, day): the name carries the box (user id on three
    digits) and the day; the first column is the text timestamp, and a few
    rows carry an unparsable one.
    """
    box = F.lpad(F.col("user_id").cast("string"), 3, "0")
    prefix = (
        F.when(F.col("event_type") == "view", F.lit("Station météo "))
        .when(F.col("event_type") == "click", F.lit("caisson "))
        .when(F.col("event_type") == "purchase", F.lit("Salle 1 "))
        .when(F.col("event_type") == "signup", F.lit("Capteur "))
        .otherwise(F.lit("Salle de bain "))
    )
    name = F.concat(prefix, box, F.lit(" le "), F.date_format("ts", "dd MM yyyy"), F.lit(".acq"))
    text = F.when(
        (F.col("event_type") == "signup") & (F.col("value") < 5.0), F.lit("bad")
    ).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    raw = _raw_columns()
    measures = [raw[m] for m in LOGEMENT_MEASURES]
    return _events(spark, sf_dir).select(raw["rid"], name.alias("file_name"), text.alias("Date"), *measures)


def capteur(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    seg = F.col("c_mktsegment")
    typ = (
        F.when(seg == "BUILDING", "EA")
        .when(seg.isin("HOUSEHOLD", "MACHINERY"), "Bouche")
        .when(seg == "AUTOMOBILE", "Station")
        .otherwise("Ambiance")
    )
    return c.select(
        F.col("c_custkey").cast("string").alias("id_capteur"),
        F.floor(F.col("c_custkey") / 8).cast("string").alias("logement"),
        F.when(F.col("c_acctbal") < 1500.0, "WC").otherwise("Sejour").alias("piece"),
        typ.alias("type"),
        (F.col("c_acctbal") >= 0.0).alias("reel"),
    )


def facteur_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return s.select(
        F.col("s_suppkey").cast("string").alias("capteur_facteur"), (F.col("s_acctbal") / 1000.0).alias("fct1")
    )


def facteur_debit_position1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return s.select(
        F.col("s_suppkey").cast("string").alias("capteur_facteur"), (F.col("s_acctbal") / 10000.0).alias("fct1")
    )


def facteur_debit_position2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    j = F.col("p_partkey") % 4
    size = F.col("p_size")
    return p.select(
        F.floor(F.col("p_partkey") / 4).cast("string").alias("capteur_facteur"),
        (F.col("p_retailprice") / 1000.0).alias("fct1"),
        (size / 100.0).alias("fct2"),
        (-size / 100000.0).alias("fct3"),
        (j / 1000000.0).alias("fct4"),
        (j * 250.0).alias("borne_inf"),
        (j * 250.0 + 200.0 + size * 2.0).alias("borne_sup"),
        F.when(size % 7 == 0, F.lit(None).cast("double"))
        .when(size % 5 == 0, F.col("p_retailprice") / 100.0)
        .otherwise(F.lit(0.0))
        .alias("valeur_defaut"),
    )


def facteur_debit_pression2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    j = F.col("p_partkey") % 3
    size = F.col("p_size")
    return p.select(
        F.floor(F.col("p_partkey") / 3).cast("string").alias("capteur_facteur"),
        (size / 10.0).alias("fct1"),
        (F.col("p_retailprice") / 10000.0).alias("fct2"),
        (-size / 1000000.0).alias("fct3"),
        (j * 350.0).alias("borne_inf"),
        (j * 350.0 + 300.0 + size * 2.0).alias("borne_sup"),
    )


def facteur_somme_surface_equivalente(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    c = c.where((F.col("c_custkey") % 8 == 0) & (F.col("c_nationkey") != 3))
    return c.select(
        F.floor(F.col("c_custkey") / 8).cast("string").alias("logement_facteur"),
        (F.col("c_nationkey") * 0.25 + 0.5).alias("fct1"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "capteur": capteur(spark, sf_dir),
        "facteur_temperature": facteur_temperature(spark, sf_dir),
        "facteur_debit_position1": facteur_debit_position1(spark, sf_dir),
        "facteur_debit_position2": facteur_debit_position2(spark, sf_dir),
        "facteur_debit_pression2": facteur_debit_pression2(spark, sf_dir),
        "facteur_somme_surface_equivalente": facteur_somme_surface_equivalente(spark, sf_dir),
    }
