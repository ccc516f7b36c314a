""".acq files (tab-separated, no header) with fixed schemas.

All files of a directory tree are read by ONE scan (``recursiveFileLookup``),
not one DataFrame per file; the file name comes from ``_metadata.file_name``
and decides the kind of the file, its box id and its day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as X
from ..functions import naming as nm

_D = T.DoubleType()

# Column layouts of the three kinds of files.
LOGEMENT_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(c, _D) for c in ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")]
)
CAISSON_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(c, _D) for c in ("vide1", "vide2", "vide3", "puissance", "pression", "consommation")]
)
STATION_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(c, _D) for c in ("temperature", "hr", "orientation", "vitesse_vent", "co2")]
)

SCHEMAS = {"logement": LOGEMENT_SCHEMA, "caisson": CAISSON_SCHEMA, "station": STATION_SCHEMA}
MEASURES = {
    "logement": ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2"),
    "caisson": ("puissance", "pression", "consommation"),
    "station": ("temperature", "hr", "orientation", "vitesse_vent", "co2"),
}


def brut_schema(kind: str) -> str:
    """Schema of a raw table written by the ingest, with its partition columns."""
    cols = ", ".join(f"{m} DOUBLE" for m in MEASURES[kind])
    return f"{cols}, date TIMESTAMP_NTZ, capteur STRING, day DATE"


def route_files(names: DataFrame, name: str = "file_name", boxes: Sequence[str] = X.HOUSEHOLD_BOXES) -> DataFrame:
    """Kind flags, box id and day of each file name (decoded)."""
    return names.withColumns(
        {
            "is_logement": nm.is_household_file(name, boxes),
            "is_caisson": nm.is_caisson_file(name),
            "is_station": nm.is_station_file(name),
            "box": nm.box_id(name),
            "file_day": nm.file_day(name),
        }
    )


def kind_filter(kind: str, name: str = "file_name", boxes: Sequence[str] = X.HOUSEHOLD_BOXES):
    if kind == "logement":
        return nm.is_household_file(name, boxes)
    if kind == "caisson":
        return nm.is_caisson_file(name)
    if kind == "station":
        return nm.is_station_file(name)
    raise ValueError(f"unknown kind {kind!r}")


def _selected(df: DataFrame, kind: str, day_from, day_to, boxes: Sequence[str]) -> DataFrame:
    """Rows of the files of ``kind`` and of the days ``[day_from, day_to)`` in their names, with ``file_name`` (decoded)."""
    df = df.withColumn("file_name", nm.decode_file_name(F.col("_metadata.file_name")))
    df = df.where(kind_filter(kind, "file_name", boxes))
    day = nm.file_day("file_name")
    if day_from is not None:
        df = df.where(day >= F.lit(day_from).cast("date"))
    if day_to is not None:
        df = df.where(day < F.lit(day_to).cast("date"))
    return df


def read_acq(
    spark: SparkSession,
    root: str,
    kind: str,
    day_from=None,
    day_to=None,
    boxes: Sequence[str] = X.HOUSEHOLD_BOXES,
) -> DataFrame:
    """Lines of every .acq file of ``kind`` below ``root``.

    Returns ``file_name`` (decoded), ``Date`` (text) and the measure columns.
    ``day_from``/``day_to`` select files by the day in their name.
    Unparsable numbers become null (CSV PERMISSIVE mode).
    """
    df = (
        spark.read.schema(SCHEMAS[kind])
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.acq")
        .csv(root)
    )
    return _selected(df, kind, day_from, day_to, boxes).select("file_name", "Date", *MEASURES[kind])


#: why a line is rejected, in the order in which the reasons are looked at
REASONS = ("columns", "date", "number")


def read_acq_checked(
    spark: SparkSession,
    root: str,
    kind: str,
    day_from=None,
    day_to=None,
    boxes: Sequence[str] = X.HOUSEHOLD_BOXES,
) -> DataFrame:
    """As ``read_acq``, with ``line`` (the text of the line) and ``reason``, null for a sound line.

    ``columns``: fewer than the layout has; ``date``: it does not parse; ``number``:
    a measure that is there does not parse.  An empty field is a missing measure and
    further columns are ignored, as in ``read_acq``.  Blank lines are no lines."""
    schema = SCHEMAS[kind]
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.acq").text(root)
    df = _selected(df, kind, day_from, day_to, boxes).where(F.trim("value") != "")
    parsed = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"sep": "\t"})
    df = df.select("file_name", F.col("value").alias("line"), F.split("value", "\t").alias("fields"), parsed.alias("p"))
    bad = F.lit(False)
    for i, name in enumerate(schema.names):
        if name in MEASURES[kind]:
            bad = bad | (F.col("p")[name].isNull() & (F.trim(F.get("fields", F.lit(i))) != ""))
    tests = (F.size("fields") < len(schema), nm.parse_acq_timestamp("p.Date").isNull(), bad)
    reason = F.coalesce(*[F.when(t, F.lit(r)) for t, r in zip(tests, REASONS, strict=True)])
    return df.select("file_name", "p.Date", *[f"p.{m}" for m in MEASURES[kind]], "line", reason.alias("reason"))


def list_acq(
    spark: SparkSession, root: str, kind: str, day_from=None, day_to=None, boxes: Sequence[str] = X.HOUSEHOLD_BOXES
) -> DataFrame:
    """The .acq files of ``kind`` as ``path, size, modified, day``, from the listing alone: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.acq").load(root)
    files = _selected(files.select("_metadata"), kind, day_from, day_to, boxes)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        nm.file_day("file_name").alias("day"),
    )
