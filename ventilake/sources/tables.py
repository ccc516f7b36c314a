"""S3: day slices of stored tables (parquet partitioned by day, or JDBC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import ntz_literal


def day_bounds(day) -> tuple[dt.date, dt.date]:
    d = day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))
    if isinstance(d, dt.datetime):
        d = d.date()
    return d, d + dt.timedelta(days=1)


def slice_days(df: DataFrame, day_from, day_to=None, date: str = "date") -> DataFrame:
    """Rows with ``day_from <= date < day_to`` (one day by default).

    Half-open, so the next midnight belongs to the next day; the one-minute
    look-back of the original has no effect on any output and is omitted.
    On a table partitioned by ``day`` the filter also prunes partitions.
    """
    lo, hi = day_bounds(day_from)
    if day_to is not None:
        hi = day_bounds(day_to)[0]
    out = df.where((F.col(date) >= ntz_literal(lo)) & (F.col(date) < ntz_literal(hi)))
    if "day" in df.columns:
        out = out.where((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(hi)))
    return out


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stored table.  Pass the schema for tables partitioned by a text key
    (the sensor id): partition values are otherwise type-inferred, and a box
    id such as '093' would come back as the number 93."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_day_table(spark: SparkSession, path: str, day_from, day_to=None, schema=None) -> DataFrame:
    """Default backend: parquet table partitioned by ``day``."""
    return slice_days(read_table(spark, path, schema), day_from, day_to)


def day_predicates(day_from, day_to=None, date: str = "date", splits: int = 1) -> list[str]:
    """SQL conditions that split ``[day_from, day_to)`` (one day by default).

    The first and last bound are the midnights themselves and those between
    are whole seconds, so every reading of the range meets exactly one."""
    lo, hi = day_bounds(day_from)
    if day_to is not None:
        hi = day_bounds(day_to)[0]
    start = dt.datetime.combine(lo, dt.time())
    seconds = int((dt.datetime.combine(hi, dt.time()) - start).total_seconds())
    n = max(1, min(splits, seconds))
    # JDBC escape syntax for timestamp literals: understood by every driver
    stamps = [f"{{ts '{start + dt.timedelta(seconds=seconds * i // n):%Y-%m-%d %H:%M:%S}'}}" for i in range(n + 1)]
    return [f"{date} >= {a} AND {date} < {b}" for a, b in zip(stamps, stamps[1:])]


def read_jdbc_days(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    day_from,
    day_to=None,
    date: str = "date",
    splits: int = 1,
) -> DataFrame:
    """JDBC backend: the day range is pushed into the database with one
    predicate per split (:func:`day_predicates`), so ``splits`` connections
    read in parallel instead of one."""
    predicates = day_predicates(day_from, day_to, date, splits)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
