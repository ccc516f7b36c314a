"""K1-K3: append and idempotent day replacement (parquet by default, JDBC too).

Raw and output tables are stored partitioned by ``day``.  Re-loading a range
of days replaces exactly those days: partitions with new rows are overwritten
(``partitionOverwriteMode=dynamic``), stored days of the range without new
rows are emptied, other days are untouched.  Running a load twice gives the
same table as running it once.  This replaces the original's "DELETE ...
WHERE date BETWEEN" + append, which also removed the next midnight.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir`` of the cluster.

    The setting must be there: a folder of this machine would not be seen by
    the executors."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(base, *parts, uuid.uuid4().hex)


def with_day(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn(DAY, F.col(date).cast("date"))


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by output partition before a partitioned write.

    Without it every task of a wide stage writes one file per day it holds
    (tasks x days small files).  The ``rebalance`` hint shuffles on the
    partition columns and lets AQE split a large day into slices of the
    advisory size and merge small ones, so each task writes one day slice."""
    return df.hint("rebalance", *partition_by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (DAY,)) -> None:
    """K1: append rows to a parquet table partitioned by ``partition_by``."""
    rebalanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_days(df: DataFrame, path: str, partition_by: Sequence[str] = (DAY,), sort_by: Sequence[str] = ()) -> None:
    """K2/K3: replace the partitions present in ``df``; see :func:`replace_range`
    for days that may have lost all their rows."""
    out = rebalanced(df, partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def hadoop_path(spark: SparkSession, path: str):
    """``path`` for the file system that Spark itself uses."""
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def day_folders(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The stored days of a table and their folders, from one listing of the table's folder."""
    folder = hadoop_path(spark, path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        if name.startswith(f"{DAY}=") and status.isDirectory():
            try:
                out[dt.date.fromisoformat(name.split("=", 1)[1])] = f"{path}/{name}"
            except ValueError:  # rows without a day
                continue
    return out


def day_files(spark: SparkSession, path: str, day_from: dt.date, day_to: dt.date) -> dict[str, set[str]]:
    """The files of the stored days of a range, by day folder: one listing for all days."""
    folders = [f for d, f in day_folders(spark, path).items() if day_from <= d < day_to]
    out: dict[str, set[str]] = {}
    if folders:
        for file in spark.read.schema("none INT").parquet(*folders).inputFiles():
            out.setdefault(re.search(rf"/({DAY}=[^/]*)/", file)[1], set()).add(file)
    return out


def replace_range(df: DataFrame, path: str, day_from: dt.date, day_to: dt.date, sort_by: Sequence[str] = ()) -> None:
    """Replace all days of ``[day_from, day_to)``, also those without new rows.

    The days with rows are overwritten by one write; stored days of the range
    that it left as they were had no rows and are then overwritten with nothing.
    The files are listed once before and once after, whatever the range."""
    spark = df.sparkSession
    before = day_files(spark, path, day_from, day_to)
    inside = (F.col(DAY) >= F.lit(day_from)) & (F.col(DAY) < F.lit(day_to))
    replace_days(df.where(inside), path, (DAY,), sort_by)
    after = day_files(spark, path, day_from, day_to)
    empty = spark.createDataFrame([], df.drop(DAY).schema)
    for folder, files in before.items():
        if files & after.get(folder, set()):
            empty.write.mode("overwrite").parquet(f"{path}/{folder}")


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """K1 over JDBC; columns are matched by name."""
    df.write.mode("append").jdbc(url, table, properties=properties)


def jdbc_replace_day(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    day_from,
    day_to,
    date: str = "date",
) -> None:
    """K2 over JDBC for databases without partitions: delete the half-open day
    range, then append.

    The DELETE is issued as the ``sessionInitStatement`` of a one-row read
    (``SELECT COUNT(*)`` of the table), so it runs once, in the database, from
    one connection; the append then writes in parallel.  Running it twice
    gives the same table as running it once.
    """
    delete = f"DELETE FROM {table} WHERE {date} >= {{ts '{day_from} 00:00:00'}} AND {date} < {{ts '{day_to} 00:00:00'}}"
    (
        df.sparkSession.read.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("query", f"SELECT COUNT(*) AS N FROM {table}")
        .option("sessionInitStatement", delete)
        .load()
        .collect()
    )
    jdbc_append(df, url, table, properties)
