"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the characters of ``[\x20\x09-\x0D]``
ASCII_SPACE = " \t\n\x0b\x0c\r"


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, null texts empty: extra columns and their names play no part."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """128 bits that name a row's id and text, never null: the same for repeated rows, others for another text or id."""
    rank = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(k), rank.isNull(), F.coalesce(rank, F.lit(0)), text) for k in (1, 2)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return (F.crc32(id_column.cast("string").cast("binary")) % parts).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(folder)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


#: shuffles of a finished action go at once (a running cluster would keep them until the driver's next collection)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from it from then on.

    The shuffles that made it are removed as soon as it is written: nothing reads
    them again, and a chain of steps holds the files of one step at a time."""
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        # a query takes this setting when it is made
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame) -> str:
    """The folder below the shared one in which ``df`` is now a Parquet table, whose size Spark knows; its shuffles go as in ``checkpointed``."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.select("*").write.parquet(folder)
    finally:
        spark.conf.set(_CLEANUP, before)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Remove what is below a folder of the shared one that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(*frames: DataFrame) -> None:
    """Remove what ``checkpointed`` wrote for frames that nothing reads any more, as Spark's cleaner would some time later."""
    for df in frames:
        spark = df.sparkSession
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            remove(spark, file.get())
