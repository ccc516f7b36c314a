"""Where the daily chain keeps its tables: plain day folders, or versioned days behind a manifest.

Both stores read and replace ranges of days of named tables; a table that is not
there yet reads as empty.

``FolderStore`` keeps ``<root>/<table>/day=...`` (``sinks.tables``): simple, and
any reader can open it, but a replacement that stops half-way leaves some days
new and some old.

``ManifestStore`` writes the new rows of a range to a folder of their own,
``<root>/<table>/version=<v>/day=...``, and then switches: a manifest, a small
file that names the current version of every range of days, is written beside
and renamed to the next number.  Readers take the newest manifest, so they see
all days of a replacement or none; what a killed job wrote is named nowhere.  A
range of any length costs one write and one rename, days without rows cost
nothing, and a read opens the versions of its days only.  ``vacuum`` removes what
no manifest names any more.  One writer per table at a time: a second one finds
its number taken, reads the manifest again and puts its range on top.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import tables
from .tables import DAY

_FIRST, _LAST = dt.date.min, dt.date.max


class FolderStore:
    """Tables as day folders, replaced by dynamic partition overwrite."""

    def __init__(self, root: str):
        self.root = root

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def read(self, spark: SparkSession, table: str, schema: str, day_from: dt.date | None = None, day_to: dt.date | None = None) -> DataFrame:
        """Rows of the days ``[day_from, day_to)`` (either may be left out)."""
        try:
            out = read_table(spark, self.path(table), schema)
        except AnalysisException:  # no such table yet (path not found)
            return spark.createDataFrame([], schema)
        if day_from is not None:
            out = out.where(F.col(DAY) >= F.lit(day_from))
        return out if day_to is None else out.where(F.col(DAY) < F.lit(day_to))

    def replace(self, df: DataFrame, table: str, day_from: dt.date, day_to: dt.date, sort_by: Sequence[str] = ()) -> None:
        """Replace all days of ``[day_from, day_to)`` by the rows of ``df`` (column ``day``)."""
        tables.replace_range(df, self.path(table), day_from, day_to, sort_by)

    def replace_some(self, df: DataFrame, table: str, days: Sequence[dt.date], sort_by: Sequence[str] = ()) -> None:
        """Replace ``days``, which need not follow each other, by one write; each of them must have rows."""
        tables.replace_days(df.where(F.col(DAY).isin(list(days))), self.path(table), (DAY,), sort_by)

    def stamps(self, spark: SparkSession, table: str, day_from: dt.date, day_to: dt.date) -> dict[dt.date, str]:
        """A text per stored day of the range that changes whenever the day is replaced (from its file names)."""
        files = tables.day_files(spark, self.path(table), day_from, day_to)
        names = {folder: "\n".join(sorted(os.path.basename(f) for f in held)) for folder, held in files.items()}
        return {dt.date.fromisoformat(k.split("=", 1)[1]): hashlib.sha256(v.encode()).hexdigest() for k, v in names.items()}

    def days(self, spark: SparkSession, table: str) -> list[dt.date]:
        """The stored days, from the folder names."""
        return sorted(tables.day_folders(spark, self.path(table)))


class Entry(NamedTuple):
    """The days ``[day_from, day_to)`` are those of ``version``."""

    day_from: dt.date
    day_to: dt.date
    version: str


def put(entries: Sequence[Entry], new: Entry) -> list[Entry]:
    """The entries with ``new`` on top, in order of days and without overlaps."""
    out = [new]
    for e in entries:
        if e.day_from < new.day_from:
            out.append(e._replace(day_to=min(e.day_to, new.day_from)))
        if e.day_to > new.day_to:
            out.append(e._replace(day_from=max(e.day_from, new.day_to)))
    return sorted(out)


class ManifestStore:
    """Tables as versioned days behind a manifest."""

    def __init__(self, root: str):
        self.root = root

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def _manifests(self, spark: SparkSession, table: str) -> tuple[object, object, list[int]]:
        """File system, manifest folder and the numbers that are there."""
        folder = tables.hadoop_path(spark, os.path.join(self.path(table), "_manifest"))
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return fs, folder, sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, spark: SparkSession, table: str) -> tuple[int, list[Entry]]:
        """Number and entries of the newest manifest (0 and none before the first)."""
        _, folder, numbers = self._manifests(spark, table)
        if not numbers:
            return 0, []
        text = spark.sparkContext.wholeTextFiles(f"{folder.toString()}/{numbers[-1]:012d}.json", 1).values().first()
        day = dt.date.fromisoformat
        return numbers[-1], [Entry(day(e["from"]), day(e["to"]), e["version"]) for e in json.loads(text)]

    def publish(self, spark: SparkSession, table: str, *new: Entry, attempts: int = 20) -> int:
        """Switch the days of each entry to its version, by one rename; the number of the new manifest."""
        for _ in range(attempts):
            number, entries = self.manifest(spark, table)
            body = [{"from": str(e.day_from), "to": str(e.day_to), "version": e.version} for e in reduce(put, new, entries)]
            fs, folder, _ = self._manifests(spark, table)
            beside = tables.hadoop_path(spark, f"{folder.toString()}/_{uuid.uuid4().hex}")
            stream = fs.create(beside, False)
            stream.write(bytearray(json.dumps(body).encode()))
            stream.close()
            target = tables.hadoop_path(spark, f"{folder.toString()}/{number + 1:012d}.json")
            if not fs.exists(target) and fs.rename(beside, target):
                return number + 1
            fs.delete(beside, False)
        raise RuntimeError(f"{table}: other writers took every manifest number")

    def replace(self, df: DataFrame, table: str, day_from: dt.date, day_to: dt.date, sort_by: Sequence[str] = ()) -> None:
        """Replace all days of ``[day_from, day_to)`` by the rows of ``df`` (column ``day``), all at once."""
        version = self._write(df.where((F.col(DAY) >= F.lit(day_from)) & (F.col(DAY) < F.lit(day_to))), table, sort_by)
        self.publish(df.sparkSession, table, Entry(day_from, day_to, version))

    def replace_some(self, df: DataFrame, table: str, days: Sequence[dt.date], sort_by: Sequence[str] = ()) -> None:
        """Replace ``days``, which need not follow each other, by one write and one switch."""
        version = self._write(df.where(F.col(DAY).isin(list(days))), table, sort_by)
        self.publish(df.sparkSession, table, *[Entry(d, d + dt.timedelta(days=1), version) for d in days])

    def _write(self, df: DataFrame, table: str, sort_by: Sequence[str]) -> str:
        version = f"v{uuid.uuid4().hex}"
        out = tables.rebalanced(df, (DAY,))
        if sort_by:
            out = out.sortWithinPartitions(DAY, *sort_by)
        out.write.partitionBy(DAY).parquet(f"{self.path(table)}/version={version}")
        return version

    def stamps(self, spark: SparkSession, table: str, day_from: dt.date, day_to: dt.date) -> dict[dt.date, str]:
        """A text per stored day of the range that changes whenever the day is replaced: its version."""
        return {d: v for d, v in self._versions(spark, table) if day_from <= d < day_to}

    def read(self, spark: SparkSession, table: str, schema: str, day_from: dt.date | None = None, day_to: dt.date | None = None) -> DataFrame:
        """Rows of the days ``[day_from, day_to)`` in their current versions (either may be left out)."""
        lo, hi = day_from or _FIRST, day_to or _LAST
        current = [
            e._replace(day_from=max(e.day_from, lo), day_to=min(e.day_to, hi))
            for e in self.manifest(spark, table)[1]
            if e.day_from < hi and e.day_to > lo
        ]
        if not current:
            return spark.createDataFrame([], schema)
        folders = sorted({f"{self.path(table)}/version={e.version}" for e in current})
        rows = spark.read.schema(f"{schema}, version STRING").option("basePath", self.path(table)).parquet(*folders)
        here = [
            (F.col("version") == e.version) & (F.col(DAY) >= F.lit(e.day_from)) & (F.col(DAY) < F.lit(e.day_to)) for e in current
        ]
        # the outer bounds once more, plainly, for the partition filters of the scan
        span = (F.col(DAY) >= F.lit(current[0].day_from)) & (F.col(DAY) < F.lit(current[-1].day_to))
        return rows.where(span & reduce(lambda a, b: a | b, here)).drop("version")

    def days(self, spark: SparkSession, table: str) -> list[dt.date]:
        """The stored days: those of the current versions that have rows."""
        return sorted(d for d, _ in self._versions(spark, table))

    def _versions(self, spark: SparkSession, table: str) -> list[tuple[dt.date, str]]:
        """The days that have rows, each with its current version: one listing per version."""
        entries = self.manifest(spark, table)[1]
        held = {v: tables.day_folders(spark, f"{self.path(table)}/version={v}") for v in {e.version for e in entries}}
        return [(d, e.version) for e in entries for d in held[e.version] if e.day_from <= d < e.day_to]

    def vacuum(self, spark: SparkSession, table: str) -> list[str]:
        """Remove older manifests and the versions that the newest one does not name; the versions removed.

        Not while readers of an older manifest or a writer are at work."""
        number, entries = self.manifest(spark, table)
        fs, folder, numbers = self._manifests(spark, table)
        for n in numbers:
            if n < number:
                fs.delete(tables.hadoop_path(spark, f"{folder.toString()}/{n:012d}.json"), False)
        named = {f"version={e.version}" for e in entries}
        gone = []
        for s in fs.listStatus(tables.hadoop_path(spark, self.path(table))):
            name = s.getPath().getName()
            if name.startswith("version=") and name not in named:
                fs.delete(s.getPath(), True)
                gone.append(name.split("=", 1)[1])
        return gone


def as_store(store) -> FolderStore | ManifestStore:
    """A store; a text is the root of a ``FolderStore``."""
    return FolderStore(store) if isinstance(store, str) else store
