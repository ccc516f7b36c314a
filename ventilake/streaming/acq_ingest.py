"""Incremental ingest of .acq files with Structured Streaming.

A file stream picks up every new .acq file of a kind (the stream's checkpoint
records which files were processed); each micro-batch goes through the same
ingest as the daily chain.  The table is partitioned by file day and file, so
a file that comes late or again replaces its own rows and no others, and a
replayed micro-batch rewrites the same partitions with the same rows.

Seeded streams keep their state beside the table, not in it: ``fichiers`` has one
or two rows per file with its last good values and the seeds it took, ``etat``
the merged state of all sensors as of a day.  A micro-batch reads the newest
merged state up to its first day and the files since, never readings.  Where a
late file gives later files of its sensor other seeds, those files are filled
again (column ``a_semer`` marks the rows without a value of their own), so the
table is the one of a run in order, however the files arrive.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed as X
from ..functions import naming as nm
from ..operators import repair as rp
from ..plans import ingest
from ..plans.daily import last_good_schema
from ..sinks import tables as sink
from ..sinks.stores import FolderStore
from ..sources import acq
from ..sources.tables import read_table

#: bit i: the row has no own value of the i-th measure, but a seed (or nothing)
UNSOURCED = "a_semer"


def acq_stream(
    spark: SparkSession,
    landing: str,
    kind: str,
    boxes: Sequence[str] = X.HOUSEHOLD_BOXES,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of the lines of new .acq files of ``kind``."""
    reader = (
        spark.readStream.schema(acq.SCHEMAS[kind])
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.acq")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.csv(landing)
    df = df.withColumn("file_name", nm.decode_file_name(df["_metadata.file_name"]))
    return df.where(acq.kind_filter(kind, "file_name", boxes)).select("file_name", "Date", *acq.MEASURES[kind])


def stream_schema(kind: str) -> str:
    """Schema of the stream's table, with its partition columns."""
    return acq.brut_schema(kind) + ", file_name STRING"


def _seed_names(measures: Sequence[str]) -> list[str]:
    return ["__seed_" + c for c in measures]


def _unsourced(measures: Sequence[str]) -> Column:
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(measures)]
    return sum(bits[1:], bits[0]).cast("int")


def _seeded(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The rows with their seeds in place of what they have no own value of."""
    fill = {
        c: F.when(F.col(UNSOURCED).bitwiseAND(F.lit(1 << i)) != 0, F.col("__seed_" + c)).otherwise(F.col(c))
        for i, c in enumerate(measures)
    }
    return rows.withColumns(fill).drop(*_seed_names(measures))


def _files_schema(measures: Sequence[str]) -> str:
    """``fichiers``: last good values of a file, which measures lack a source in it, and the seeds it took."""
    seeds = ", ".join(f"{n} DOUBLE" for n in _seed_names(measures))
    return f"{last_good_schema(measures).removesuffix('day DATE')}unsourced INT, {seeds}, day DATE, file_name STRING"


def _write_seeded(brut: DataFrame, table_path: str, state_path: str, measures: Sequence[str]) -> None:
    """One micro-batch with seeds: its files, and the later files whose seeds it changes."""
    spark, store = brut.sparkSession, FolderStore(state_path)
    by_file, keys, seed_names = (sink.DAY, "file_name"), ["capteur", "day", "file_name"], _seed_names(measures)
    brut = brut.withColumn(UNSOURCED, _unsourced(measures)).checkpoint(eager=True)
    first = brut.agg(F.min("day")).first()[0]
    if first is None:
        sink.replace_days(brut, table_path, partition_by=by_file)
        return
    # the newest merged state up to the first day, and the files since then but for those that come again
    known = max((d for d in store.days(spark, "etat") if d <= first), default=None)
    stored = store.read(spark, "fichiers", _files_schema(measures), known)
    stored = stored.join(brut.select("file_name").distinct(), "file_name", "left_anti").checkpoint(eager=True)
    own = rp.last_good(brut, measures, keys=("file_name",))
    columns = [c for c in own.columns if c != "file_name"]
    merged = store.read(spark, "etat", last_good_schema(measures), known, known and known + dt.timedelta(days=1))
    merged = merged.where(F.lit(known is not None)).select(*columns).checkpoint(eager=True)
    facts = stored.where("usable is not null").select(*columns).unionByName(own.select(*columns)).checkpoint(eager=True)

    # who asks for seeds: the files of the batch, and later ones of its sensors that took some
    asking = brut.groupBy(*keys).agg(F.bit_or(UNSOURCED).alias("unsourced")).withColumn("again", F.lit(False))
    since = brut.groupBy("capteur").agg(F.min("day").alias("since"))
    later = stored.where("unsourced != 0").join(since, "capteur").where("day > since")
    taken = [F.col(n).alias("old" + n) for n in seed_names]
    later = later.select(*keys, "unsourced", F.lit(True).alias("again"), *taken).distinct()
    asked = asking.unionByName(later, allowMissingColumns=True)
    seeds = rp.seeds_by_day(merged.unionByName(facts), asked.select("capteur", "day"), measures)
    asked = asked.join(seeds, ["capteur", "day"], "left")
    changed = F.lit(False)
    for i, n in enumerate(seed_names):
        lacking = F.col("unsourced").bitwiseAND(F.lit(1 << i)) != 0
        changed = changed | (lacking & ~F.col(n).eqNullSafe(F.col("old" + n)))
    asked = asked.where(~F.col("again") | changed).drop(*["old" + n for n in seed_names]).checkpoint(eager=True)

    again = asked.where("again").select(*by_file).distinct()
    rows = brut
    if not again.isEmpty():
        before = read_table(spark, table_path, brut.schema).join(again, list(by_file), "left_semi")
        rows = brut.unionByName(before.checkpoint(eager=True))
    rows = rows.join(asked.select(*keys, *seed_names), keys, "left")
    sink.replace_days(_seeded(rows, measures).select(*brut.columns), table_path, partition_by=by_file)

    good = stored.where("usable is not null").join(again, list(by_file), "left_semi")
    good = good.select(*own.columns).unionByName(own)
    files = asked.where("day is not null").drop("again").join(good, keys, "left")
    sink.replace_days(files.checkpoint(eager=True), store.path("fichiers"), partition_by=by_file)
    # the merged state as of the first day; those of later days were made without these files
    merged = rp.compact_state(merged.unionByName(facts.where(F.col("day") < F.lit(first))), measures, first)
    store.replace(merged.checkpoint(eager=True), "etat", first, dt.date.max, ("capteur",))


def start_ingest(
    spark: SparkSession,
    landing: str,
    kind: str,
    table_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    seeded: bool = False,
    state_path: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    ``checkpoint`` defaults to a folder below the shared ``spark.checkpoint.dir``.
    ``seeded``: leading errors of the files take the last good value of earlier
    days (T3), as the daily job does; the state lies in ``state_path``, by
    default ``<table_path>_etat``.
    """
    measures = acq.MEASURES[kind]
    checkpoint = checkpoint or sink.shared_dir(spark, "streams", f"acq_{kind}")
    state_path = state_path or table_path.rstrip("/") + "_etat"

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        brut = ingest.file_days(batch, measures)
        if seeded:
            _write_seeded(brut, table_path, state_path, measures)
        else:
            sink.replace_days(brut, table_path, partition_by=(sink.DAY, "file_name"))

    writer = acq_stream(spark, landing, kind).writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
