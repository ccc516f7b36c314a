"""Spark session settings used by the jobs, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key's join-back is split even where that costs another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # checkpoint folders go when the frames that read them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # broadcast only sides measured/estimated below this size; larger ones shuffle
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]", app: str = "ventilake", shuffle_partitions: int = 8, **conf
) -> SparkSession:
    """Session with the defaults above; ``conf`` overrides them (e.g. ``**sizing(...)``).

    ``master=None`` leaves the master to the launcher (spark-submit on a cluster)."""
    b = SparkSession.builder.appName(app)
    if master is not None:
        b = b.master(master)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition settings for a cluster run, from the input size and the cores.

    * shuffle partitions: enough for ~``target_partition_bytes`` per reducer
      (and at least 3 waves of tasks over all cores); AQE then coalesces
      small ones, so over-provisioning is cheap and spills are avoided;
    * scan splits of the same size (``maxPartitionBytes``);
    * AQE skew handling: a partition 5x the median and above 4x the target is
      split.

    Example, 100 TB on 1,000 executors x 8 cores:
    ``build_session("yarn", **sizing(100 * 2**40, 8000))`` gives 409,600
    shuffle partitions of ~256 MB each.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
