"""Spark session settings for the reports.

On a cluster, pass the cluster's own master and sizes; the settings below
only switch on what the reports rely on: adaptive execution (runtime
broadcast decisions from measured shuffle sizes, partition coalescing,
skew-join splitting), UTC session time and no web UI.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# On a cluster, coalesce shuffle partitions to a target size instead of to the
# number of cores (AQE's default favours parallelism, which on large inputs
# leaves many tiny tasks or, with too few initial partitions, huge ones).
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
}

TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Shuffle partitions that keep each near ``target_bytes`` for a shuffle of
    ``shuffle_bytes`` -- e.g. the projected size of the largest shuffle.  Use it
    for ``spark.sql.shuffle.partitions``; AQE then merges partitions that turn
    out smaller."""
    return max(1, -(-int(shuffle_bytes) // int(target_bytes)))


def build_session(
    master: str | None = None,
    app_name: str = "socialpages",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create the session with the settings the reports rely on.

    ``shuffle_partitions`` sets ``spark.sql.shuffle.partitions`` (size it with
    ``partitions_for``).  On a non-local master the ``CLUSTER_CONF`` defaults
    are applied unless ``conf`` or the submitted Spark configuration sets them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        submitted = sc.getConf()
        for key, value in CLUSTER_CONF.items():
            if key not in settings and not submitted.contains(key):
                spark.conf.set(key, value)
    return spark
