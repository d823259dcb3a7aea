"""Reliable checkpoints in the cluster's shared checkpoint folder.

A report is a short plan (at most three shuffles) and Spark recomputes a
lost executor's work from the parquet inputs.  A frame that is reused by
several reports -- e.g. the friends relation, which costs a large join --
can be materialized once with ``materialize``: a reliable checkpoint
written to ``spark.checkpoint.dir``, the shared folder the cluster
names.  Local checkpoints (executor-local storage) are never used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one the context already uses, else the
    session's ``spark.checkpoint.dir``.

    Only when neither is set *and* Spark runs in local mode (tests, a single
    machine) is a scratch folder chosen; on a cluster an unset folder is an
    error, because executor-local paths do not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="socialpages-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def materialize(df: DataFrame) -> DataFrame:
    """Eagerly write ``df`` to the shared checkpoint folder and return a frame
    that reads it back, with the lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Paths handed out by this process that have not been removed, by application.
_OPEN: dict[str, set[str]] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared checkpoint folder, for a table or files of this
    application.  ``discard`` or ``discard_leftovers`` removes what is written there."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _OPEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def staged(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as a table in the shared folder and read back, and the
    table's path, for ``discard`` when nothing reads it any more.  For loops and
    for intermediate tables of a known life: unlike a checkpoint, a table has
    its own size statistics, where those of checkpoints multiply from join to
    join, and it goes when its user says so."""
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    _OPEN.get(spark.sparkContext.applicationId, set()).discard(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard_leftovers(spark: SparkSession) -> int:
    """Remove every table and file that this process staged for the application and that
    is still there, and return how many.  Call it when the results have been written:
    lazy results read their staged tables until then."""
    paths = list(_OPEN.get(spark.sparkContext.applicationId, ()))
    for path in paths:
        discard(spark, path)
    return len(paths)
