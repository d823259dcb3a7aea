"""The friends relation as tables bucketed for the reports that read it.

Three reports group or join the edges, each by other columns: connectedness by
the friend, popular users by the owner, unvisited friends by both.  Written
once in that layout, every later run of such a report scans its edges already
partitioned: no shuffle of the edges, however often the report runs.  A layout
pays once its report runs more than once on the same edges; write only
those that do.

Buckets keep equal keys together, so a key with a third of all edges makes one
bucket a third of the table.  The pair layout spreads a hot owner over its
friends; for the others the reports' first step is a partial aggregate, which
turns a bucket into a row for each key while it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.functions.text import trimmed, with_min_fields
from socialpages.plans.lineage import scratch_path
from socialpages.schemas import FRIENDS_COLUMNS, N_FIELDS

# The columns that each layout is bucketed by.
LAYOUTS = {"friend": ["my_friend"], "owner": ["person_id"], "pair": ["person_id", "my_friend"]}
# Layouts whose report trims the ids: the trimmed ids are stored, and are the keys.
TRIMMED = ("friend", "owner")


def _table(name: str, layout: str) -> str:
    return f"{name}_by_{layout}"


def share_friends(friends: DataFrame, name: str, layouts: list[str], buckets: int, folder: str | None = None) -> None:
    """Write ``friends`` as the tables of the given layouts, under ``folder`` (a folder of
    the shared checkpoint folder by default).  An existing table is refused.

    Edges that are too short for every report (no third field) are not stored.
    ``buckets`` should make a bucket fit one task, e.g. ``session.partitions_for`` of
    the size of the edges, and be no less than ``spark.sql.shuffle.partitions``:
    beside a finer partitioning Spark shuffles the coarser one again.
    """
    spark = friends.sparkSession
    folder = folder or scratch_path(spark, name)
    full = with_min_fields(friends, 2, FRIENDS_COLUMNS)
    for layout in layouts:
        columns = [(trimmed(full, c) if layout in TRIMMED else F.col(c)).alias(c) for c in ("person_id", "my_friend")]
        # the arity guard has been applied: every stored row passes it
        edges = full.select(*columns, F.lit(len(FRIENDS_COLUMNS)).alias(N_FIELDS)).repartition(buckets, *LAYOUTS[layout])
        writer = edges.write.bucketBy(buckets, *LAYOUTS[layout]).option("path", f"{folder}/{layout}")
        writer.format("parquet").saveAsTable(_table(name, layout))


def shared_friends(spark: SparkSession, name: str, layout: str) -> DataFrame:
    """The edges in one layout, as the reports take them."""
    return spark.table(_table(name, layout))


def drop_shared(spark: SparkSession, name: str) -> None:
    """Forget the tables of ``name``; their files stay until the folder is removed."""
    for layout in LAYOUTS:
        spark.sql(f"DROP TABLE IF EXISTS {_table(name, layout)}")
