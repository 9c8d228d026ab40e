"""Session set-up, materialised intermediates and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# A lookup with at most this many rows may be broadcast (checked by counting it).
BROADCAST_ROWS = 500_000
# A group with more rows than this is never handed to one task as a whole.
GROUP_ROWS = 2_000_000


def build_session(app: str = "vanecast", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, ANSI arithmetic and adaptive execution switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    """Integer setting of the session, or the default when it is unset."""
    return int(spark.conf.get(key, str(default)))


def group_rows(spark: SparkSession) -> int:
    return conf_int(spark, "spark.vanecast.groupRows", GROUP_ROWS)


def broadcast_rows(spark: SparkSession) -> int:
    return conf_int(spark, "spark.vanecast.broadcastRows", BROADCAST_ROWS)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its machine, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="vanecast-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return os.path.join(scratch_root(spark), app, f"{label}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Fixes values that depend on the physical layout and cuts the lineage; the
    files outlive any executor, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> tuple[DataFrame, int]:
    """Keep an aggregate for reuse and count its rows (evicted blocks are recomputed)."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
