"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. All are runtime settings, so they also apply to
# a session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when the split costs one more exchange below
    # a following aggregation on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF`, touching only settings that differ."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "atlasweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only on one machine (a local master) that names none, a temporary folder is made
    and remembered in the session; executors elsewhere could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.atlasweave.scratch", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="atlasweave-")
        spark.conf.set("spark.atlasweave.scratch", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing is ever overwritten."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below :func:`scratch_root` and read back, with its schema.

    For a table that several branches of a plan use: they read a narrow table of known
    size instead of computing it again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def appended(df: DataFrame, path: str) -> None:
    """``df`` added to the rows in ``path``; what was shuffled for it is let go of once it is written.

    For jobs in waves, whose shuffle files would else lie side by side.
    """
    spark = df.sparkSession
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)


def at_most(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has no more than ``max_rows`` rows; counting stops one beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` only after counting that it is small enough.

    Beyond the limit the plan is left alone and the join shuffles both sides.
    Meant for lookup sides (gazetteer, coverage) that meet a far larger table,
    where shuffling the large side is what has to be avoided.
    """
    return F.broadcast(df) if at_most(df, max_rows) else df
