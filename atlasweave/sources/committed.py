"""Tables that are loaded in parts, each visible once it is committed.

A load first writes its rows to a folder of its own, then one row per loaded file to
the table of commits. Readers join the parts with the commits, so rows of a load that
broke between the steps are never seen, and a load may be repeated. The commits are
at the same time the manifest of what has been loaded.

    target/data/batch=3/part=p0a1b/...      rows of a part
    target/commits/batch=3/part=p0a1b/...   kind, path, admin_level, loaded_rows

A part of kind ``load`` holds the rows of one batch; one of kind ``base`` stands for all
batches up to its own.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD, BASE = "load", "base"
MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("admin_level", T.IntegerType()),
        T.StructField("loaded_rows", T.LongType(), True),
    ]
)
COMMITS = T.StructType(
    [T.StructField("kind", T.StringType()), *MANIFEST.fields, T.StructField("batch", T.LongType()), T.StructField("part", T.StringType())]
)


def _folder(batch: int, part: str) -> str:
    return f"batch={batch}/part={part}"


def write_part(df: DataFrame, target: str, batch: int) -> str:
    """First step: the rows of a batch, in a new folder. -> the part's name"""
    part = f"p{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{target}/data/{_folder(batch, part)}")
    return part


def commit(files: DataFrame, target: str, batch: int, part: str, kind: str = LOAD) -> None:
    """Second step: ``files`` (path, admin_level, loaded_rows) of the part, as one file that is there or is not.

    The rows are one per loaded file, a batch's files at most.
    """
    files.select(F.lit(kind).alias("kind"), "path", "admin_level", "loaded_rows").coalesce(1).write.parquet(
        f"{target}/commits/{_folder(batch, part)}"
    )


def commits(spark: SparkSession, target: str) -> DataFrame:
    """All commit rows: kind, path, admin_level, loaded_rows, batch, part; none before the first load."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{target}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """(path, admin_level, loaded_rows) of every file that was loaded."""
    return commits(spark, target).where((F.col("kind") == LOAD) & F.col("path").isNotNull()).select(*MANIFEST.names)


def pending(files: DataFrame, done: DataFrame, level: int) -> DataFrame:
    """Files not yet loaded at this level or a higher one."""
    loaded = done.where(F.col("admin_level") >= level).select("path").distinct()
    return files.join(loaded, "path", "left_anti")


def last_batch(spark: SparkSession, target: str, kind: str = LOAD) -> int:
    """Number of the newest committed batch of a kind; -1 before the first."""
    return commits(spark, target).where(F.col("kind") == kind).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]


def committed_rows(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the newest base and of the batches after it, with ``kind``, ``batch`` and ``part``.

    Of several committed parts of a batch one is read. Commits are a row per batch and
    file since the last base; as they choose folders, other parts are not opened.
    """
    base = last_batch(spark, target, BASE)
    live = (
        commits(spark, target)
        .where(((F.col("kind") == BASE) & (F.col("batch") == base)) | ((F.col("kind") == LOAD) & (F.col("batch") > base)))
        .groupBy("batch", "kind")
        .agg(F.min("part").alias("part"))
    )
    data = spark.read.parquet(f"{target}/data").withColumn("batch", F.col("batch").cast("long"))
    return data.join(F.broadcast(live), ["batch", "part"])
