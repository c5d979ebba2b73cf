"""Upserts as a log that is merged when it is read.

Plain files have no in-place merge. Each batch is reduced to one row per key and
appended with the names of the columns it replaces, so a load costs what it holds, not
what the table holds. A reader takes each column of a key from the last batch that
lists the column, and from the batch that created the key where none does: the rows
that :func:`atlasweave.operators.keys.upsert` gives when the batches are loaded one
after another. Compaction merges the last base with the batches since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.sources import committed

_LISTED = "_listed"


def reduced_batch(df: DataFrame, keys: Sequence[str], replaced: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: replaced columns of its last row, the others of its first."""
    by = F.struct(*[F.col(c) for c in order])
    others = [c for c in df.columns if c not in {*keys, *replaced}]
    picks = [F.max_by(F.struct(*replaced), by).alias("_new")]
    if others:
        picks.append(F.min_by(F.struct(*others), by).alias("_first"))
    return df.groupBy(*keys).agg(*picks).select(
        *keys, *[F.col("_new")[c].alias(c) for c in replaced], *[F.col("_first")[c].alias(c) for c in others]
    ).select(*df.columns, F.array(*[F.lit(c) for c in replaced]).alias(_LISTED))


def append(
    df: DataFrame, target: str, keys: Sequence[str], replaced: Sequence[str], order: Sequence[str], files: DataFrame | None = None
) -> int:
    """Log ``df`` as the next batch and commit it. -> its number

    ``order`` fixes the load order inside the batch. ``files`` are the manifest rows
    of what was loaded. All batches of a log have the same columns.
    """
    spark = df.sparkSession
    batch = committed.last_batch(spark, target) + 1
    part = committed.write_part(reduced_batch(df, keys, replaced, order), target, batch)
    if files is None:
        files = spark.createDataFrame([(f"batch {batch}", 0, None)], committed.MANIFEST)
    committed.commit(files, target, batch, part)
    return batch


def current(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The table as of the last committed batch: one aggregation over base and later batches."""
    rows = committed.committed_rows(spark, target)
    # a base comes before any batch and replaces nothing: it only creates
    rows = rows.withColumn("_at", F.when(F.col("kind") == committed.BASE, F.lit(-1).cast("long")).otherwise(F.col("batch")))
    columns = [c for c in rows.columns if c not in {*keys, _LISTED, "_at", "batch", "part", "kind"}]

    def merged(c: str) -> Column:
        listing = F.when(F.array_contains(_LISTED, c), F.col("_at"))
        return F.struct(F.max(listing).alias("last"), F.max_by(F.struct(c), listing).alias("new"), F.min_by(F.struct(c), "_at").alias("created"))

    return rows.groupBy(*keys).agg(*[merged(c).alias(c) for c in columns]).select(
        *keys, *[F.when(F.col(c)["last"].isNotNull(), F.col(c)["new"][c]).otherwise(F.col(c)["created"][c]).alias(c) for c in columns]
    )


def compact(spark: SparkSession, target: str, keys: Sequence[str]) -> None:
    """Merge the last base and the batches after it into a new base. Older parts are no longer read."""
    batch = committed.last_batch(spark, target)
    table = current(spark, target, keys).withColumn(_LISTED, F.array().cast("array<string>"))
    part = committed.write_part(table, target, batch)
    none = spark.createDataFrame([(None, None, None)], "path string, admin_level int, loaded_rows long")
    committed.commit(none, target, batch, part, committed.BASE)
