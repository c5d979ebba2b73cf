"""Sinks: partitioned observation tables, CSV, monthly pieces, bucketed grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.operators.keys import insert_ignore


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_view(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Materialise a serving view."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite the partitions that ``df`` has rows of; all others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_monthly(df: DataFrame, date: str, path: str) -> None:
    """One folder per year and month.

    ``rebalance`` clusters rows by month so that a month is a few files, and
    lets adaptive execution cut a heavy month into several tasks.
    """
    (
        df.withColumns({"year": F.year(date), "month": F.month(date)})
        .hint("rebalance", "year", "month")
        .write.mode("errorifexists")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_observations(df: DataFrame, path: str) -> None:
    """The observation table: a folder per dataset and level, sorted by unit and date."""
    (
        df.repartitionByRange("dataset", "admin_level", "gid", "date")
        .sortWithinPartitions("dataset", "admin_level", "gid", "date")
        .write.mode("errorifexists")
        .partitionBy("dataset", "admin_level")
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """A table bucketed and sorted by its join key.

    Cells and coverage written this way (same keys, same bucket count) join and
    pre-aggregate without moving the cells.
    """
    writer = df.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def load_insert_ignore(
    spark: SparkSession, target: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Append the rows whose key is not in the table yet."""
    new = insert_ignore(spark.read.parquet(target), incoming, keys, order)
    new.write.mode("append").parquet(target)
