"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from atlasweave.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _letting_go(spark: SparkSession):
    """What is written here lets go of the files of the shuffles before it."""
    was = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, was)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    What follows neither recomputes it nor loses it with an executor, and the
    optimizer knows its size. Files of the shuffles before it go once it is written.
    """
    path = scratch_path(df.sparkSession, label)
    with _letting_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(df: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """``df`` put to the rows of a table, or of the files in ``path``; the files of its shuffles go."""
    with _letting_go(df.sparkSession):
        if path is None:
            df.write.insertInto(table)
        else:
            df.write.mode("append").parquet(path)
