"""Incremental loading on Structured Streaming.

Files are discovered by the file source and remembered in the checkpoint. What has been
loaded is told by the commits of the target (``atlasweave.sources.committed``): a file
that is committed is skipped, whatever the checkpoint knows, and a batch that broke
before its commit is loaded again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from atlasweave.sources import committed
from atlasweave.sources.committed import MANIFEST, pending  # noqa: F401
from atlasweave.sources.upsert_log import reduced_batch


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder, old and new, with their path."""
    reader = (
        spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def mark_done(loaded: DataFrame, level: int) -> DataFrame:
    """Manifest rows of the files of a loaded batch."""
    return loaded.groupBy(F.col("file_path").alias("path")).agg(
        F.lit(level).alias("admin_level"), F.count(F.lit(1)).alias("loaded_rows")
    )


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Copy all available input to a Parquet folder, exactly once."""
    run_to_end(
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(target)
    )


def load_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    reduce: Callable[[DataFrame], DataFrame],
    level: int = 0,
    before_commit: Callable[[DataFrame], None] | None = None,
) -> None:
    """Load all available files as committed parts of ``target``, each file once.

    Files that the manifest has at ``level`` or a higher one are left out. What
    ``reduce`` makes of the others is written first and committed with their manifest
    rows second; ``before_commit`` may look at the written part in between, and a part
    it rejects by raising stays invisible. A micro-batch is read once: it is kept while
    its files are counted and its rows are written.
    """

    def load(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            files = mark_done(batch, level)
            todo = pending(files, committed.manifest(spark, target), level).persist()
            if not todo.isEmpty():
                fresh = batch.join(F.broadcast(todo.select(F.col("path").alias("file_path"))), "file_path", "left_semi")
                number = committed.last_batch(spark, target) + 1
                part = committed.write_part(reduce(fresh.select(*batch.columns)), target, number)
                if before_commit is not None:
                    before_commit(spark.read.parquet(f"{target}/data/batch={number}/part={part}"))
                committed.commit(todo, target, number, part)
            todo.unpersist()
        finally:
            batch.unpersist()

    run_to_end(
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def upsert_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df.drop("file_path"),
    replaced: Sequence[str] | None = None,
    level: int = 0,
    before_commit: Callable[[DataFrame], None] | None = None,
) -> None:
    """Log every micro-batch of an upsert with the manifest rows of its files.

    ``replaced`` columns (all but the keys by default) take the value of a key's last
    row. ``upsert_log.current`` reads the table.
    """

    def reduce(batch: DataFrame) -> DataFrame:
        rows = prepare(batch)
        columns = list(replaced) if replaced is not None else [c for c in rows.columns if c not in keys]
        return reduced_batch(rows, keys, columns, order)

    load_stream(stream, target, checkpoint, reduce, level, before_commit)


def _daily_values() -> list[Column]:
    return [
        F.sum("value").alias("sum"), F.avg("value").alias("mean"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.count(F.lit(1)).alias("n_values"),
    ]


def load_daily(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Load cells (time, value, file_path and keys) as one partial aggregate per file, day and key.

    Partial aggregates merge, so a file that comes late costs its own days and nothing
    that was loaded before is read again. ``daily_table`` merges them.
    """

    def reduce(batch: DataFrame) -> DataFrame:
        return batch.groupBy("file_path", *keys, F.to_date("time").alias("date")).agg(
            F.sum("value").alias("sum"), F.count("value").alias("n_present"), F.min("value").alias("min"),
            F.max("value").alias("max"), F.count(F.lit(1)).alias("n_values"),
        )

    load_stream(stream, target, checkpoint, reduce)


def daily_table(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Daily values of all committed files."""
    parts = committed.committed_rows(spark, target)
    return parts.groupBy(*keys, "date").agg(
        F.sum("sum").alias("sum"), (F.sum("sum") / F.nullif(F.sum("n_present"), F.lit(0))).alias("mean"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("n_values").alias("n_values"),
    )


def daily_stream(stream: DataFrame, keys: Sequence[str], lateness: str = "1 day") -> DataFrame:
    """Daily aggregates of arriving cells; a day is emitted when the watermark passes it."""
    return (
        stream.withWatermark("time", lateness)
        .groupBy(F.window("time", "1 day").alias("w"), *keys)
        .agg(*_daily_values())
        .select(*keys, F.to_date("w.start").alias("date"), "sum", "mean", "min", "max", "n_values")
    )


def completed_days(source: DataFrame, emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The daily table as of now: emitted days, and a batch pass over the others.

    A stream drops rows that come later than the watermark, and days the watermark
    has not passed are not out yet. Both show as a row count that differs from the
    source's; such days are aggregated again from the source and replace the
    emitted ones.
    """
    on = [*keys, "date"]
    dated = source.withColumn("date", F.to_date("time"))
    counts = dated.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    redo = (
        counts.join(emitted.select(*on, "n_values"), on, "left")
        .where(F.col("n_values").isNull() | (F.col("n_values") != F.col("_n")))
        .select(*on)
    )
    again = dated.join(redo, on, "left_semi").groupBy(*on).agg(*_daily_values())
    return emitted.join(redo, on, "left_anti").select(*again.columns).unionByName(again)
