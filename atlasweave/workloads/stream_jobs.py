"""Incremental loading (R rows of the inventory)."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from atlasweave.session import scratch_path
from atlasweave.sources import committed, upsert_log
from atlasweave.streaming import incremental as inc
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import with_


def _event_files(spark, d):
    schema = t.table(spark, d, "events").schema
    return inc.stream_files(spark, d, schema, pattern="events.parquet")


@query("r1_stream_files", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY ALL")
def r1(spark, d):
    target = scratch_path(spark, "stream")
    inc.append_stream(_event_files(spark, d), target, scratch_path(spark, "stream-state"))
    return spark.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


def _yearly_files(spark, d) -> str:
    """Orders as files, one per year."""
    path = scratch_path(spark, "yearly")
    orders = t.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("year"))
    orders.withColumn("folder", F.col("year")).repartition("folder").write.partitionBy("folder").parquet(path)
    return path


def _file_year():
    return F.regexp_extract("path", r"folder=(\d+)", 1).cast("int").alias("year")


def _load(spark, folder: str, target: str, pattern: str = "*.parquet", level: int = 0, state: str | None = None, check=None) -> None:
    schema = spark.read.parquet(folder).drop("folder").schema
    stream = inc.stream_files(spark, folder, schema, pattern=pattern, files_per_batch=2)
    inc.upsert_stream(stream, target, state or scratch_path(spark, "load-state"), ["o_custkey", "o_orderstatus", "year"], ["o_orderkey"],
                      level=level, before_commit=check)


@query("r2_skip_processed", "SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) % 2 = 0")
def r2(spark, d):
    """Files that a load at level 1 still has to read after one of odd years at level 1 and of all years at level 0."""
    source, target = _yearly_files(spark, d), scratch_path(spark, "loaded")
    files = spark.read.parquet(source).select(F.col("_metadata.file_path").alias("path")).distinct()
    rows = spark.read.parquet(source).select("*", F.col("_metadata.file_path").alias("file_path"))
    for level, part in ((0, rows), (1, rows.where("year % 2 = 1"))):
        number = committed.last_batch(spark, target) + 1
        name = committed.write_part(part.drop("file_path", "folder"), target, number)
        committed.commit(inc.mark_done(part, level), target, number, name)
    return inc.pending(files, committed.manifest(spark, target), 1).select(_file_year())


def _resumed_load(spark, d) -> str:
    """A table whose load broke between its two steps, was resumed, and was run again without its checkpoint."""
    source, target, state = _yearly_files(spark, d), scratch_path(spark, "loaded"), scratch_path(spark, "load-state")

    def broken(part):
        raise RuntimeError("broken between data and commit")

    try:
        _load(spark, source, target, state=state, check=broken)
    except StreamingQueryException:
        pass  # the part is written, its commit is not
    _load(spark, source, target, state=state)
    _load(spark, source, target)  # a new checkpoint knows nothing, the manifest does
    return target


@query("r3_load_manifest", """
SELECT year(o_orderdate)::INT AS year, 0 AS admin_level, count(*) AS loaded_rows, 1 AS times FROM orders GROUP BY ALL""")
def r3(spark, d):
    """What the manifest says was loaded: every file once."""
    return committed.manifest(spark, _resumed_load(spark, d)).select(_file_year(), "admin_level", "loaded_rows").groupBy("year", "admin_level").agg(
        F.max("loaded_rows").alias("loaded_rows"), F.count(F.lit(1)).cast("int").alias("times"))


@query("r3_loaded_rows", """
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey, year(o_orderdate)::INT AS year FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, year(o_orderdate) ORDER BY o_orderkey DESC) = 1""")
def r3_rows(spark, d):
    """The rows behind that manifest, a row per key and file: those of the broken part are not seen."""
    rows = committed.committed_rows(spark, _resumed_load(spark, d))
    return rows.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey", "year")


@query("r4_stream_upsert", """
SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY ALL""")
def r4(spark, d):
    target = scratch_path(spark, "upsert")
    key, order = ["user_id", "event_type"], ["event_id"]
    inc.upsert_stream(
        _event_files(spark, d), target, scratch_path(spark, "upsert-state"), key, order,
        prepare=lambda df: df.select(*key, "value", *order))
    return upsert_log.current(spark, target, key).select(*key, "value", *order)


@query("r5_stream_daily", with_("cells") + """
SELECT variable, time::DATE AS date, count(*) AS n_values, round(sum(value), 6) AS sum, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max FROM hourly GROUP BY ALL""")
def r5(spark, d):
    """Daily values from partial aggregates per file."""
    stream = _event_files(spark, d).selectExpr(
        "file_path", "CAST(ts AS TIMESTAMP) AS time", f"{t.climate_variable('event_type')} AS variable",
        "CASE WHEN event_id % 11 <> 0 THEN value END AS value")
    target = scratch_path(spark, "daily-stream")
    inc.load_daily(stream, target, scratch_path(spark, "daily-state"), ["variable"])
    return inc.daily_table(spark, target, ["variable"]).select(
        "variable", "date", "n_values", *[F.round(c, 6).alias(c) for c in ("sum", "mean", "min", "max")])
