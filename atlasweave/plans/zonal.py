"""Gridded data -> observations, for all levels and variables in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.operators.grids import Grid, coverage, zonal_statistics
from atlasweave.session import scratch_root, stored
from atlasweave.sources import committed


def coverage_key(grid: Grid) -> Column:
    """Digest of a unit's rings and of the grid: what its coverage depends on."""
    shape = f"{grid.lon0!r} {grid.lat0!r} {grid.dlon!r} {grid.dlat!r} {grid.ncols} {grid.nrows} "
    return F.sha2(F.concat(F.lit(shape), F.to_json("rings")), 256)


def stored_coverage(spark: SparkSession, units: DataFrame, grid: Grid, path: str | None = None) -> DataFrame:
    """Coverage of ``units`` from a store that computes each outline on each grid once.

    The store holds cells by :func:`coverage_key`; only units whose key it does not have
    are computed, in a part that is committed with the number of cells of every
    unit, none included. Every dataset, date, level and later run on the same grid reads
    it. Without ``path`` it is the session's, in the shared scratch folder.
    """
    path = path or f"{scratch_root(spark)}/coverage-store"
    keyed = stored(units.select("gid", "admin_level", "rings", coverage_key(grid).alias("key")), "keyed-units")
    known = committed.manifest(spark, path).select("path")
    todo = stored(
        keyed.groupBy("key").agg(F.first("rings").alias("rings")).join(known, F.col("key") == F.col("path"), "left_anti"), "new-outlines")
    if not todo.isEmpty():
        batch = committed.last_batch(spark, path) + 1
        cells = coverage(todo.select(F.col("key").alias("gid"), F.lit(0).alias("admin_level"), "rings"), grid)
        part = committed.write_part(cells.select(F.col("gid").alias("key"), "lat_idx", "lon_idx", "fraction", "cell_area"), path, batch)
        counts = spark.read.parquet(f"{path}/data/batch={batch}/part={part}").groupBy(F.col("key").alias("path")).agg(
            F.count(F.lit(1)).alias("cells"))
        done = todo.select(F.col("key").alias("path")).join(counts, "path", "left").select(
            "path", F.lit(0).alias("admin_level"), F.coalesce("cells", F.lit(0)).alias("loaded_rows"))
        committed.commit(done, path, batch, part)
    # two sessions may have computed an outline at the same time: one of its parts is read
    owner = committed.commits(spark, path).groupBy(F.col("path").alias("_key")).agg(F.min(F.struct("batch", "part")).alias("of")).select(
        "_key", F.col("of.batch").alias("_batch"), F.col("of.part").alias("_part"))
    mine = keyed.select("gid", "admin_level", "key").join(owner, F.col("key") == F.col("_key")).drop("key")
    cells = spark.read.parquet(f"{path}/data").withColumn("batch", F.col("batch").cast("long"))
    return cells.join(
        mine, (F.col("key") == F.col("_key")) & (F.col("batch") == F.col("_batch")) & (F.col("part") == F.col("_part"))
    ).select(F.lit(grid.grid_id).alias("grid_id"), "gid", "admin_level", "lat_idx", "lon_idx", "fraction", "cell_area")


def touched(cov: DataFrame) -> DataFrame:
    """Coverage rows weighing the whole cell area."""
    return cov.withColumn("weight", F.col("cell_area"))


def weighted(cov: DataFrame) -> DataFrame:
    """Coverage rows weighing the covered part of the cell area."""
    return cov.withColumn("weight", F.col("cell_area") * F.col("fraction"))


def grid_observations(cells: DataFrame, cov: DataFrame, dataset: str, source: str, missing: str = "box", units: DataFrame | None = None) -> DataFrame:
    """Canonical observation rows of a gridded dataset, levels side by side."""
    z = zonal_statistics(cells, cov, missing, units=units)
    return z.select(
        F.lit(dataset).alias("dataset"), "gid", "admin_level", "date", "variable", "sum", "mean", "min", "max",
        F.lit(None).cast("double").alias("raw_value"), "missing_value_percentage", F.lit(None).cast("string").alias("note"),
        F.lit(source).alias("source"), "unit", F.lit(None).cast("string").alias("metadata"),
    )


# --- fixed values: note, source and unit of land-class rows ---------------------
CLASS_NOTE = "sum is the count of the class, raw_value is the percentage of the class in that area"
CLASS_SOURCE = "Copernicus_CDS_LandClass"
CLASS_UNIT = "land class count or percentage per area"


def class_observations(histogram: DataFrame, packed: DataFrame, dataset: str = "land_class") -> DataFrame:
    """Class histogram and packed JSON -> observation rows: count in ``sum``, share in ``raw_value``."""
    none = F.lit(None).cast("double")
    return histogram.join(packed, ["gid", "admin_level", "date"]).select(
        F.lit(dataset).alias("dataset"), "gid", "admin_level", "date", "variable",
        F.col("n_cells").cast("double").alias("sum"), none.alias("mean"), none.alias("min"), none.alias("max"),
        F.col("percentage").alias("raw_value"), "missing_value_percentage",
        F.lit(CLASS_NOTE).alias("note"), F.lit(CLASS_SOURCE).alias("source"), F.lit(CLASS_UNIT).alias("unit"), "metadata",
    )
