"""Grids: coverage, zonal statistics, classes, resampling (J20-J22, Z, A17, A18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.operators import grids, resample
from atlasweave.plans import views, zonal
from atlasweave.plans.materialised import PARTITIONS, load_observations, refresh_view
from atlasweave.session import scratch_path
from atlasweave.session import stored as keep
from atlasweave.sources import sinks
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import with_


@query("j20_cells_any_touch", with_("coverage") + "SELECT gid, admin_level, lat_idx, lon_idx, round(cell_area, 2) AS weight FROM coverage")
def j20(spark, d):
    return grids.touched_cells(t.shaped_units(spark, d), t.GRID).select(
        "gid", "admin_level", "lat_idx", "lon_idx", F.round("weight", 2).alias("weight"))


@query("j21_cells_fraction", with_("coverage") + "SELECT gid, admin_level, lat_idx, lon_idx, round(fraction, 6) AS fraction FROM coverage")
def j21(spark, d):
    return grids.coverage(t.shaped_units(spark, d), t.GRID).select(
        "gid", "admin_level", "lat_idx", "lon_idx", F.round("fraction", 6).alias("fraction"))


def _zonal_sql(cells: str, weight: str, total: str) -> str:
    return f"""
, dates AS (SELECT date, variable, max(unit) AS unit FROM {cells} GROUP BY ALL),
ext AS (SELECT s.gid, s.admin_level, nullif(count(lat_idx), 0) AS covered, (max(lat_idx) - min(lat_idx) + 1) * (max(lon_idx) - min(lon_idx) + 1) AS box
  FROM shapes s LEFT JOIN coverage c ON s.gid = c.gid AND s.admin_level = c.admin_level GROUP BY s.gid, s.admin_level),
stats AS (SELECT gid, admin_level, date, variable, sum(value * {weight}) / nullif(sum(CASE WHEN value IS NOT NULL THEN {weight} END), 0) AS mean,
  sum(value) AS s, min(value) AS lo, max(value) AS hi, count(value) AS valid FROM {cells} JOIN coverage USING (lat_idx, lon_idx) GROUP BY ALL),
zonal AS (SELECT e.gid, e.admin_level, d.date, d.variable, d.unit, s AS "sum", mean, lo AS "min", hi AS "max",
  coalesce(round(100.0::DOUBLE * ({total} - coalesce(valid, 0)) / {total}, 2), 100.0) AS missing_value_percentage
  FROM ext e CROSS JOIN dates d LEFT JOIN stats s ON s.gid = e.gid AND s.date = d.date AND s.variable = d.variable)"""


def stored(spark, d):
    return zonal.stored_coverage(spark, t.shaped_units(spark, d), t.GRID)


@query("z3_zonal_mean", with_("coverage", "cells") + _zonal_sql("daily", "cell_area", "box") + """
SELECT gid, admin_level, date, variable, unit, round(mean, 6) AS mean, round("min", 6) AS min, round("max", 6) AS max FROM zonal""")
def z3(spark, d):
    cov = zonal.touched(stored(spark, d))
    z = grids.zonal_statistics(t.daily_cells(spark, d), cov, units=t.shaped_units(spark, d))
    return z.select("gid", "admin_level", "date", "variable", "unit", *[F.round(c, 6).alias(c) for c in ("mean", "min", "max")])


@query("z3_zonal_mean_fractional", with_("coverage", "cells") + _zonal_sql("daily", "cell_area * fraction", "covered") + """
SELECT gid, admin_level, date, variable, round(mean, 6) AS mean, missing_value_percentage FROM zonal""")
def z3_fraction(spark, d):
    cov = zonal.weighted(stored(spark, d))
    z = grids.zonal_statistics(t.daily_cells(spark, d), cov, missing="covered", units=t.shaped_units(spark, d))
    return z.select("gid", "admin_level", "date", "variable", F.round("mean", 6).alias("mean"), "missing_value_percentage")


@query("z4_zonal_sum_min_max", with_("coverage", "cells") + _zonal_sql("daily", "cell_area", "box") + """
SELECT gid, date, variable, round("sum", 4) AS sum, round("min", 4) AS min, round("max", 4) AS max FROM zonal""")
def z4(spark, d):
    cov = zonal.touched(stored(spark, d))
    z = grids.zonal_statistics(t.daily_cells(spark, d), cov, units=t.shaped_units(spark, d))
    return z.select("gid", "date", "variable", *[F.round(c, 4).alias(c) for c in ("sum", "min", "max")])


@query("z5_missing_pct", with_("coverage", "cells") + _zonal_sql("daily", "cell_area", "box") + """
SELECT gid, date, variable, missing_value_percentage, mean IS NULL AS empty FROM zonal""")
def z5(spark, d):
    cov = zonal.touched(stored(spark, d))
    z = grids.zonal_statistics(t.daily_cells(spark, d), cov, units=t.shaped_units(spark, d))
    return z.select("gid", "date", "variable", "missing_value_percentage", F.col("mean").isNull().alias("empty"))


@query("z9_cells_to_view", with_("coverage", "cells") + _zonal_sql("daily", "cell_area", "box") + """
SELECT gid, admin_level, date, CASE WHEN variable = 'DUSMASS25' THEN variable ELSE 'Label of ' || variable END AS variable,
  round(mean, 6) AS selected_value, round("sum", 4) AS "sum", missing_value_percentage, coalesce(unit, 'N/A') AS unit FROM zonal""")
def z9(spark, d):
    """The load path as one job: cells to statistics to the observation table to a refreshed view, in two overlapping loads."""
    table, view = scratch_path(spark, "observations"), scratch_path(spark, "long-view")
    shapes, catalog, units = t.shaped_units(spark, d), t.catalog(spark, d), keep(t.units(spark, d), "units")
    cov, cells = zonal.touched(stored(spark, d)), keep(t.daily_cells(spark, d), "daily-cells")
    observed = lambda part: zonal.grid_observations(part, cov, "climate", "reanalysis", units=shapes)
    build = lambda obs: views.long_view(obs, catalog, units, keep=("dataset",))
    sinks.write_observations(observed(cells.where("dayofmonth(date) <= 15")), table)
    sinks.write_view(build(spark.read.parquet(table)), view, PARTITIONS)
    batch = observed(cells.where("dayofmonth(date) > 10")).withColumn("seq", F.lit(1))
    refresh_view(spark, view, table, build, load_observations(spark, table, batch, ["seq"]))
    return spark.read.parquet(view).select(
        "gid", "admin_level", "date", "variable", F.round("selected_value", 6).alias("selected_value"), F.round("sum", 4).alias("sum"),
        "missing_value_percentage", "unit")


@query("z6_class_histogram", with_("classes") + """
, ext AS (SELECT gid, (max(lat_idx) - min(lat_idx) + 1) * (max(lon_idx) - min(lon_idx) + 1) AS box FROM coverage GROUP BY gid)
SELECT h.gid, date, variable, n_cells, round(percentage, 4) AS percentage,
  round(100.0::DOUBLE * (box - sum(n_cells) OVER (PARTITION BY h.gid, date)) / box, 4) AS missing_value_percentage FROM histogram h JOIN ext e ON h.gid = e.gid""")
def z6(spark, d):
    cov = zonal.touched(stored(spark, d))
    h = grids.class_histogram(t.class_cells(spark, d), cov, t.class_flags(spark, d))
    return h.select(
        "gid", "date", "variable", "n_cells", *[F.round(c, 4).alias(c) for c in ("percentage", "missing_value_percentage")])


@query("z7_class_json", with_("classes") + """
SELECT gid, date, count(*) AS n_classes, string_agg(variable || ':' || n_cells, ',' ORDER BY n_cells DESC, variable) AS classes FROM histogram GROUP BY ALL""")
def z7(spark, d):
    cov = zonal.touched(stored(spark, d))
    packed = grids.class_json(grids.class_histogram(t.class_cells(spark, d), cov, t.class_flags(spark, d)))
    back = F.from_json("metadata", "array<struct<class:string,count:bigint,percentage:double>>")
    return packed.select("gid", "date", back.alias("m")).select(
        "gid", "date", F.size("m").cast("bigint").alias("n_classes"),
        F.array_join(F.transform("m", lambda c: F.concat(c["class"], F.lit(":"), c["count"].cast("string"))), ",").alias("classes"))


@query("z8_band_zonal", with_("coverage", "bands") + _zonal_sql("band_cells", "cell_area", "covered") + """
SELECT gid, date, round(mean, 6) AS mean, round("min", 6) AS min, round("max", 6) AS max FROM zonal""")
def z8(spark, d):
    cov = zonal.touched(stored(spark, d))
    z = grids.zonal_statistics(grids.band_index_cells(t.bands(spark, d), "NDVI"), cov, missing="covered", units=t.shaped_units(spark, d))
    return z.select("gid", "date", *[F.round(c, 6).alias(c) for c in ("mean", "min", "max")])


_SPINE = with_("cells") + """
, spine AS (SELECT lat_idx, lon_idx, variable, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM daily GROUP BY ALL),
full_daily AS (SELECT lat_idx, lon_idx, variable, date, value FROM spine LEFT JOIN daily USING (lat_idx, lon_idx, variable, date))"""


@query("a17_daily_resample", _SPINE.replace("FROM daily GROUP BY ALL),", "FROM daily GROUP BY lat_idx, lon_idx, variable),") + """
SELECT lat_idx, lon_idx, variable, date, round(value, 6) AS value FROM full_daily""")
def a17(spark, d):
    return resample.daily(t.hourly_cells(spark, d)).select("lat_idx", "lon_idx", "variable", "date", F.round("value", 6).alias("value"))


@query("a18_monthly_daily", with_("cells") + """
SELECT year(date)::INT AS year, month(date)::INT AS month, variable, count(*) AS n_days, round(sum(value), 4) AS total FROM daily GROUP BY ALL""")
def a18(spark, d):
    cells = t.hourly_cells(spark, d)
    early, late = cells.where("dayofmonth(time) <= 15"), cells.where("dayofmonth(time) > 15")
    path = scratch_path(spark, "daily")
    sinks.write_monthly(resample.daily(early.unionByName(late), fill_gaps=False), "date", path)
    return spark.read.parquet(path).groupBy("year", "month", "variable").agg(
        F.count(F.lit(1)).alias("n_days"), F.round(F.sum("value"), 4).alias("total"))
