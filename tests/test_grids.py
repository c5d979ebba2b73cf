from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from atlasweave.functions.geo import RINGS_TYPE
from atlasweave.operators import grids
from atlasweave.plans import zonal
from atlasweave.sources import sinks

UNITS = f"gid string, admin_level int, rings {RINGS_TYPE}"
G = grids.Grid("g", lon0=-2.0, lat0=-1.0, dlon=0.5, dlat=0.25, ncols=12, nrows=16)


def _closed(points):
    return [*points, points[0]]


def clip(points, keep, cross):
    out = []
    for a, b in zip(points, points[1:] + points[:1]):
        if keep(a):
            out.append(a)
        if keep(a) != keep(b):
            out.append(cross(a, b))
    return out


def clipped_area(points, x0, y0, x1, y1):
    """Area of a simple polygon inside a box (polygon clipping, shoelace)."""
    at_x = lambda x: lambda a, b: (x, a[1] + (b[1] - a[1]) * (x - a[0]) / (b[0] - a[0]))
    at_y = lambda y: lambda a, b: (a[0] + (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]), y)
    for keep, cross in [(lambda p: p[0] >= x0, at_x(x0)), (lambda p: p[0] <= x1, at_x(x1)), (lambda p: p[1] >= y0, at_y(y0)), (lambda p: p[1] <= y1, at_y(y1))]:
        points = clip(points, keep, cross)
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


def star(rng, cx, cy, r):
    """A simple, usually concave polygon around a centre, in either direction."""
    n = rng.randrange(3, 11)
    polar = [((i + rng.uniform(-0.15, 0.15)) * 2 * math.pi / n, rng.uniform(0.2, 1) * r) for i in range(n)]
    pts = [(cx + d * math.cos(t), cy + d * math.sin(t)) for t, d in polar]
    return pts if rng.random() < 0.5 else pts[::-1]


def test_fractions_match_polygon_clipping(spark):
    rng = random.Random(11)
    # small, large, concave, beyond every side of the grid, around the whole grid
    shapes = {f"u{i}": star(rng, rng.uniform(-3, 5), rng.uniform(-2, 4), rng.choice([0.2, 1, 3, 8])) for i in range(40)}
    shapes["around"] = [(-50.0, -50.0), (50.0, -50.0), (50.0, 50.0), (-50.0, 50.0)]
    shapes["aligned"] = [(-1.0, -0.5), (1.0, -0.5), (1.0, 0.5), (-1.0, 0.5)]
    units = spark.createDataFrame([(k, 1, [(False, _closed(p))]) for k, p in shapes.items()], UNITS)
    got = {(r["gid"], r["lon_idx"], r["lat_idx"]): r["fraction"] for r in grids.coverage(units, G).collect()}
    want = {}
    for k, p in shapes.items():
        for c in range(G.ncols):
            for r in range(G.nrows):
                x0, y0 = G.lon0 + c * G.dlon, G.lat0 + r * G.dlat
                f = clipped_area(list(p), x0, y0, x0 + G.dlon, y0 + G.dlat) / (G.dlon * G.dlat)
                if f > 1e-9:
                    want[(k, c, r)] = f
    assert {k for k, v in got.items() if v > 1e-7} == {k for k, v in want.items() if v > 1e-7}
    assert all(got[k] == pytest.approx(v, abs=1e-7) for k, v in want.items() if v > 1e-7)
    assert sum(1 for k in got if k[0] == "around") == G.ncols * G.nrows
    assert {v for k, v in got.items() if k[0] == "aligned"} == {1.0}


def test_holes_and_parts_add_up(spark):
    outer, hole = [(-1.9, -0.9), (3.9, -0.9), (3.9, 2.9), (-1.9, 2.9)], [(0.0, 0.0), (1.3, 0.1), (1.1, 1.7)]
    whole = [(False, _closed(outer))]
    donut = [(False, _closed(outer)), (True, _closed(hole))]
    parts = [(False, _closed(hole)), (False, _closed([(2.0, 2.0), (3.0, 2.0), (3.0, 2.6)]))]
    units = spark.createDataFrame([("whole", 1, whole), ("donut", 1, donut), ("plug", 1, [(False, _closed(hole[::-1]))]), ("parts", 1, parts)], UNITS)
    total = {r["gid"]: r["s"] for r in grids.coverage(units, G).groupBy("gid").agg(F.sum("fraction").alias("s")).collect()}
    cell = G.dlon * G.dlat
    assert total["donut"] + total["plug"] == pytest.approx(total["whole"], abs=1e-9)
    assert total["whole"] * cell == pytest.approx(5.8 * 3.8, abs=1e-9)
    assert total["parts"] * cell == pytest.approx(total["plug"] * cell + 0.3, abs=1e-9)


def test_a_partition_of_the_plane_covers_every_cell_once(spark):
    rng = random.Random(2)
    # triangulated grid with shaken inner corners
    xs, ys = [-3.0, -0.7, 1.1, 2.6, 5.0], [-2.0, 0.3, 1.4, 4.0]
    at = {(i, j): (x + (rng.uniform(-0.3, 0.3) if 0 < i < 4 else 0), y + (rng.uniform(-0.3, 0.3) if 0 < j < 3 else 0)) for i, x in enumerate(xs) for j, y in enumerate(ys)}
    data = []
    for i in range(4):
        for j in range(3):
            a, b, c, d = at[i, j], at[i + 1, j], at[i + 1, j + 1], at[i, j + 1]
            data += [(f"{i}{j}a", 1, [(False, _closed([a, b, c]))]), (f"{i}{j}b", 1, [(False, _closed([a, d, c]))])]
    cells = grids.coverage(spark.createDataFrame(data, UNITS), G).groupBy("lat_idx", "lon_idx").agg(F.sum("fraction").alias("s")).collect()
    assert len(cells) == G.ncols * G.nrows
    assert all(c["s"] == pytest.approx(1.0, abs=1e-8) for c in cells)


def _cells(spark, values):
    return spark.createDataFrame(
        [("g", r, c, d, "t", v, "K") for (r, c, d), v in values.items()], "grid_id string, lat_idx int, lon_idx int, date string, variable string, value double, unit string"
    ).withColumn("date", F.col("date").cast("date"))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_zonal_statistics(spark, limit):
    box = lambda x0, y0, x1, y1: [(False, _closed([(x0, y0), (x1, y0), (x1, y1), (x0, y1)]))]
    units = spark.createDataFrame([("in", 1, box(0.0, 0.0, 1.0, 0.5)), ("half", 1, box(0.0, 0.0, 0.25, 0.25)), ("empty", 1, box(3.0, 2.0, 3.5, 2.25))], UNITS)
    # "in" covers rows 4, 5 and columns 4, 5
    values = {(4, 4, "2020-01-01"): 10.0, (4, 5, "2020-01-01"): None, (5, 4, "2020-01-01"): 20.0, (5, 5, "2020-01-01"): 30.0, (4, 4, "2020-01-02"): None}
    cov = grids.weighted_cells(units, G)
    got = {(r["gid"], str(r["date"])): r for r in grids.zonal_statistics(_cells(spark, values), cov, broadcast_cells=limit).collect()}
    w4, w5 = math.cos(math.radians(G.lat0 + 4.5 * G.dlat)), math.cos(math.radians(G.lat0 + 5.5 * G.dlat))
    assert len(got) == 6
    first = got["in", "2020-01-01"]
    assert first["mean"] == pytest.approx((10 * w4 + 50 * w5) / (w4 + 2 * w5))
    assert (first["sum"], first["min"], first["max"], first["missing_value_percentage"]) == (60.0, 10.0, 30.0, 25.0)
    assert got["half", "2020-01-01"]["mean"] == 10.0
    for key in [("in", "2020-01-02"), ("empty", "2020-01-01"), ("empty", "2020-01-02")]:
        assert (got[key]["mean"], got[key]["sum"], got[key]["missing_value_percentage"]) == (None, None, 100.0)


def test_units_of_no_size_and_outside_the_grid(spark):
    box = lambda x, y, s: [(False, _closed([(x, y), (x + s, y), (x + s, y + s), (x, y + s)]))]
    units = spark.createDataFrame([("tiny", 1, box(0.1, 0.1, 2e-6)), ("across", 1, box(0.5 - 1e-6, 0.25 - 1e-6, 2e-6)), ("outside", 1, box(50.0, 50.0, 1.0))], UNITS)
    cov = grids.coverage(units, G)
    got = {(r["gid"], r["lon_idx"], r["lat_idx"]): r["fraction"] * G.dlon * G.dlat for r in cov.collect()}
    assert set(got) == {("tiny", 4, 4), *[("across", c, r) for c in (4, 5) for r in (4, 5)]}
    assert got["tiny", 4, 4] == pytest.approx(4e-12, rel=1e-6)
    assert all(got["across", c, r] == pytest.approx(1e-12, rel=1e-6) for c in (4, 5) for r in (4, 5))
    cells = _cells(spark, {(4, 4, "2020-01-01"): 3.0, (4, 4, "2020-01-02"): 5.0})
    rows = {(r["gid"], str(r["date"])): r for r in grids.zonal_statistics(cells, grids.weighted_cells(units, G), units=units).collect()}
    assert len(rows) == 6 and rows["tiny", "2020-01-02"]["mean"] == 5.0
    assert [(rows["outside", d]["mean"], rows["outside", d]["missing_value_percentage"]) for d in ("2020-01-01", "2020-01-02")] == [(None, 100.0)] * 2


def test_mean_of_a_constant_grid_is_the_constant(spark):
    rng = random.Random(4)
    units = spark.createDataFrame([(f"u{i}", 1, [(False, _closed(star(rng, 1, 1, 2)))]) for i in range(5)], UNITS)
    values = {(r, c, "2020-01-01"): 7.5 for r in range(G.nrows) for c in range(G.ncols)}
    for cov in (grids.weighted_cells(units, G), grids.touched_cells(units, G)):
        stats = grids.zonal_statistics(_cells(spark, values), cov, missing="covered").collect()
        assert len(stats) == 5 and all(s["mean"] == pytest.approx(7.5) and s["missing_value_percentage"] == 0.0 for s in stats)


def test_legacy_null_weight_biases_low(spark):
    units = spark.createDataFrame([("in", 1, [(False, _closed([(0.0, 0.0), (1.0, 0.0), (1.0, 0.25), (0.0, 0.25)]))])], UNITS)
    cells = _cells(spark, {(4, 4, "2020-01-01"): 10.0, (4, 5, "2020-01-01"): None})
    cov = grids.weighted_cells(units, G)
    assert grids.zonal_statistics(cells, cov).first()["mean"] == pytest.approx(10.0)
    assert grids.zonal_statistics(cells, cov, legacy_null_weight=True).first()["mean"] == pytest.approx(5.0)


def test_class_histogram_and_rows(spark):
    units = spark.createDataFrame([("in", 1, [(False, _closed([(0.0, 0.0), (1.0, 0.0), (1.0, 0.5), (0.0, 0.5)]))]), ("none", 1, [(False, _closed([(3.0, 2.0), (3.5, 2.0), (3.5, 2.25)]))])], UNITS)
    cells = _cells(spark, {(4, 4, "2020-01-01"): 10.0, (4, 5, "2020-01-01"): None, (5, 4, "2020-01-01"): 10.0, (5, 5, "2020-01-01"): 99.0})
    flags = spark.createDataFrame([(10, "cropland")], "value int, meaning string")
    h = grids.class_histogram(cells, grids.touched_cells(units, G), flags)
    got = {r["variable"]: (r["n_cells"], round(r["percentage"], 3), r["missing_value_percentage"]) for r in h.collect()}
    assert got == {"10_cropland": (2, 66.667, 25.0), "99_Unknown": (1, 33.333, 25.0)}
    obs = zonal.class_observations(h, grids.class_json(h)).orderBy(F.desc("sum")).collect()
    assert [(o["variable"], o["sum"]) for o in obs] == [("10_cropland", 2.0), ("99_Unknown", 1.0)]
    assert obs[0]["metadata"].startswith('[{"class":"10_cropland","count":2')


@pytest.mark.parametrize("limit", [500_000, 1, 0])
def test_readings_of_a_cell_are_added_up_before_they_meet_units(spark, monkeypatch, limit):
    """However many readings a cell has on a date, each unit that covers it meets one row of a unit of measure or class."""
    box = [(False, _closed([(0.0, 0.0), (0.5, 0.0), (0.5, 0.25), (0.0, 0.25)]))]
    units = spark.createDataFrame([(f"u{k}", 2, box) for k in range(20)], UNITS)
    cov, met = grids.touched_cells(units, G), []
    cells = spark.range(900).select(
        F.lit("g").alias("grid_id"), F.lit(4).alias("lat_idx"), F.lit(4).alias("lon_idx"), F.lit("2020-01-01").cast("date").alias("date"), F.lit("t").alias("variable"),
        F.expr("CASE WHEN id % 3 <> 0 THEN CAST(id % 2 AS DOUBLE) END").alias("value"), F.expr("CASE WHEN id % 5 = 0 THEN 'K' END").alias("unit"))
    joined = grids._in_units
    monkeypatch.setattr(grids, "_in_units", lambda *args: met.append(joined(*args)) or met[-1])
    for row in grids.zonal_statistics(cells, cov, broadcast_cells=limit).collect():
        assert (row["sum"], row["mean"], row["min"], row["max"], row["missing_value_percentage"], row["unit"]) == (300.0, pytest.approx(0.5), 0.0, 1.0, -59900.0, "K")
    shown = grids.class_histogram(cells, cov, spark.createDataFrame([(0, "none")], "value int, meaning string"), broadcast_cells=limit).collect()
    assert {(r["variable"], r["n_cells"]) for r in shown} == {("0_none", 300), ("1_Unknown", 300)} and len(shown) == 40
    assert [m.count() for m in met] == [40, 40]


def test_bucketed_tables_join_without_moving_cells(spark, tmp_path):
    cells = spark.range(2000).select(F.lit("g").alias("grid_id"), (F.col("id") % 16).cast("int").alias("lat_idx"), (F.col("id") % 12).cast("int").alias("lon_idx"), F.col("id").cast("double").alias("value"))
    cov = cells.select("grid_id", "lat_idx", "lon_idx").distinct().withColumn("weight", F.lit(1.0))
    keys = ["grid_id", "lat_idx", "lon_idx"]
    sinks.write_bucketed(cells, "bucketed_cells", keys, 4, str(tmp_path / "cells"))
    sinks.write_bucketed(cov, "bucketed_cov", keys, 4, str(tmp_path / "cov"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("bucketed_cells").join(spark.table("bucketed_cov"), keys)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE bucketed_cells")
        spark.sql("DROP TABLE bucketed_cov")
