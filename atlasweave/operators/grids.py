"""Grids and polygons: cell coverage, zonal statistics, class histograms.

Cells are rows ``(grid_id, time, lat_idx, lon_idx, lat, lon, variable, value,
unit)``. How much of each cell a unit covers is computed once per grid as a
table (:func:`coverage`) and joined to the cells on the cell index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.functions.geo import bounding_box, cell_area, geometry_problem, ring_area2
from atlasweave.functions.numbers import normalized_difference
from atlasweave.session import at_most, sized_broadcast, stored

# Outlines are taken to this fine a part of a column or row (10 nm of a cell of a quarter
# degree), which is what rounding of coordinates leaves. Widths counted in such parts are
# integers: they cancel to exactly zero below an outline, so no share decides what is inside.
_TICKS = float(1 << 40)
# An area is nothing when it is this small against the sum of the areas it was
# subtracted from. Relative, so a tiny unit keeps its cell.
_ROUNDING = 1e-12


@dataclass(frozen=True)
class Grid:
    """A regular lon/lat grid; index 0 is the lowest longitude and latitude."""

    grid_id: str
    lon0: float
    lat0: float
    dlon: float
    dlat: float
    ncols: int
    nrows: int

    def lat_centre(self, lat_idx: Column) -> Column:
        return F.lit(self.lat0) + (lat_idx + 0.5) * self.dlat

    def lon_centre(self, lon_idx: Column) -> Column:
        return F.lit(self.lon0) + (lon_idx + 0.5) * self.dlon


def usable_units(units: DataFrame) -> DataFrame:
    """Units whose geometry passes the sanity checks."""
    return units.where(geometry_problem(F.col("rings")).isNull())


def rejected_units(units: DataFrame) -> DataFrame:
    """(gid, problem) of the units that do not."""
    return units.select("gid", geometry_problem(F.col("rings")).alias("problem")).where(
        F.col("problem").isNotNull()
    )


def edges(units: DataFrame) -> DataFrame:
    """Directed edges of all rings with a sign that makes outer area positive.

    Rings may come in either direction: the ring's signed area decides, and
    holes count against. Vertical edges cover nothing and are left out.
    """
    ring = units.select("gid", "admin_level", F.explode("rings").alias("r"))
    pts = F.col("r.points")
    n = F.size(pts)
    return (
        ring.select(
            "gid", "admin_level",
            (F.when(F.col("r.hole"), 1.0).otherwise(-1.0) * F.signum(ring_area2(pts))).alias("side"),
            F.explode(
                F.arrays_zip(
                    F.slice(pts, F.lit(1), n - 1).alias("a"), F.slice(pts, F.lit(2), n - 1).alias("b")
                )
            ).alias("e"),
        )
        .select(
            "gid", "admin_level", "side",
            F.col("e.a.x").alias("xa"), F.col("e.a.y").alias("ya"),
            F.col("e.b.x").alias("xb"), F.col("e.b.y").alias("yb"),
        )
        .where(F.col("xa") != F.col("xb"))
    )


def _below(y: Column, y0: Column, y1: Column) -> Column:
    """Integral from y0 to y of the part of a height that lies in [y0, y1]."""
    h = y1 - y0
    return (
        F.when(y <= y0, 0.0)
        .when(y <= y1, (y - y0) * (y - y0) / 2)
        .otherwise(h * h / 2 + h * (y - y1))
    )


def coverage(units: DataFrame, grid: Grid) -> DataFrame:
    """Exact covered share of every grid cell by every unit.

    -> (grid_id, gid, admin_level, lat_idx, lon_idx, fraction, cell_area)

    An edge is cut by the grid columns it crosses, and each piece by the rows it
    crosses in that column. There it adds the area between itself and the row's
    lower side; all rows below it get the full height, which is noted as one
    step and spread by a running sum down the column. Work is proportional to
    the cells that edges cross plus the cells that are covered, whatever the
    polygon's size. Pieces are spread by (unit, column), so one huge unit is
    shared by many tasks.
    """
    g = grid
    x_lo, x_hi = F.least("xa", "xb"), F.greatest("xa", "xb")
    c_first = F.greatest(F.floor((x_lo - g.lon0) / g.dlon), F.lit(0)).cast("int")
    c_last = F.least(F.ceil((x_hi - g.lon0) / g.dlon) - 1, F.lit(g.ncols - 1)).cast("int")
    at = lambda x: F.round((F.col(x) - F.col("x0")) / g.dlon * _TICKS).cast("bigint")
    ticks = (F.col("side") * F.signum(F.col("xb") - F.col("xa"))).cast("bigint") * (at("xr") - at("xl"))

    def rows_up(x: str) -> Column:
        y = F.col("ya") + F.col("slope") * (F.col(x) - F.col("xa"))
        return F.round((y - g.lat0) / g.dlat * _TICKS) / _TICKS

    cut = (
        edges(units)
        .where(c_first <= c_last)
        .select("*", F.explode(F.sequence(c_first, c_last)).alias("lon_idx"))
        .withColumn("x0", F.lit(g.lon0) + F.col("lon_idx") * g.dlon)
        .withColumn("xl", F.greatest(x_lo, F.col("x0")))
        .withColumn("xr", F.least(x_hi, F.lit(g.lon0) + (F.col("lon_idx") + 1) * g.dlon))
        .where(at("xr") > at("xl"))
        .withColumn("slope", (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa")))
        .withColumn("rl", rows_up("xl"))
        .withColumn("rr", rows_up("xr"))
        .select(
            "gid", "admin_level", "lon_idx", "rl", "rr", ticks.alias("ticks"),
            (F.lit(g.lat0) + F.col("rl") * g.dlat).alias("yl"), (F.lit(g.lat0) + F.col("rr") * g.dlat).alias("yr"),
            # signed width: what one unit of height below this piece is worth
            (F.col("side") * F.signum(F.col("xb") - F.col("xa")) * (F.col("xr") - F.col("xl"))).alias("w"),
        )
    )
    r_lo, r_hi = F.floor(F.least("rl", "rr")).cast("int"), F.floor(F.greatest("rl", "rr")).cast("int")
    first, last = F.greatest(r_lo, F.lit(0)), F.least(r_hi, F.lit(g.nrows - 1))

    def partial(r: Column) -> Column:
        y0 = F.lit(g.lat0) + r * g.dlat
        y1 = F.lit(g.lat0) + (r + 1) * g.dlat
        yl, yr = F.col("yl"), F.col("yr")
        flat = F.greatest(F.least(yl, y1), y0) - y0
        # nearly level pieces use the mean height: the quotient would lose all digits
        level = F.abs(yr - yl) < 1e-12
        mean_height = F.when(level, flat).otherwise(
            (_below(yr, y0, y1) - _below(yl, y0, y1)) / F.when(level, 1.0).otherwise(yr - yl)
        )
        return F.struct(
            r.alias("row"), (F.col("w") * mean_height).alias("part"), F.lit(0.0).alias("step"), F.lit(0).cast("bigint").alias("ticks")
        )

    crossings = F.when(first <= last, F.transform(F.sequence(first, last), partial))
    empty = F.array().cast("array<struct<row:int,part:double,step:double,ticks:bigint>>")
    step = F.when(
        r_lo > 0,
        F.array(F.struct(F.least(r_lo, F.lit(g.nrows)).alias("row"), F.lit(0.0).alias("part"), F.col("w").alias("step"), F.col("ticks"))),
    )
    marks = (
        cut.select(
            "gid", "admin_level", "lon_idx",
            F.explode(F.concat(F.coalesce(crossings, empty), F.coalesce(step, empty))).alias("m"),
        )
        # one exchange serves the aggregation and the running sum
        .repartition("gid", "lon_idx")
        .groupBy("gid", "admin_level", "lon_idx", F.col("m.row").alias("row"))
        .agg(
            F.sum("m.part").alias("part"), F.sum(F.abs("m.part")).alias("size"),
            F.sum("m.step").alias("step"), F.sum("m.ticks").alias("ticks"),
        )
    )
    down = Window.partitionBy("gid", "admin_level", "lon_idx").orderBy(F.col("row").desc())
    to_here, above = down.rowsBetween(Window.unboundedPreceding, 0), down.rowsBetween(Window.unboundedPreceding, -1)
    swept = marks.select(
        "gid", "admin_level", "lon_idx", "row", "part", "size",
        F.sum("step").over(to_here).alias("_incl"),
        (F.sum("ticks").over(to_here) != 0).alias("_inside"),
        F.when(F.sum("ticks").over(above) != 0, F.sum("step").over(above)).otherwise(0.0).alias("_excl"),
        F.coalesce(F.lead("row").over(down), F.lit(-1)).alias("_next"),
    )
    own = F.when(
        F.col("row") < g.nrows,
        F.array(F.struct(
            F.col("row").alias("lat_idx"), (F.col("part") + F.col("_excl") * g.dlat).alias("area"),
            (F.col("size") + F.abs("_excl") * g.dlat).alias("size"))),
    )
    inside = F.when(
        (F.col("_next") + 1 <= F.col("row") - 1) & F.col("_inside"),
        F.transform(
            F.sequence(F.col("_next") + 1, F.col("row") - 1),
            lambda r: F.struct(
                r.alias("lat_idx"), (F.col("_incl") * g.dlat).alias("area"), (F.abs("_incl") * g.dlat).alias("size")),
        ),
    )
    none = F.array().cast("array<struct<lat_idx:int,area:double,size:double>>")
    return (
        swept.select(
            "gid", "admin_level", "lon_idx",
            F.explode(F.concat(F.coalesce(own, none), F.coalesce(inside, none))).alias("c"),
        )
        .where(F.col("c.area") > _ROUNDING * F.col("c.size"))
        .select(
            F.lit(g.grid_id).alias("grid_id"), "gid", "admin_level",
            F.col("c.lat_idx").alias("lat_idx"), "lon_idx",
            (F.col("c.area") / (g.dlon * g.dlat)).alias("fraction"),
        )
        .withColumn("cell_area", cell_area(g.lat_centre(F.col("lat_idx")), g.dlat, g.dlon))
    )


def touched_cells(units: DataFrame, grid: Grid) -> DataFrame:
    """Cells a unit covers in any part; every one weighs its whole area."""
    return coverage(units, grid).withColumn("weight", F.col("cell_area")).drop("fraction")


def weighted_cells(units: DataFrame, grid: Grid) -> DataFrame:
    """Cells a unit covers; each weighs the covered part of its area."""
    return coverage(units, grid).withColumn("weight", F.col("cell_area") * F.col("fraction"))


def index_boxes(units: DataFrame, grid: Grid, buffer_cells: int = 2) -> DataFrame:
    """Bounding box of each unit widened by a number of cells, as degrees."""
    return units.select(
        "gid", bounding_box(F.col("rings"), buffer_cells * max(grid.dlon, grid.dlat)).alias("b")
    ).select("gid", "b.*")


_CELL = ["grid_id", "lat_idx", "lon_idx"]
_GROUP = ["grid_id", "gid", "admin_level", "date", "variable"]


def unit_extents(cov: DataFrame) -> DataFrame:
    """Per unit and grid: covered cells and cells of the enclosing index box."""
    span = lambda c: F.max(c) - F.min(c) + 1
    return cov.groupBy("grid_id", "gid", "admin_level").agg(
        F.count(F.lit(1)).alias("covered_cells"),
        (span("lat_idx") * span("lon_idx")).cast("bigint").alias("box_cells"),
    )


def with_every_date(extents: DataFrame, dates: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """One row per unit and (date, variable) of its grid, as the result needs.

    ``dates``: grid_id, date, variable, unit. The two sides meet on (grid, salt): a grid
    that holds most units is spread over as many tasks as the session shuffles into.
    With ``units`` every one of them gets the dates of every grid, and null extents
    where it covers no cell.
    """
    salts = int(dates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dates = dates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.hash("gid"), F.lit(salts)).alias("_salt")
    if units is None:
        return extents.select("*", salt).join(dates, ["grid_id", "_salt"]).drop("_salt")
    named = units.select("gid", "admin_level").distinct().select("*", salt)
    return named.join(dates, "_salt").drop("_salt").join(extents, ["grid_id", "gid", "admin_level"], "left")


def _in_units(summed: DataFrame, cov: DataFrame, broadcast_cells: int) -> DataFrame:
    """Sums of cells with each unit that covers the cell.

    Sums of up to ``broadcast_cells`` rows (counted) are sent to every task, and the coverage is
    dealt by unit: a unit's rows are made and added up in one place, and none of them is shuffled.
    Else a coverage table of up to so many rows is sent to every task, and the sums are weighed and
    pre-aggregated in place. Larger ones join by cell index.
    """
    if at_most(summed, broadcast_cells):
        # a number of tasks is given, as coverage rows are few bytes and many rows come of each
        tasks = int(cov.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return cov.repartition(tasks, "gid").join(F.broadcast(summed), _CELL)
    return summed.join(sized_broadcast(cov, broadcast_cells), _CELL)


def zonal_statistics(
    cells: DataFrame,
    cov: DataFrame,
    missing: str = "box",
    legacy_null_weight: bool = False,
    broadcast_cells: int = 500_000,
    units: DataFrame | None = None,
) -> DataFrame:
    """Weighted mean, plain sum/min/max and missing share per unit, date, variable.

    ``cells``: grid_id, lat_idx, lon_idx, date, variable, value, unit.
    ``cov``: output of :func:`touched_cells` or :func:`weighted_cells`.
    Null cells carry no weight (``legacy_null_weight`` lets them). A unit
    without any value on a date still gets a row: null statistics, 100 missing.
    So does, on every grid, one of ``units`` (gid, admin_level) without a covered
    cell; units without coverage are unknown where ``units`` is not given.
    ``missing`` relates absent cells to the enclosing ``box`` or to the
    ``covered`` cells.

    What lies in a cell on a date is added up first, as all of it has the same weight in a
    unit, and then meets the units that cover the cell (:func:`_in_units`).
    """
    # The sums give both the units' and, cells outside all units included, the dates of each grid.
    v, w = F.col("value"), F.col("weight")
    # A cell's few units of measure are keys, as the greatest text of a group would have to be found by sorting.
    summed = cells.groupBy(*_CELL, "date", "variable", "unit").agg(
        F.sum(v).alias("_s"), F.count(v).alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    summed = stored(summed, "cell-sums")
    joined = _in_units(summed, cov.select(*_CELL, "gid", "admin_level", "weight"), broadcast_cells)
    stats = joined.groupBy(*_GROUP).agg(
        F.sum(F.col("_s") * w).alias("_vw"),
        F.sum(w * F.col("_rows") if legacy_null_weight else F.when(F.col("_n") > 0, w * F.col("_n"))).alias("_w"),
        F.sum("_s").alias("sum"),
        F.min("_lo").alias("min"),
        F.max("_hi").alias("max"),
        F.sum("_n").alias("valid_cells"),
    )
    dates = summed.groupBy("grid_id", "date", "variable").agg(F.max("unit").alias("unit"))
    spine = with_every_date(unit_extents(cov), dates, units)
    total = F.col("box_cells") if missing == "box" else F.col("covered_cells")
    valid = F.coalesce("valid_cells", F.lit(0))
    return spine.join(stats, _GROUP, "left").select(
        "gid", "admin_level", "date", "variable",
        "sum", (F.col("_vw") / F.nullif("_w", F.lit(0.0))).alias("mean"), "min", "max",
        F.coalesce(F.round(100.0 * (total - valid) / total, 2), F.lit(100.0)).alias("missing_value_percentage"),
        "unit",
    )


def band_index_cells(bands: DataFrame, variable: str, unit: str = "unitless") -> DataFrame:
    """Band rows (red, nir, quality) -> cells of the normalised difference."""
    return bands.select(
        *_CELL, "date", F.lit(variable).alias("variable"),
        normalized_difference(F.col("red"), F.col("nir"), F.col("quality")).alias("value"),
        F.lit(unit).alias("unit"),
    )


def class_histogram(
    cells: DataFrame, cov: DataFrame, flags: DataFrame, broadcast_cells: int = 500_000
) -> DataFrame:
    """Per unit, date and class: cell count and share of the valid cells.

    Null cells do not count; a unit and date without valid cells has no row. A
    class without a flag is ``Unknown``. -> (gid, admin_level, date, class_id,
    variable, n_cells, percentage, missing_value_percentage of the enclosing box)
    """
    # what lies in a cell is counted first, then added up for the units that cover it
    summed = stored(
        cells.where(F.col("value").isNotNull())
        .groupBy(*_CELL, "date", F.col("value").cast("int").alias("class_id"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "cell-classes",
    )
    counted = (
        _in_units(summed, cov.select(*_CELL, "gid", "admin_level"), broadcast_cells)
        .groupBy("grid_id", "gid", "admin_level", "date", "class_id")
        .agg(F.sum("_n").alias("n_cells"))
    )
    # after the count a unit and date has one row per class
    total = F.sum("n_cells").over(Window.partitionBy("grid_id", "gid", "admin_level", "date"))
    shares = counted.withColumn("_valid", total).join(unit_extents(cov), ["grid_id", "gid", "admin_level"]).select(
        "gid", "admin_level", "date", "class_id", "n_cells",
        (100.0 * F.col("n_cells") / F.col("_valid")).alias("percentage"),
        (100.0 * (F.col("box_cells") - F.col("_valid")) / F.col("box_cells")).alias("missing_value_percentage"),
    )
    return label_classes(shares, flags)


def label_classes(df: DataFrame, flags: DataFrame) -> DataFrame:
    """Adds ``variable`` = ``{class_id}_{meaning}`` from a (value, meaning) table."""
    f = flags.select(F.col("value").cast("int").alias("class_id"), "meaning")
    return df.join(f, "class_id", "left").withColumn(
        "variable", F.concat_ws("_", "class_id", F.coalesce("meaning", F.lit("Unknown")))
    ).drop("meaning")


def class_json(histogram: DataFrame) -> DataFrame:
    """All classes of a unit and date in one JSON text, largest share first."""
    items = F.sort_array(
        F.collect_list(
            F.struct(
                (-F.col("n_cells")).alias("_o"), "variable",
                F.col("n_cells").alias("count"), F.round("percentage", 4).alias("percentage"),
            )
        )
    )
    shown = F.transform(items, lambda s: F.struct(s["variable"].alias("class"), s["count"].alias("count"), s["percentage"].alias("percentage")))
    return histogram.groupBy("gid", "admin_level", "date").agg(F.to_json(shown).alias("metadata"))
