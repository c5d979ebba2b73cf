"""Boundary loading: three levels from one flat layer, and their hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.functions.text import pipe_to_array
from atlasweave.operators.grids import usable_units
from atlasweave.operators.keys import keep_first

# --- fixed values: level names used when a unit has no type of its own ---------
LEVEL_TYPES = {0: "Country", 1: "Admin Level 1", 2: "Admin Level 2"}


def admin_units(layer: DataFrame, check_geometry: bool = True) -> DataFrame:
    """The canonical unit table from a flat layer of the finest level.

    ``layer``: gid_0, name_0, gid_1, iso_1, name_1, varname_1, nl_name_1, type_1,
    gid_2, name_2, varname_2, nl_name_2, type_2, rings; one row per level-2 unit.
    A coarser unit takes its attributes and geometry from its first child (by
    ``gid_2``, then ``gid_1``); geometries are not dissolved.

    All three levels come from one read: a row is expanded to its three units
    and each unit keeps its first row.
    """
    if check_geometry:
        layer = usable_units(layer)
    none_text = F.lit(None).cast("string")
    none_list = F.lit(None).cast("array<string>")

    def unit(level, gid, parent, name, var, nl, iso_1, kind):
        return F.struct(
            gid.alias("gid"), parent.alias("parent_gid"), F.lit(level).alias("admin_level"),
            name.alias("name"), var.alias("var_names"), nl.alias("nl_names"), iso_1.alias("iso3_1"),
            F.coalesce(kind, F.lit(LEVEL_TYPES[level])).alias("level_type"),
        )

    c = F.col
    units = F.array(
        unit(0, c("gid_0"), none_text, c("name_0"), none_list, none_list, none_text, none_text),
        unit(1, c("gid_1"), c("gid_0"), c("name_1"), pipe_to_array(c("varname_1")),
             pipe_to_array(c("nl_name_1")), c("iso_1"), c("type_1")),
        unit(2, c("gid_2"), c("gid_1"), c("name_2"), pipe_to_array(c("varname_2")),
             pipe_to_array(c("nl_name_2")), none_text, c("type_2")),
    )
    rows = layer.select(
        c("gid_0").alias("iso3"), "rings", c("gid_1").alias("_o1"), c("gid_2").alias("_o2"),
        F.explode(units).alias("u"),
    ).select("iso3", "u.*", "rings", "_o1", "_o2").where(c("gid").isNotNull())
    first = keep_first(rows, ["gid"], ["_o2", "_o1"])
    return first.select(
        "gid", "iso3", "parent_gid", "admin_level", "name", "var_names", "nl_names", "iso3_1",
        "level_type", "rings",
    )
