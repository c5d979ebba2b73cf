"""Resampling sub-daily cells to days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: how a variable is brought from hours to days ---------------
# First rule whose words all occur (and whose excluded words do not) wins.
CLIMATE_RULES = [
    ("sum", ["evaporation"], []),
    ("sum", ["total_precipitation"], []),
    ("sum", ["surface_net_solar_radiation"], []),
    ("mean", ["2m_temperature"], ["maximum", "minimum"]),
    ("max", ["maximum_2m_temperature"], []),
    ("min", ["minimum_2m_temperature"], []),
]
AEROSOL_RULES = [
    ("mean", ["bcsmass"], []),
    ("mean", ["dusmass25"], []),
    ("mean", ["ocsmass"], []),
]
DEFAULT_RULE = "sum"

Rules = Sequence[tuple[str, Sequence[str], Sequence[str]]]


def rule_of(variable: Column, rules: Rules) -> Column:
    """Name of the daily aggregate of a variable."""
    low = F.lower(variable)
    out = F.lit(DEFAULT_RULE)
    for how, words, excluded in reversed(list(rules)):
        hit = F.lit(True)
        for word in words:
            hit = hit & low.contains(word)
        for word in excluded:
            hit = hit & ~low.contains(word)
        out = F.when(hit, how).otherwise(out)
    return out


def daily(
    cells: DataFrame,
    keys: Sequence[str] = ("grid_id", "lat_idx", "lon_idx", "variable"),
    rules: Rules = tuple(CLIMATE_RULES) + tuple(AEROSOL_RULES),
    fill_gaps: bool = True,
) -> DataFrame:
    """One value per cell, variable and day; the variable's rule picks the aggregate.

    A sum skips nulls, so a day of nulls sums to 0. With ``fill_gaps`` days
    missing between a cell's first and last day appear with null: each day row
    also emits the gap behind it, so no calendar has to be joined.
    """
    how = rule_of(F.col("variable"), rules)
    value = F.col("value")
    days = cells.groupBy(*keys, F.to_date("time").alias("date")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("_sum"),
        F.avg(value).alias("_mean"),
        F.max(value).alias("_max"),
        F.min(value).alias("_min"),
        F.max("unit").alias("unit"),
    )
    days = days.select(
        *keys, "date",
        F.when(how == "sum", F.col("_sum"))
        .when(how == "mean", F.col("_mean"))
        .when(how == "max", F.col("_max"))
        .otherwise(F.col("_min")).alias("value"),
        "unit",
    )
    if not fill_gaps:
        return days
    following = F.lead("date").over(Window.partitionBy(*keys).orderBy("date"))
    reach = days.withColumn("_upto", F.coalesce(F.date_sub(following, 1), F.col("date")))
    return reach.select(
        *keys, F.col("date").alias("_day"), F.explode(F.sequence("date", "_upto")).alias("date"), "value", "unit"
    ).select(*keys, "date", F.when(F.col("date") == F.col("_day"), F.col("value")).alias("value"), "unit")
