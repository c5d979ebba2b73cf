"""Serving views over observations and events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.operators.reshape import pivot_max, renamed
from atlasweave.schemas import GRID_DATASETS, MEAN_DATASETS
from atlasweave.session import stored

# --- fixed values: labels, categories and variables of the views ---------------
EVENT_LABELS = {
    "event_id": "Event ID",
    "event_name": "Event Name",
    "disaster_group": "Disaster Group",
    "disaster_subgroup": "Disaster Sub Group",
    "disaster_type": "Disaster Type",
    "disaster_subtype": "Disaster Sub Type",
    "iso3_code": "ISO3 (GADM - GID)",
    "admin_level_0": "Administrative Name - Level 0",
    "admin_level_1": "Administrative Name List - Level 1",
    "admin_level_2": "Administrative Name List - Level 2",
    "start_date": "Date",
    "end_date": "Event End Date",
    "total_deaths": "Total Deaths",
    "number_injured": "Number Injured",
    "number_affected": "Number Affected",
    "number_homeless": "Number Homeless",
    "total_affected": "Total Affected",
    "total_damage_adjusted": "Total Damage, Adjusted (USD)",
    "reconstruction_costs_adjusted": "Reconstruction Costs, Adjusted (USD)",
    "aid_contribution": "AID Contribution (USD)",
    "disaster_internal_displacements": "Event - Disaster Internal Displacements",
    "source": "Source",
    "metadata": "Metadata",
    "usgs": "United States Geological Survey (USGS) Earthquake ID",
    "glide": "GLIDE number",
    "dfo": "Darthmouth Flood Observatory (DFO) Event ID",
    "local_identifier": "Local Identifier",
    "ifrc_appeal_id": "IFRC Appeal ID",
    "government_assigned_identifier": "Government Assigned Identifier",
}
EVENT_MEASURES = {
    "total_deaths": "Total Deaths",
    "number_injured": "Number Injured",
    "number_affected": "Number Affected",
    "number_homeless": "Number Homeless",
    "total_affected": "Total Affected",
    "total_damage_adjusted": "Total Damage, Adjusted (USD)",
    "reconstruction_costs_adjusted": "Reconstruction Costs, Adjusted (USD)",
    "aid_contribution": "AID Contribution (USD)",
    "disaster_internal_displacements": "Event - Disaster Internal Displacements",
}
EVENT_SOURCE_LABEL = "EM-DAT & IDMC-GIDD - Event - Disaster Displacement data"
EVENT_CATEGORY = "Disaster Types"
WEATHER_INDICATORS = ["surfacetempyear", "relhumidityyear", "totprecipyear"]
CATEGORY_DISPLACEMENT = "Displacements"
CATEGORY_ENVIRONMENT = "Environmental and Climate Factors"
CATEGORY_SOCIAL = "Socio-demographic Indicators"
CLIMATE_LABELS = {
    "2m_temperature": "Daily Average Temperature of Air (2m)",
    "evaporation": "Daily Total Evaporation",
    "maximum_2m_temperature_since_previous_post_processing": "Daily Maximun Temperature of Air (2m)",
    "minimum_2m_temperature_since_previous_post_processing": "Daily Minimun Temperature of Air (2m)",
    "surface_net_solar_radiation": "Daily Total Surface Net Solar Radiation",
    "total_precipitation": "Daily Total Precipitation",
}
AEROSOL_LABELS = {
    "BCSMASS": "Daily Average Black Carbon Surface Mass Concentration",
    "DUSMASS25": "Daily Average Dust Surface Mass Concentration - PM 2.5",
    "OCSMASS": "Daily Average Organic Carbon Surface Mass Concentration",
}
POPULATION_LABELS = {
    "population_count": "WorldPop - Population Count",
    "population_density": "WorldPop - Population Density",
}

BURNT_AREA_LABELS = {"Monthly Burnt Area (Total)": "Monthly Total Burnt Area"}
SOIL_MOISTURE_LABELS = {"SMrz": "Root-zone Soil Moisture"}
VEGETATION_LABELS = {"NDVI": "Normalized Difference Vegetation Index"}
DENSITY_LABELS = {"Population_Weighted_Density_G": "WorldPop - Population Weighted Density - Geometric Mean"}


def catalog_labels(catalog: DataFrame, dataset: str) -> dict[str, str]:
    """Variable -> column name of a dataset, for a pivot.

    The catalog describes each variable in one row; a pivot needs its column names
    when it is planned, so the rows of one dataset (tens) are read.
    """
    rows = catalog.where(F.col("dataset") == dataset).select("variable", "label").distinct()
    return {r["variable"]: r["label"] for r in rows.orderBy("variable").collect()}


def all_labels(catalog: DataFrame, known: Mapping[str, Mapping[str, str]]) -> dict[tuple[str, str], str]:
    """(dataset, variable) -> column name of every column of the combined view.

    The catalog's entries, and for datasets it does not name the labels in ``known``.
    """
    rows = catalog.where(F.col("dataset").isNotNull()).select("dataset", "variable", "label").distinct()
    listed = {(r["dataset"], r["variable"]): r["label"] for r in rows.orderBy("dataset", "variable").collect()}
    named = {dataset for dataset, _ in listed}
    return {(dataset, v): label for dataset, labels in known.items() if dataset not in named for v, label in labels.items()} | listed


def selected_value(dataset: Column, variable: Column) -> Column:
    """The statistic that is the value of interest of a dataset and variable."""
    return (
        F.when((dataset == "population") & (variable == "population_count"), F.col("sum"))
        .when((dataset == "population") & (variable == "population_density"), F.col("mean"))
        .when((dataset == "population_age_sex") & variable.ilike("population_sex_age%"), F.col("sum"))
        .when(dataset.isin(MEAN_DATASETS), F.col("mean"))
        .otherwise(F.col("raw_value"))
    )


def category(dataset: Column, variable: Column) -> Column:
    return (
        F.when(dataset == "displacement", CATEGORY_DISPLACEMENT)
        .when((dataset == "indicators") & variable.isin(WEATHER_INDICATORS), CATEGORY_ENVIRONMENT)
        .when(
            dataset.isin("indicators", "population", "population_age_sex", "weighted_density"),
            CATEGORY_SOCIAL,
        )
        .otherwise(CATEGORY_ENVIRONMENT)
    )


def label_variables(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds ``label`` and ``data_source`` from the catalog, null where unknown.

    An entry for (dataset, variable) wins over an entry without a dataset. The
    catalog has one row per key, so no observation is multiplied; it is a few
    hundred rows, and the optimizer broadcasts it when its size says so.
    """
    exact = catalog.where(F.col("dataset").isNotNull()).groupBy("dataset", "variable").agg(
        F.min(F.struct("label", "data_source")).alias("_e")
    )
    general = catalog.where(F.col("dataset").isNull()).groupBy("variable").agg(
        F.min(F.struct("label", "data_source")).alias("_g")
    )
    return (
        obs.join(exact, ["dataset", "variable"], "left")
        .join(general, ["variable"], "left")
        .withColumn("label", F.coalesce("_e.label", "_g.label"))
        .withColumn("data_source", F.coalesce("_e.data_source", "_g.data_source"))
        .drop("_e", "_g")
    )


def with_defaults(obs: DataFrame) -> DataFrame:
    """Gridded rows: missing share defaults to 0, unit to ``N/A``; others keep null."""
    gridded = F.col("dataset").isin(GRID_DATASETS)
    return obs.withColumns(
        {
            "missing_value_percentage": F.when(
                gridded, F.coalesce("missing_value_percentage", F.lit(0.0))
            ),
            "unit": F.when(gridded, F.coalesce("unit", F.lit("N/A"))),
        }
    )


def long_view(obs: DataFrame, catalog: DataFrame, units: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every observation, labelled, with its selected value and country codes; ``keep`` names further columns to show."""
    level1 = units.where("admin_level = 1").select(F.col("gid").alias("_gid"), "iso3_1")
    labelled = label_variables(with_defaults(obs), catalog)
    return labelled.join(
        level1, (F.col("admin_level") == 1) & (F.col("gid") == F.col("_gid")), "left"
    ).select(
        "gid", "admin_level", "date",
        F.coalesce("label", "variable").alias("variable"),
        "sum", "mean", "min", "max", "raw_value", "missing_value_percentage",
        F.coalesce("data_source", "source").alias("source"),
        "unit",
        selected_value(F.col("dataset"), F.col("variable")).alias("selected_value"),
        F.substring("gid", 1, 3).alias("iso3_level_0"),
        F.when(F.col("admin_level") == 1, F.col("iso3_1")).alias("iso3_level_1"), *keep,
    )


def events_view(events: DataFrame, labels: Mapping[str, str] = EVENT_LABELS) -> DataFrame:
    return renamed(events, labels)


def event_rollup(events: DataFrame) -> DataFrame:
    """Events per (date, country, type): count and sums of the measures."""
    return events.groupBy(
        F.col("start_date").alias("date"), F.col("iso3_code").alias("iso3"),
        F.col("disaster_type").alias("variable"),
    ).agg(
        F.count(F.lit(1)).alias("selected_value"),
        *[F.sum(m).alias(m) for m in EVENT_MEASURES],
    )


def eav_view(obs: DataFrame, catalog: DataFrame, events: DataFrame, sort: bool = True) -> DataFrame:
    """Country level: event roll-up and level-0 observations in one long table."""
    rolled = event_rollup(events).select(
        "date", "iso3", F.lit(EVENT_SOURCE_LABEL).alias("source"), F.lit(EVENT_CATEGORY).alias("category"),
        "variable", F.col("selected_value").cast("double").alias("selected_value"), *EVENT_MEASURES,
    )
    # the level filter reaches the scan: one table partitioned by level, no per-branch copies
    country = label_variables(obs.where(F.col("admin_level") == 0), catalog).select(
        "date", F.col("gid").alias("iso3"),
        F.coalesce("data_source", "source").alias("source"),
        category(F.col("dataset"), F.col("variable")).alias("category"),
        F.coalesce("label", "variable").alias("variable"),
        selected_value(F.col("dataset"), F.col("variable")).alias("selected_value"),
    )
    both = rolled.unionByName(country, allowMissingColumns=True)
    return both.orderBy("date", "iso3", "source", "category", "variable") if sort else both


def wide_view(obs: DataFrame, dataset: str, labels: Mapping[str, str]) -> DataFrame:
    """One dataset pivoted: a column per known variable, its selected value inside."""
    mine = obs.where(F.col("dataset") == dataset).withColumn(
        "_v", selected_value(F.col("dataset"), F.col("variable"))
    )
    return pivot_max(mine, ["gid", "admin_level", "date"], "variable", "_v", labels)


def combined_view(obs: DataFrame, labels: Mapping[tuple[str, str], str]) -> DataFrame:
    """All datasets side by side per (gid, level, date): one pivot of the tagged table.

    Equal to full-joining the per-dataset pivots, with one shuffle.
    ``labels``: (dataset, variable) -> column name.
    """
    tagged = obs.select(
        "gid", "admin_level", "date",
        F.concat_ws("/", "dataset", "variable").alias("_k"),
        selected_value(F.col("dataset"), F.col("variable")).alias("_v"),
    )
    return pivot_max(
        tagged, ["gid", "admin_level", "date"], "_k", "_v", {"/".join(k): v for k, v in labels.items()}
    )


def country_event_view(wide: DataFrame, events: DataFrame) -> DataFrame:
    """Wide observations full-joined with events on (country, date).

    Written as a left join from the events plus the observations no event asks
    for: a full join cannot be split when one country and date holds a large
    part of all events, a left join and an anti join can. Null event keys match
    nothing and stay. Both sides are stored first: each is asked twice.
    """
    wide, events = stored(wide, "wide"), stored(events, "wide-events")
    ev = events.withColumnsRenamed({"iso3_code": "_iso", "start_date": "_start"})
    on = (F.col("_iso") == F.col("gid")) & (F.col("_start") == F.col("date"))
    event_side = (
        ev.join(wide, on, "left")
        .withColumn("gid", F.coalesce("gid", "_iso"))
        .withColumn("date", F.coalesce("date", "_start"))
        .drop("_iso", "_start")
    )
    asked = ev.select("_iso", "_start").distinct()
    rest = wide.join(asked, on, "left_anti")
    return event_side.unionByName(rest, allowMissingColumns=True)
