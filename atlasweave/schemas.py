"""Canonical tables: schemas, keys and required columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TEXTS = T.ArrayType(T.StringType())


def _struct(*fields: tuple[str, T.DataType | str, bool]) -> T.StructType:
    out = T.StructType()
    for name, kind, nullable in fields:
        out = out.add(name, kind, nullable)
    return out


ADMIN_UNITS = _struct(
    ("gid", T.StringType(), False), ("iso3", T.StringType(), False),
    ("parent_gid", T.StringType(), True), ("admin_level", T.IntegerType(), False),
    ("name", T.StringType(), False), ("var_names", _TEXTS, True), ("nl_names", _TEXTS, True),
    ("iso3_1", T.StringType(), True), ("level_type", T.StringType(), True),
    ("rings", T.ArrayType(T.StructType([
        T.StructField("hole", T.BooleanType()),
        T.StructField("points", T.ArrayType(T.StructType([
            T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))),
    ])), True),
)

EVENTS = _struct(
    ("event_id", T.LongType(), False), ("event_name", T.StringType(), True),
    ("disaster_group", T.StringType(), True), ("disaster_subgroup", T.StringType(), True),
    ("disaster_type", T.StringType(), True), ("disaster_subtype", T.StringType(), True),
    ("iso3_code", T.StringType(), True), ("admin_level_0", T.StringType(), True),
    ("admin_level_1", _TEXTS, True), ("admin_level_2", _TEXTS, True),
    ("start_date", T.DateType(), True), ("end_date", T.DateType(), True),
    ("total_deaths", T.LongType(), True), ("number_injured", T.LongType(), True),
    ("number_affected", T.LongType(), True), ("number_homeless", T.LongType(), True),
    ("total_affected", T.LongType(), True), ("total_damage_adjusted", T.DoubleType(), True),
    ("reconstruction_costs_adjusted", T.DoubleType(), True), ("aid_contribution", T.DoubleType(), True),
    ("disaster_internal_displacements", T.LongType(), True), ("source", T.StringType(), True),
    ("metadata", T.StringType(), True), ("usgs", _TEXTS, True), ("glide", _TEXTS, True),
    ("dfo", _TEXTS, True), ("local_identifier", _TEXTS, True), ("ifrc_appeal_id", _TEXTS, True),
    ("government_assigned_identifier", _TEXTS, True),
)

OBSERVATIONS = _struct(
    ("dataset", T.StringType(), False), ("gid", T.StringType(), False),
    ("admin_level", T.IntegerType(), False), ("date", T.DateType(), False),
    ("variable", T.StringType(), False), ("sum", T.DoubleType(), True), ("mean", T.DoubleType(), True),
    ("min", T.DoubleType(), True), ("max", T.DoubleType(), True), ("raw_value", T.DoubleType(), True),
    ("missing_value_percentage", T.DoubleType(), True), ("note", T.StringType(), True),
    ("source", T.StringType(), True), ("unit", T.StringType(), True), ("metadata", T.StringType(), True),
)

# --- fixed values: the descriptive columns of the variable catalog -------------
CATALOG_LABELS = {
    "category": "Category",
    "data_source": "Data Source",
    "variable": "Original Variable Name",
    "label": "Modified Variable Name/Label",
    "unit": "Unit",
    "pre_calculation": "Pre-Calculation",
    "description": "Description",
    "selected_value": "Selected Value (Areal Calculation)",
    "temporal_coverage": "Temperal Coverage",
    "temporal_resolution": "Temperal Resolution",
    "geo_coverage": "Geo Coverage",
    "dataset": "Original DB Table Name",
    "original_source": "Original Data Source",
}

# The eleven observation datasets, gridded ones first.
GRID_DATASETS = [
    "climate", "aerosol", "burnt_area", "soil_moisture", "vegetation",
    "land_class", "population", "population_age_sex",
]
NAMED_DATASETS = ["indicators", "displacement", "weighted_density"]
DATASETS = GRID_DATASETS + NAMED_DATASETS

# Datasets whose value of interest is the area mean.
MEAN_DATASETS = ["climate", "aerosol", "burnt_area", "soil_moisture", "vegetation"]

OBSERVATION_KEY = ["gid", "admin_level", "date", "variable"]
OBSERVATION_VALUES = [
    "sum", "mean", "min", "max", "raw_value", "missing_value_percentage", "note", "source", "unit", "metadata",
]


@dataclass(frozen=True)
class TableRules:
    """What a canonical table promises; checked by the constraint reports."""

    schema: T.StructType
    key: list[str]
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TABLES = {
    "admin_units": TableRules(ADMIN_UNITS, ["gid"], {"iso3": 3, "gid": 20, "name": 100}),
    "events": TableRules(EVENTS, ["event_name", "iso3_code", "start_date"], {"event_name": 255, "iso3_code": 3}),
    "observations": TableRules(OBSERVATIONS, ["dataset", *OBSERVATION_KEY], {"gid": 20, "variable": 100}),
}
