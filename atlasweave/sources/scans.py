"""Scans: folders of tables, feature collections, boundary levels, grids."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.functions.geo import RINGS_TYPE


def _any_case(text: str) -> str:
    """A glob that matches ``text`` in any letter case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def file_name() -> Column:
    return F.col("_metadata.file_name")


def read_tables(
    spark: SparkSession, path: str, contains: str = "", fmt: str = "csv", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """All files of a folder whose name contains a text (any case), with ``source_file``.

    The name filter is a listing glob, so other files are never opened. CSV
    columns are strings unless a schema is given; nothing is inferred.
    """
    suffix = {"csv": ".csv", "json": ".json", "parquet": ".parquet", "orc": ".orc"}[fmt]
    pattern = f"*{_any_case(contains)}*{suffix}" if contains else f"*{suffix}"
    reader = spark.read.format(fmt).option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load(path)
    return df.select("*", file_name().alias("source_file"))


def read_sheet(spark: SparkSession, path: str, workbook: str, sheet: str, fmt: str = "parquet") -> DataFrame:
    """One exported sheet, tagged ``{workbook}_{sheet}``."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).withColumn(
        "source_file", F.concat_ws("_", F.lit(workbook), F.lit(sheet))
    )


def read_features(spark: SparkSession, path: str, properties: str, one_per_line: bool = False) -> DataFrame:
    """Feature collections -> one row per feature: its properties and ``rings``.

    ``properties`` is the DDL of the property struct. One collection per file
    (or per line); files are read in parallel.
    """
    schema = (
        "type string, features array<struct<type:string,"
        f"properties:struct<{properties}>,"
        "geometry:struct<type:string,coordinates:string>>>"
    )
    raw = spark.read.schema(schema).option("multiLine", not one_per_line).json(path)
    feature = raw.select(F.explode("features").alias("f"))
    return feature.select("f.properties.*", rings_from_geojson(F.col("f.geometry")).alias("rings"))


def rings_from_geojson(geometry: Column) -> Column:
    """Polygon or MultiPolygon geometry (coordinates as JSON text) -> rings.

    The first ring of a polygon is its outline, the others are holes. Other
    geometry types give null.
    """
    text = geometry["coordinates"]
    parts = F.when(
        geometry["type"] == "MultiPolygon",
        F.from_json(text, "array<array<array<array<double>>>>"),
    ).when(
        geometry["type"] == "Polygon",
        F.array(F.from_json(text, "array<array<array<double>>>")),
    )
    rings = F.flatten(
        F.transform(
            parts,
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    (i > 0).alias("hole"),
                    F.transform(
                        ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
                    ).alias("points"),
                ),
            ),
        )
    )
    return rings.cast(RINGS_TYPE)


def boundary_level(units: DataFrame, level: int) -> DataFrame:
    """Units of one level: id and geometry only."""
    return units.where(F.col("admin_level") == level).select("gid", "rings")


def grid_cells(df: DataFrame, variable: str | None = None) -> DataFrame:
    """Cells of one variable (or all), a missing unit named ``unknown``."""
    picked = df if variable is None else df.where(F.col("variable") == variable)
    return picked.withColumn("unit", F.coalesce("unit", F.lit("unknown")))


def read_relation(spark: SparkSession, name: str, **jdbc) -> DataFrame:
    """A table by name; with ``url=...`` options, a partitioned read of a database."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.table(name)


# --- fixed values: variable code -> stored variable name, per gridded dataset --
VARIABLE_CODES = {
    "climate": {
        "tp": "total_precipitation",
        "e": "evaporation",
        "t2m": "2m_temperature",
        "mx2t": "maximum_2m_temperature_since_previous_post_processing",
        "mn2t": "minimum_2m_temperature_since_previous_post_processing",
        "ssr": "surface_net_solar_radiation",
    },
    "aerosol": {"BCSMASS": "BCSMASS", "DUSMASS25": "DUSMASS25", "OCSMASS": "OCSMASS"},
    "burnt_area": {"Total": "Monthly Burnt Area (Total)"},
    "soil_moisture": {"SMrz": "SMrz"},
    "population": {
        "population": "population_count",
        "population_density": "population_density",
        "population_age_sex_count": "population_age_sex_count",
    },
}


def name_variables(df: DataFrame, code: str, names: dict[str, str], out: str = "variable") -> DataFrame:
    """Long variable name of a code; a code without a name keeps the code."""
    col = F.col(code)
    named = col
    for short, long in names.items():
        named = F.when(col == short, long).otherwise(named)
    return df.withColumn(out, named)
