"""Name-keyed files -> observations: indicators, displacement, density features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.functions.dates import year_to_date
from atlasweave.functions.numbers import safe_double
from atlasweave.functions.text import NameRule, extract_places, extraction_note, normalize_name, pack_json
from atlasweave.operators.codes import DISPLACEMENT_CODES, remap_codes
from atlasweave.operators.keys import keep_first, keep_last
from atlasweave.operators.places import match_names, unmatched_names

# --- fixed values: variables of the indicator files ---------------------------
INDEX_VARIABLES = [
    "shdi", "healthindex", "edindex", "incindex", "sgdi", "shdif", "shdim", "healthindexf",
    "healthindexm", "edindexf", "edindexm", "lifexp", "lifexpf", "lifexpm", "lgnic", "pop",
]
WEATHER_VARIABLES = ["surfacetempyear", "relhumidityyear", "totprecipyear"]
AREA_VARIABLES = [
    "iwi", "iwipov70", "iwipov50", "iwipov35", "internet", "cellphone", "thtwithin", "thtbetween",
    "urban", "edyr25", "womedyr25", "menedyr25", "workwom", "wagri", "wwrklow", "wwrkhigh", "hagri",
    "hwrklow", "hwrkhigh", "agedifmar", "agemarw20", "tfr", "stunting", "haz", "whz", "waz", "bmiz",
    "dtp3age1", "measlage1", "regpopm", "popshare", "age09", "age1019", "age2029", "age3039",
    "age4049", "age5059", "age6069", "age7079", "age8089", "age90hi", "hhsize", "popworkage",
    "popold", "infmort", "u5mort", "pipedwater", "electr",
]
INDEX_SCALE = {"pop": 1000.0}
AREA_SCALE = {"regpopm": 1000000.0}
INDICATOR_METADATA = ["country", "continent", "iso_code", "level", "GDLCODE", "region", "year"]
WEATHER_METADATA = ["iso_code", "country", "GDLCODE", "level", "region", "continent", "year"]
AREA_METADATA = ["iso_code", "ISO2", "iso_num", "country", "year", "datasource", "GDLCODE", "level", "region"]
NATIONAL = "National"

# --- fixed values: displacement variables -------------------------------------
DISPLACEMENT_VARIABLES = [
    "Conflict Stock Displacement",
    "Conflict Internal Displacements",
    "Disaster Internal Displacements",
    "Disaster Stock Displacement",
]
AGE_GROUPS = ["0-4", "5-11", "12-17", "18-59", "60+"]
DENSITY_VARIABLE = "Population_Weighted_Density_G"
DENSITY_NOTE = "GID directly from WorldPop"
DENSITY_SOURCE = "WorldPop"


def located_indicators(
    raw: DataFrame,
    names: DataFrame,
    extractor=extract_places,
    rule: NameRule = normalize_name,
) -> DataFrame:
    """One row per input row and place, with the place's unit (or null).

    National rows carry the country itself at level 0. Each place of a region
    label becomes its own row. ``raw`` needs ``seq``, the load order.
    """
    raw = raw.withColumn("_places", extractor(F.col("region")))
    places = F.col("_places")
    national = F.col("level") == NATIONAL
    listed = F.when(F.coalesce(national, F.lit(False)), F.array(F.col("iso_code"))).otherwise(places)
    rows = raw.select(
        *[c for c in raw.columns if c != "_places"], F.posexplode(listed).alias("_pos", "place"),
        F.when(~F.coalesce(national, F.lit(False)), extraction_note(F.col("region"), places)).alias("note"),
    )
    matched = match_names(rows, names, "iso_code", "place", rule)
    is_national = F.coalesce(F.col("level") == NATIONAL, F.lit(False))
    return matched.withColumns(
        {
            "gid": F.when(is_national, F.col("iso_code")).otherwise(F.col("gid")),
            "admin_level": F.when(is_national, F.lit(0)).otherwise(F.col("admin_level")),
        }
    )


def indicator_observations(
    located: DataFrame,
    variables: Sequence[str],
    scale: Mapping[str, float] | None = None,
    metadata: Sequence[str] = tuple(INDICATOR_METADATA),
) -> DataFrame:
    """Matched rows -> long observations, the last input row winning per key."""
    scale = scale or {}
    numeric = {v: safe_double(F.col(v).cast("string")) * float(scale.get(v, 1.0)) for v in variables}
    wide = located.where(F.col("gid").isNotNull()).select(
        "gid", "admin_level", year_to_date(F.col("year")).alias("date"), "note",
        F.col("source_file").alias("source"),
        pack_json([F.col(c) for c in metadata], keep_nulls=True).alias("metadata"),
        "seq", "_pos", *[c.alias(v) for v, c in numeric.items()],
    )
    # Pick the winning row per unit and date before the unpivot: all variables of
    # a row share its order, so one wide pick replaces one pick per variable.
    winners = keep_last(wide, ["gid", "admin_level", "date"], ["seq", "_pos"])
    return winners.unpivot(
        ["gid", "admin_level", "date", "note", "source", "metadata"], list(variables), "variable", "raw_value"
    )


def load_indicators(
    raw: DataFrame,
    names: DataFrame,
    variables: Sequence[str],
    scale: Mapping[str, float] | None = None,
    metadata: Sequence[str] = tuple(INDICATOR_METADATA),
) -> tuple[DataFrame, DataFrame]:
    """(observations, unmatched names) of one kind of indicator files."""
    located = located_indicators(raw, names)
    return (
        indicator_observations(located, variables, scale, metadata),
        unmatched_names(located, "iso_code", "place", "region"),
    )


def _zero_sums(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Group sums that skip nulls; a group of nulls is 0; a null key drops the row."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.coalesce(F.sum(f"`{v}`"), F.lit(0.0)).alias(v) for v in variables])
    )


def _collide(long: DataFrame, on_collision: str, order: Sequence[str]) -> DataFrame:
    """Resolve rows that map to one key after country remapping."""
    key = ["gid", "admin_level", "date", "variable"]
    if on_collision == "last":
        return keep_last(long, key, order)
    last = F.max_by(F.struct("source", "metadata"), F.struct(*order)).alias("_l")
    return long.groupBy(*key).agg(F.sum("raw_value").alias("raw_value"), last).select(
        *key, "raw_value", "_l.source", "_l.metadata"
    )


def displacement(
    raw: DataFrame, variables: Sequence[str] = tuple(DISPLACEMENT_VARIABLES), on_collision: str = "sum"
) -> DataFrame:
    """National displacement sheets -> level-0 observations.

    First row per (ISO3, Name, Year, source_file) wins; territories are remapped
    to their country and summed (or the last kept); ``Stock`` reads ``Total``.
    """
    first = keep_first(raw, ["ISO3", "Name", "Year", "source_file"], ["seq"])
    mapped = first.withColumn("ISO3", remap_codes(F.col("ISO3"), DISPLACEMENT_CODES))
    sums = _zero_sums(mapped, ["ISO3", "Name", "Year", "source_file"], variables)
    titles = {v: v.replace("Stock", "Total") for v in variables}
    wide = sums.select(
        F.col("ISO3").alias("gid"), F.lit(0).alias("admin_level"), year_to_date(F.col("Year")).alias("date"),
        "Name", F.col("source_file").alias("source"),
        pack_json([F.col("ISO3"), F.col("Name"), F.col("Year")], keep_nulls=True).alias("metadata"),
        *[F.col(v).alias(t) for v, t in titles.items()],
    )
    long = wide.unpivot(
        ["gid", "admin_level", "date", "Name", "source", "metadata"], list(titles.values()), "variable", "raw_value"
    )
    return _collide(long, on_collision, ["source", "Name"])


def displacement_by_group(
    raw: DataFrame, ages: Sequence[str] = tuple(AGE_GROUPS), on_collision: str = "sum"
) -> DataFrame:
    """Displacement by cause, sex and age -> variables ``{Cause}_{Sex}_{Age}``."""
    first = keep_first(raw, ["ISO3", "Year", "Sex", "Cause"], ["seq"])
    mapped = first.withColumn("ISO3", remap_codes(F.col("ISO3"), DISPLACEMENT_CODES))
    keys = ["ISO3", "Country", "Year", "Sex", "Cause", "source_file"]
    sums = _zero_sums(mapped, keys, ages)
    wide = sums.select(
        F.col("ISO3").alias("gid"), F.lit(0).alias("admin_level"), year_to_date(F.col("Year")).alias("date"),
        "Country", "Sex", "Cause", F.col("source_file").alias("source"),
        pack_json([F.col(c) for c in ("ISO3", "Country", "Year", "Sex", "Cause")], keep_nulls=True).alias("metadata"),
        *[F.col(f"`{a}`") for a in ages],
    )
    long = wide.unpivot(
        ["gid", "admin_level", "date", "Country", "Sex", "Cause", "source", "metadata"], [f"`{a}`" for a in ages], "age", "raw_value"
    ).withColumn("variable", F.concat_ws("_", "Cause", "Sex", "age"))
    return _collide(long, on_collision, ["source", "Country"])


def density_observations(features: DataFrame, gid: Column, level: int, metadata: Mapping[str, str]) -> DataFrame:
    """Population-weighted density features -> observations; the unit id is taken as is."""
    return features.select(
        gid.alias("gid"), F.lit(level).alias("admin_level"), year_to_date(F.col("year")).alias("date"),
        F.lit(DENSITY_VARIABLE).alias("variable"), F.col("PWD_G").alias("raw_value"),
        F.lit(DENSITY_NOTE).alias("note"), F.lit(DENSITY_SOURCE).alias("source"),
        pack_json([F.col(c).alias(label) for c, label in metadata.items()], keep_nulls=True).alias("metadata"),
    )
