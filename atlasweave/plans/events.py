"""Event sources: cleaning, merging on shared codes, places of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.functions.dates import clamp_end, partial_date
from atlasweave.functions.text import (
    clean_label_text,
    codes_of_type,
    empty_to_null,
    event_label,
    pack_json,
    parse_units,
    strip,
    strip_suffix_array,
    typed_codes,
    valued_codes,
)
from atlasweave.operators.codes import (
    REMAPS_PLAIN,
    REMAPS_WITH_PLACES,
    code_anti,
    map_pair,
    remap_countries,
    update_from,
)
from atlasweave.operators.places import (
    answered_places,
    attach_units,
    contains_lookup,
    scan_names,
    scanned_names,
)
from atlasweave.operators.reshape import flatten_levels
from atlasweave.session import stored

# --- fixed values: source marks and source column names -----------------------
SOURCE_A, SOURCE_B = "EMDAT", "IDMC"
MONEY_COLUMNS_A = [
    "AID Contribution ('000 US$)",
    "Reconstruction Costs, Adjusted ('000 US$)",
    "Total Damage, Adjusted ('000 US$)",
]
METADATA_COLUMNS_A = [
    "DisNo.", "Classification Key", "Event Name", "External IDs", "Subregion", "Region",
    "Location", "Latitude", "Longitude", "River Basin", "Start Year", "Start Month", "Start Day",
    "End Year", "End Month", "End Day", "Admin Units",
]
CODE_TYPES_A = {"USGS": "usgs", "GLIDE": "glide", "DFO": "dfo"}
METADATA_COLUMNS_B = ["Event Name", "Event Codes (Code:Type)", "Year", "Hazard Type", "Hazard Sub Type"]
CODE_TYPES_B = {
    "Glide Number": "glide",
    "Local Identifier": "local_identifier",
    "IFRC Appeal ID": "ifrc_appeal_id",
    "Government Assigned Identifier": "government_assigned_identifier",
}
DISSOLVED_COUNTRY = "SCG"
SUCCESSOR_COUNTRIES = [("SRB", "Serbia"), ("MNE", "Montenegro")]


def _q(name: str):
    return F.col(f"`{name}`")


def _main_countries(mapping: DataFrame) -> DataFrame:
    """(iso3 -> main country name of the first mapping row)."""
    return mapping.groupBy(F.col("iso3").alias("_iso")).agg(F.min_by("main0", "seq").alias("_main0"))


def clean_events_a(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Source A: dates, codes, place lists, money, country and place names, label.

    ``raw`` has the source's own column names plus ``event_id``. ``mapping`` is
    the place mapping: iso3, seq, main0, alt0, main1, alt1, local1, main2, alt2,
    local2 (alt and local are pipe lists).
    """
    raw = raw.withColumns({"_units": parse_units(_q("Admin Units")), "_codes": typed_codes(_q("External IDs"))})
    units, codes = F.col("_units"), F.col("_codes")
    start = partial_date(_q("Start Year"), _q("Start Month"), _q("Start Day"))
    end = partial_date(_q("End Year"), _q("End Month"), _q("End Day"))
    remapped = {r.old for r in REMAPS_WITH_PLACES} | {DISSOLVED_COUNTRY}
    base = raw.select(
        "event_id",
        _q("Disaster Group").alias("disaster_group"),
        _q("Disaster Subgroup").alias("disaster_subgroup"),
        _q("Disaster Type").alias("disaster_type"),
        _q("Disaster Subtype").alias("disaster_subtype"),
        F.rtrim(_q("ISO")).alias("iso3_code"),
        _q("Country").alias("admin_level_0"),
        units["admin1"].alias("admin_level_1"),
        units["admin2"].alias("admin_level_2"),
        start.alias("start_date"),
        clamp_end(start, end).alias("end_date"),
        _q("Total Deaths").cast("bigint").alias("total_deaths"),
        _q("No. Injured").cast("bigint").alias("number_injured"),
        _q("No. Affected").cast("bigint").alias("number_affected"),
        _q("No. Homeless").cast("bigint").alias("number_homeless"),
        _q("Total Affected").cast("bigint").alias("total_affected"),
        *[(_q(c) * 1000).alias(clean_label_text(c)) for c in MONEY_COLUMNS_A],
        F.lit(SOURCE_A).alias("source"),
        pack_json([_q(c).alias(c) for c in METADATA_COLUMNS_A]).alias("metadata"),
        *[codes_of_type(codes, kind).alias(name) for kind, name in CODE_TYPES_A.items()],
        (~F.rtrim(_q("ISO")).isin(*remapped)).alias("_plain"),
    )
    base = stored(base, "events-a")  # dates, codes and JSON are worked out once
    mapping = stored(mapping, "mapping")
    located = remap_countries(
        base, REMAPS_WITH_PLACES, "iso3_code", "admin_level_0", "admin_level_1", "admin_level_2"
    ).where(F.col("iso3_code").isNotNull())
    located = answered_places(
        located, mapping, "event_id", "iso3_code", "admin_level_0", {1: "admin_level_1", 2: "admin_level_2"},
        DISSOLVED_COUNTRY, SUCCESSOR_COUNTRIES,
    )
    named = (
        located.join(_main_countries(mapping), F.col("iso3_code") == F.col("_iso"), "left")
        .withColumn(
            "admin_level_0",
            F.when(F.col("_plain") & F.col("_main0").isNotNull(), F.col("_main0")).otherwise(F.col("admin_level_0")),
        )
        .drop("_iso", "_main0", "_plain")
    )
    label = event_label(
        F.col("iso3_code"), F.col("disaster_type"), F.col("disaster_subtype"), F.col("start_date"),
        [F.lit(SOURCE_A), F.col("event_id")],
    )
    return named.withColumn("event_name", label)


def place_targets(mapping: DataFrame, names: DataFrame) -> DataFrame:
    """(iso3, level, name) -> main name the reference geography uses for it."""
    by_level = [
        contains_lookup(names.where(F.col("level") == level).select("iso3", "name").distinct(), mapping, level)
        .withColumn("level", F.lit(level))
        for level in (1, 2)
    ]
    return by_level[0].unionByName(by_level[1]).where(F.col("main").isNotNull())


def found_places(raw: DataFrame, mapping: DataFrame, row_id: str, iso3: str, text: str) -> DataFrame:
    """Main names of the level-1 and level-2 places in a text, as two arrays.

    Order: longest found name first, then alphabetical; each main name once.
    """
    mapping = stored(mapping, "mapping")
    names = stored(scanned_names(mapping), "names")
    found = scan_names(raw, names, row_id, iso3, text).where("level > 0")
    hits = found.join(place_targets(mapping, names), ["iso3", "level", "name"])
    item = F.struct((-F.length("name")).alias("o"), "name", "main")
    listed = hits.groupBy(row_id).agg(
        *[
            F.array_distinct(
                F.transform(
                    F.sort_array(F.collect_set(F.when(F.col("level") == level, item))), lambda s: s["main"]
                )
            ).alias(f"admin_level_{level}")
            for level in (1, 2)
        ]
    )
    return listed


def clean_events_b(raw: DataFrame, mapping: DataFrame, type_map: DataFrame) -> DataFrame:
    """Source B: codes, country names, places from free text, types, label.

    ``type_map``: seq, ``Hazard Type``, ``Hazard Sub Type``, ``Disaster Type``,
    ``Disaster Subtype``.
    """
    codes = F.col("_codes")
    base = raw.withColumn("_codes", valued_codes(_q("Event Codes (Code:Type)"))).select(
        "event_id",
        strip(_q("ISO3")).alias("iso3_code"),
        _q("Country / Territory").alias("admin_level_0"),
        _q("Event Name").alias("_text"),
        _q("Hazard Type").alias("_hazard"),
        _q("Hazard Sub Type").alias("_hazard_sub"),
        _q("Date of Event (start)").cast("date").alias("start_date"),
        _q("Disaster Internal Displacements").cast("bigint").alias("disaster_internal_displacements"),
        F.lit(SOURCE_B).alias("source"),
        pack_json([_q(c).alias(c) for c in METADATA_COLUMNS_B]).alias("metadata"),
        *[
            (strip_suffix_array(codes_of_type(codes, kind)) if name == "glide" else codes_of_type(codes, kind)).alias(name)
            for kind, name in CODE_TYPES_B.items()
        ],
    )
    base = stored(remap_countries(base, REMAPS_PLAIN, "iso3_code", "admin_level_0"), "events-b")
    mapping = stored(mapping, "mapping")
    places = found_places(base.select("event_id", "iso3_code", "_text"), mapping, "event_id", "iso3_code", "_text")
    empty = F.array().cast("array<string>")
    named = (
        base.join(places, "event_id", "left")
        .join(_main_countries(mapping), F.col("iso3_code") == F.col("_iso"), "left")
        .withColumn("admin_level_0", F.col("_main0"))
        .withColumn("admin_level_1", F.coalesce("admin_level_1", empty))
        .withColumn("admin_level_2", F.coalesce("admin_level_2", empty))
        .drop("_iso", "_main0", "_text")
    )
    types = type_map.select(
        "seq", _q("Hazard Type").alias("_hazard"), _q("Hazard Sub Type").alias("_hazard_sub"),
        _q("Disaster Type").alias("_type"), _q("Disaster Subtype").alias("_subtype"),
    )
    typed = map_pair(
        named, types, ("_hazard", "_hazard_sub"), ("_type", "_subtype"), "seq",
        ("disaster_type", "disaster_subtype"),
    ).drop("_hazard", "_hazard_sub")
    label = event_label(
        F.col("iso3_code"), F.col("disaster_type"), F.col("disaster_subtype"), F.col("start_date"),
        [F.lit(SOURCE_B), F.col("event_id")],
    )
    return typed.withColumn("event_name", label)


def stored_lists(events: DataFrame) -> DataFrame:
    """Load-time form: empty lists and empty texts become null."""
    lists = {
        f.name: empty_to_null(F.col(f.name)) for f in events.schema.fields if f.dataType.typeName() == "array"
    }
    return events.withColumns(lists)


def merge_events(a: DataFrame, b: DataFrame) -> DataFrame:
    """All of A, displacement taken from a B event with a shared code, plus unmatched B.

    Ids are only unique within a source, so the key of the result is
    (source, event_id).
    """
    if "disaster_internal_displacements" not in a.columns:
        a = a.withColumn("disaster_internal_displacements", F.lit(None).cast("bigint"))
    a, b = stored(a, "merged-a"), stored(b, "merged-b")  # each is asked for its rows and for its codes
    updated = update_from(a, b, "event_id", "event_id", "glide", "disaster_internal_displacements")
    unmatched = code_anti(b, a, "event_id", "glide")
    return updated.unionByName(unmatched, allowMissingColumns=True)


def events_with_geometry(events: DataFrame, units: DataFrame) -> DataFrame:
    """One row per event and administrative unit it names, with the unit's columns."""
    return attach_units(flatten_levels(events), units, "iso3_code", "admin_level", "admin_name")
