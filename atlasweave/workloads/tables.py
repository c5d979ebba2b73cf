"""Benchmark tables -> canonical tables (Spark side; ``sql`` holds the twins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from atlasweave.operators.grids import Grid
from atlasweave.plans.indicators import AGE_GROUPS, AREA_VARIABLES, INDEX_VARIABLES, WEATHER_VARIABLES
from atlasweave.plans.views import category
from atlasweave.schemas import DATASETS, MEAN_DATASETS
from atlasweave.session import stored

GRID = Grid("g1", lon0=0.0, lat0=0.0, dlon=0.5, dlat=0.5, ncols=72, nrows=48)

# The variables of each dataset, in the datasets' order.
DATASET_VARIABLES = {
    "climate": [
        "2m_temperature", "evaporation", "maximum_2m_temperature_since_previous_post_processing",
        "minimum_2m_temperature_since_previous_post_processing", "surface_net_solar_radiation", "total_precipitation",
    ],
    "aerosol": ["BCSMASS", "DUSMASS25", "OCSMASS"],
    "burnt_area": ["Monthly Burnt Area (Total)"],
    "soil_moisture": ["SMrz"],
    "vegetation": ["NDVI"],
    "land_class": [f"{10 * k}_class_{k}" for k in range(1, 39)],
    "population": ["population_count", "population_density"],
    "population_age_sex": [
        *[f"population_sex_age_{sex}_{age}_count" for sex in "fm" for age in (0, 1, *range(5, 81, 5))],
        *[f"2021_2022_population_sex_age_{sex}_{age}_count" for sex in "fm" for age in range(0, 101, 5)],
    ],
    "indicators": [*INDEX_VARIABLES, *WEATHER_VARIABLES, *AREA_VARIABLES],
    "displacement": [
        "Conflict Total Displacement", "Conflict Internal Displacements", "Disaster Total Displacement", "Disaster Internal Displacements",
        *[f"{cause}_{sex}_{age}" for cause in ("Conflict", "Disaster") for sex in ("Both sexes", "Female", "Male") for age in AGE_GROUPS],
    ],
    "weighted_density": ["Population_Weighted_Density_G"],
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table; its schema is read from the files once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# The mappings below are written as SQL text: one call per expression instead of
# one per operator keeps building the plans cheap.


def _pick(values: list[str], index: str) -> Column:
    listed = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"element_at(array({listed}), CAST({index} + 1 AS INT))")


def _variable_counts(ds: str) -> str:
    """How many variables the dataset number ``ds`` has, as SQL."""
    return f"element_at(array({', '.join(str(len(DATASET_VARIABLES[d])) for d in DATASETS)}), {ds} + 1)"


def _pick_variable(ds: str, v: str) -> Column:
    lists = ", ".join("array(" + ", ".join(f"'{name}'" for name in DATASET_VARIABLES[d]) + ")" for d in DATASETS)
    return F.expr(f"element_at(element_at(array({lists}), CAST({ds} + 1 AS INT)), CAST({v} + 1 AS INT))")


def gid1_of(region: str, nation: str) -> Column:
    return F.expr(f"concat('R0', {region}, '.', {nation}, '_1')")


def order_places(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their nation, region and market segment."""
    return (
        table(spark, d, "orders")
        .join(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Monthly observations at levels 0 and 1 of eleven datasets."""
    places = (
        table(spark, d, "orders").select("o_orderkey", "o_custkey")
        .join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, d, "nation").select("n_nationkey", "n_regionkey"), F.expr("c_nationkey = n_nationkey"))
        .select("o_orderkey", "n_nationkey", "n_regionkey")
    )
    rows = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "CAST(l_partkey % 11 AS INT) AS ds",
        "CAST((l_orderkey * 7 + l_linenumber) % 78 AS INT) AS v",
        "trunc(CAST(l_shipdate AS DATE), 'month') AS date", "l_quantity AS q", "l_discount",
    )
    fine = (
        rows.join(places, F.expr("l_orderkey = o_orderkey"))
        .groupBy("ds", F.expr(f"v % {_variable_counts('ds')}").alias("v"), "n_nationkey", "n_regionkey", "date")
        .agg(*[F.expr(e) for e in (
            "sum(q) AS s", "count(1) AS n", "min(q) AS lo", "max(q) AS hi", "count_if(l_discount < 0.03) AS gaps")])
    )
    # the country level is added up from the (far smaller) unit level
    named = fine.select(
        "ds", _pick_variable("ds", "v").alias("variable"), "date", "s", "n", "lo", "hi", "gaps",
        F.expr(
            "explode(array(named_struct('admin_level', 0, 'gid', concat('R0', n_regionkey)),"
            " named_struct('admin_level', 1, 'gid', concat('R0', n_regionkey, '.', n_nationkey, '_1')))) AS u"),
    )
    return (
        named.groupBy("ds", "variable", "date", "u.admin_level", "u.gid")
        .agg(*[F.expr(e) for e in (
            "sum(s) AS s", "sum(n) AS n", "min(lo) AS lo", "max(hi) AS hi", "sum(gaps) AS gaps")])
        .withColumn("dataset", _pick(DATASETS, "ds"))
        .selectExpr(
            "dataset", "gid", "admin_level", "date", "variable",
            "CASE WHEN ds < 8 THEN s END AS sum",
            "CASE WHEN ds < 8 AND ds <> 5 THEN s / n END AS mean",
            "CASE WHEN ds < 8 AND ds <> 5 THEN lo END AS min",
            "CASE WHEN ds < 8 AND ds <> 5 THEN hi END AS max",
            "CASE WHEN ds >= 8 OR ds = 5 OR startswith(variable, '2021') THEN s * 2 END AS raw_value",
            "CASE WHEN ds < 8 AND n <> 3 THEN round(100.0D * gaps / n, 2) END AS missing_value_percentage",
            "CAST(NULL AS STRING) AS note", "concat('SRC_', dataset) AS source",
            "CASE WHEN ds % 2 = 0 THEN 'u' END AS unit", "CAST(NULL AS STRING) AS metadata",
        )
    )


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """The variable catalog: climate entries go by name only, aerosol has none."""
    rows = [(dataset, v) for dataset, named in DATASET_VARIABLES.items() if dataset != "aerosol" for v in named]
    listed = spark.createDataFrame(rows, "d string, variable string")
    none = F.lit(None).cast("string")
    return listed.select(
        F.when(F.col("d") != "climate", F.col("d")).alias("dataset"), "variable",
        F.concat(F.lit("Label of "), "variable").alias("label"),
        F.when(F.col("d") != "population", F.concat(F.lit("Cat "), "d")).alias("data_source"),
        category(F.col("d"), F.col("variable")).alias("category"), none.alias("unit"), none.alias("pre_calculation"),
        F.concat_ws(" of ", "variable", "d").alias("description"),
        F.when(F.col("d").isin(MEAN_DATASETS), "mean").otherwise("raw_value").alias("selected_value"),
        F.lit("1992-1998").alias("temporal_coverage"), F.lit("month").alias("temporal_resolution"), F.lit("all units").alias("geo_coverage"),
        F.concat(F.lit("SRC_"), "d").alias("original_source"),
    )


def flat_layer(spark: SparkSession, d: str) -> DataFrame:
    """One row per (nation, market segment), as a flat boundary layer."""
    pairs = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return (
        pairs.join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "concat('R0', r_regionkey) AS gid_0", "r_name AS name_0",
            "concat('R0', r_regionkey, '.', n_nationkey, '_1') AS gid_1", "concat('ISO-', n_nationkey) AS iso_1", "n_name AS name_1",
            "concat('Nation ', n_nationkey, '|N-', n_nationkey) AS varname_1",
            "CASE n_nationkey % 3 WHEN 0 THEN concat('Ñ ', n_nationkey) WHEN 1 THEN '' END AS nl_name_1",
            "CASE WHEN n_nationkey % 2 = 0 THEN 'Province' END AS type_1",
            "concat('R0', r_regionkey, '.', n_nationkey, '.', substring(c_mktsegment, 1, 4), '_1') AS gid_2",
            "initcap(c_mktsegment) AS name_2", "lower(c_mktsegment) AS varname_2", "CAST(NULL AS STRING) AS nl_name_2",
            "CAST(NULL AS STRING) AS type_2",
            "array(named_struct('hole', false, 'points', transform(array(0, 1, 2, 3, 0), i -> "
            "named_struct('x', CAST(n_nationkey + i % 2 AS DOUBLE), 'y', CAST(i AS DOUBLE))))) AS rings",
        )
    )


def units(spark: SparkSession, d: str) -> DataFrame:
    from atlasweave.plans.boundaries import admin_units

    return admin_units(flat_layer(spark, d))


def shape_rings(kind: str, x0: str, y0: str, w: str, h: str) -> Column:
    """A rectangle, a triangle (clockwise), a concave shape or a rectangle with a hole."""

    def ring(hole: str, *points: tuple[float, float]) -> str:
        pts = ", ".join(
            f"named_struct('x', ({x0}) + ({w}) * {px}D, 'y', ({y0}) + ({h}) * {py}D)" for px, py in points
        )
        return f"named_struct('hole', {hole}, 'points', array({pts}))"

    box = ring("false", (0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    hole = ring("true", (0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25))
    triangle = ring("false", (0, 0), (0, 1), (1, 0), (0, 0))
    concave = ring("false", (0, 0), (1, 0), (1, 1), (0.5, 0.25), (0, 1), (0, 0))
    if kind == "0":
        return F.expr(f"array({box})")
    return F.expr(
        f"CASE {kind} WHEN 0 THEN array({box}) WHEN 1 THEN array({triangle}) WHEN 2 THEN array({concave}) ELSE array({box}, {hole}) END"
    )


def shaped_units(spark: SparkSession, d: str) -> DataFrame:
    """Units with geometry: nations at level 1, suppliers at level 2, regions at level 0.

    Regions are far smaller than a cell, or outside the grid.
    """
    nations = table(spark, d, "nation").select(
        gid1_of("n_regionkey", "n_nationkey").alias("gid"), F.lit(1).alias("admin_level"), F.col("n_name").alias("name"),
        shape_rings("n_nationkey % 4", "(n_nationkey % 5) * 7 + 0.3D", "(n_nationkey div 5) * 4.6D + 0.2D", "6.5D", "4.3D").alias("rings"),
    )
    suppliers = table(spark, d, "supplier").select(
        F.expr("concat('S', s_suppkey) AS gid"), F.lit(2).alias("admin_level"), F.col("s_name").alias("name"),
        shape_rings("s_suppkey % 4", "(s_suppkey * 37 % 300) / 10.0D", "(s_suppkey * 53 % 190) / 10.0D", "2.0D + s_suppkey % 5", "1.5D + s_suppkey % 3").alias("rings"),
    )
    tiny = "r_regionkey % 2 = 0"
    regions = table(spark, d, "region").select(
        F.expr("concat('T', r_regionkey) AS gid"), F.lit(0).alias("admin_level"), F.col("r_name").alias("name"),
        shape_rings("0", f"CASE WHEN {tiny} THEN r_regionkey * 3 + 0.1D ELSE 200.0D END", "r_regionkey + 0.2D",
                    f"CASE WHEN {tiny} THEN 0.000002D ELSE 1.0D END", f"CASE WHEN {tiny} THEN 0.000002D ELSE 1.0D END").alias("rings"),
    )
    return nations.unionByName(suppliers).unionByName(regions)


CLIMATE_BY_EVENT = {
    "view": "total_precipitation",
    "click": "2m_temperature",
    "purchase": "maximum_2m_temperature_since_previous_post_processing",
    "signup": "minimum_2m_temperature_since_previous_post_processing",
    "error": "DUSMASS25",
}


def climate_variable(event_type: str) -> str:
    whens = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in CLIMATE_BY_EVENT.items())
    return f"CASE {event_type} {whens} END"


def hourly_cells(spark: SparkSession, d: str) -> DataFrame:
    """Readings of grid cells from the events table."""
    cells = table(spark, d, "events").selectExpr(
        f"'{GRID.grid_id}' AS grid_id", "ts AS time", f"CAST(user_id * 7 % {GRID.nrows} AS INT) AS lat_idx",
        f"CAST(user_id * 13 % {GRID.ncols} AS INT) AS lon_idx", f"{climate_variable('event_type')} AS variable",
        "CASE WHEN event_id % 11 <> 0 THEN value END AS value", "CASE WHEN event_id % 5 <> 0 THEN 'K' END AS unit",
    )
    return cells.withColumns({"lat": GRID.lat_centre(F.col("lat_idx")), "lon": GRID.lon_centre(F.col("lon_idx"))})


def daily_cells(spark: SparkSession, d: str) -> DataFrame:
    from atlasweave.operators.resample import daily

    return daily(hourly_cells(spark, d), fill_gaps=False)


def bands(spark: SparkSession, d: str) -> DataFrame:
    """Red, near-infrared and quality bands per cell and month."""
    part = table(spark, d, "part").select("p_partkey", "p_retailprice")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_linenumber")
    return lines.join(part, F.expr("l_partkey = p_partkey")).selectExpr(
        f"'{GRID.grid_id}' AS grid_id", f"CAST(l_orderkey % {GRID.nrows} AS INT) AS lat_idx",
        f"CAST(l_partkey % {GRID.ncols} AS INT) AS lon_idx", "trunc(CAST(l_shipdate AS DATE), 'month') AS date",
        "CAST(l_quantity * 10 AS INT) AS red",
        "CASE WHEN l_partkey % 17 = 0 THEN 32767 ELSE CAST(floor(p_retailprice) AS INT) END AS nir",
        "CAST(l_linenumber AS INT) AS quality",
    )


def class_cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        f"'{GRID.grid_id}' AS grid_id", f"CAST(p_partkey % {GRID.nrows} AS INT) AS lat_idx",
        f"CAST(p_partkey * 5 % {GRID.ncols} AS INT) AS lon_idx", "DATE '2020-01-01' AS date",
        "CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size % 8 AS INT) END AS value",
    )


def class_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("CAST(p_size % 8 AS INT) AS value").distinct().where("value <> 7").selectExpr(
        "value", "concat('class', value) AS meaning"
    )


_KIND_A = {"1-URGENT": "Earthquake", "2-HIGH": "Flood", "3-MEDIUM": "Storm", "5-LOW": "Drought"}
_KIND_B = {"error": "Flood", "view": "Storm", "click": "Earthquake", "purchase": "Drought", "signup": "Wildfire"}


def _case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def events_a(spark: SparkSession, d: str) -> DataFrame:
    """Clean source-A events from orders."""
    none = "CAST(NULL AS ARRAY<STRING>)"
    return order_places(spark, d).selectExpr(
        "o_orderkey AS event_id", "concat('A-', o_orderkey) AS event_name",
        "CASE WHEN o_orderkey % 10 <> 0 THEN 'Natural' END AS disaster_group", "CAST(NULL AS STRING) AS disaster_subgroup",
        f"{_case('o_orderpriority', _KIND_A)} AS disaster_type",
        "CASE o_orderstatus WHEN 'F' THEN 'Flash' WHEN 'O' THEN 'Riverine' END AS disaster_subtype",
        "CASE WHEN o_orderkey % 50 <> 0 THEN concat('R0', r_regionkey) END AS iso3_code", "r_name AS admin_level_0",
        "CASE o_orderkey % 3 WHEN 1 THEN array(n_name) WHEN 2 THEN CAST(array() AS ARRAY<STRING>) END AS admin_level_1",
        "CASE WHEN o_orderkey % 4 = 0 THEN array(initcap(c_mktsegment), 'Nowhere') END AS admin_level_2",
        "CAST(o_orderdate AS DATE) AS start_date", "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 10 AS INT)) AS end_date",
        "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 100 END AS total_deaths", "o_orderkey % 30 AS number_injured",
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 1000 END AS number_affected", "CAST(NULL AS BIGINT) AS number_homeless",
        "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 500 END AS total_affected", "o_totalprice AS total_damage_adjusted",
        "CAST(NULL AS DOUBLE) AS reconstruction_costs_adjusted",
        "CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice / 4 END AS aid_contribution",
        "CAST(NULL AS BIGINT) AS disaster_internal_displacements", "'EMDAT' AS source", "CAST(NULL AS STRING) AS metadata",
        f"{none} AS usgs",
        # one row in sixteen has 40 of 45 codes that very many rows share
        "CASE WHEN o_orderkey % 16 = 4 THEN transform(sequence(0, 39), i -> concat('HV-', (o_orderkey div 16 + i) % 45)) "
        "WHEN o_orderkey % 12 = 0 THEN array(concat('FL-', o_orderkey div 4 % 5000), concat('EQ-', o_orderkey % 1000)) "
        "WHEN o_orderkey % 4 = 0 THEN array(concat('FL-', o_orderkey div 4 % 5000)) END AS glide",
        f"{none} AS dfo",
    )


def events_b(spark: SparkSession, d: str) -> DataFrame:
    """Clean source-B events from the events table."""
    none = "CAST(NULL AS ARRAY<STRING>)"
    return (
        table(spark, d, "events")
        .join(table(spark, d, "nation"), F.expr("user_id % 25 = n_nationkey"))
        .join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "event_id", "concat('B-', event_id) AS event_name", f"{_case('event_type', _KIND_B)} AS disaster_type",
            "CAST(NULL AS STRING) AS disaster_subtype", "concat('R0', r_regionkey) AS iso3_code", "r_name AS admin_level_0",
            "CASE WHEN event_id % 2 = 0 THEN array(n_name) END AS admin_level_1", f"{none} AS admin_level_2",
            "date_add(DATE '1995-01-01', CAST(event_id % 2500 AS INT)) AS start_date",
            "CASE WHEN event_id % 6 <> 0 THEN CAST(floor(value) AS BIGINT) END AS disaster_internal_displacements",
            "'IDMC' AS source", "CAST(NULL AS STRING) AS metadata",
            "CASE WHEN event_id % 20 = 7 THEN transform(sequence(0, 39), i -> concat('HV-', (event_id div 20 + i) % 45)) "
            "WHEN event_id % 15 = 0 THEN array(concat('FL-', event_id div 3 % 5000), concat('EQ-', event_id % 1000)) "
            "WHEN event_id % 3 = 0 THEN array(concat('FL-', event_id div 3 % 5000)) END AS glide",
            f"{none} AS local_identifier", f"{none} AS ifrc_appeal_id", f"{none} AS government_assigned_identifier",
        )
    )


def events(spark: SparkSession, d: str) -> DataFrame:
    from atlasweave.plans.events import merge_events

    return merge_events(events_a(spark, d), events_b(spark, d))


# --- raw inputs of the cleaning jobs -------------------------------------------
SPECIAL_CODES = ["HKG", "MAC", "ANT", "SCG", "AB9", "XKK", "SRB", "MNE", "CHN", "XKO"]


def code_sql(nation: str, codes: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(codes))
    return f"CASE {nation} {whens} ELSE concat('N', lpad(CAST({nation} AS STRING), 2, '0')) END"


def country_code(nation: str, codes: list[str]) -> Column:
    return F.expr(code_sql(nation, codes))


def place_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The place mapping: a row per (nation, market segment), with the names that texts use."""
    pairs = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return pairs.selectExpr(
        f"{code_sql('c_nationkey', SPECIAL_CODES)} AS iso3",
        "CAST(c_nationkey * 100 + ascii(c_mktsegment) AS BIGINT) AS seq",
        "concat('Country ', c_nationkey) AS main0", "concat('Land ', c_nationkey) AS alt0",
        "concat('NATION_', c_nationkey) AS main1", "concat('Nat ', c_nationkey, '|Great Nat ', c_nationkey) AS alt1",
        "CASE WHEN c_nationkey = 8 THEN 'Hong Kong SAR|Macau SAR' END AS local1",
        "concat(initcap(c_mktsegment), ' District') AS main2",
        "concat(lower(c_mktsegment), '|Old ', lower(c_mktsegment), ' town') AS alt2",
        "CASE WHEN c_nationkey % 2 = 0 THEN concat('L', lower(c_mktsegment)) END AS local2",
    )


def raw_events_a(spark: SparkSession, d: str) -> DataFrame:
    """Source-A rows with the source's own columns."""
    other = "CASE o_orderkey % 3 WHEN 0 THEN 'NATION_6' WHEN 1 THEN 'NATION_7' ELSE 'Elsewhere' END"
    seg = "lower(c_mktsegment)"
    unit_list = f"""CASE WHEN o_orderkey % 5 = 0 THEN 'not a list'
        WHEN n_nationkey = 3 THEN concat("[{{'adm1_name':'", {other}, "'}}]")
        WHEN o_orderkey % 5 = 1 THEN concat("[{{'adm1_name':'Nat ", n_nationkey, "'}},{{'adm2_name':'", {seg}, "'}}]")
        WHEN o_orderkey % 5 = 2 THEN concat('[{{"adm2_code": 5, "adm2_name": "Old ', {seg}, ' town"}}, {{"adm2_name": "Unknown"}}]') END"""
    k, none_s, none_d = "o_orderkey", "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)"
    columns = {
        "event_id": k, "DisNo.": f"concat('D-', {k})", "Classification Key": "'nat-x'", "Disaster Group": "'Natural'",
        "Disaster Subgroup": none_s, "Disaster Type": f"CASE WHEN {k} % 6 <> 0 THEN o_orderpriority END",
        "Disaster Subtype": f"CASE WHEN {k} % 4 <> 0 THEN o_orderstatus END",
        "External IDs": f"CASE {k} % 4 WHEN 0 THEN concat('GLIDE:FL-', {k} div 4 % 5000, '|USGS:us:', {k}, '|junk') "
        f"WHEN 1 THEN concat('GLIDE:A-', {k}, '|GLIDE:B-', {k}) END",
        "Event Name": none_s, "ISO": code_sql("n_nationkey", SPECIAL_CODES), "Country": "n_name", "Subregion": "r_name",
        "Region": "r_name", "Location": none_s, "AID Contribution ('000 US$)": "o_totalprice", "Latitude": none_d,
        "Longitude": none_d, "River Basin": none_s, "Start Year": "year(o_orderdate)",
        "Start Month": f"CASE WHEN {k} % 7 <> 0 THEN month(o_orderdate) END",
        "Start Day": f"CASE WHEN {k} % 11 = 0 THEN 31 WHEN {k} % 3 <> 0 THEN dayofmonth(o_orderdate) END",
        "End Year": "year(o_orderdate)", "End Month": f"CASE WHEN {k} % 2 = 0 THEN month(o_orderdate) END", "End Day": "1",
        "Total Deaths": f"CASE WHEN {k} % 7 <> 0 THEN CAST({k} % 100 AS DOUBLE) END", "No. Injured": f"CAST({k} % 30 AS DOUBLE)",
        "No. Affected": f"CASE WHEN {k} % 2 = 0 THEN CAST({k} % 1000 AS DOUBLE) END", "No. Homeless": none_d,
        "Total Affected": f"CAST({k} % 500 AS DOUBLE)", "Reconstruction Costs, Adjusted ('000 US$)": none_d,
        "Total Damage, Adjusted ('000 US$)": f"CASE WHEN {k} % 8 <> 0 THEN CAST({k} * 3 AS DOUBLE) END",
        "Admin Units": unit_list,
    }
    return order_places(spark, d).selectExpr(*[f"{e} AS `{name}`" for name, e in columns.items()])


SPECIAL_CODES_B = ["HKG", "MAC", "ANT", "SCG", "AB9", "XKX", "SRB", "MNE", "CHN", "XKO"]


def raw_events_b(spark: SparkSession, d: str) -> DataFrame:
    """Source-B rows with the source's own columns."""
    seg = "element_at(array('automobile', 'Old building town', 'furniture', 'household', 'OLD MACHINERY TOWN'), CAST(event_id % 5 + 1 AS INT))"
    n = "(user_id % 25)"
    columns = {
        "event_id": "event_id", "ISO3": f"concat({code_sql(n, SPECIAL_CODES_B)}, ' ')", "Country / Territory": f"concat('Nation ', {n})",
        "Year": "year(ts)",
        "Event Name": f"CASE event_id % 4 WHEN 0 THEN concat('Flood - nation_', {n}, ' - ', {seg}, ' 20240101') "
        f"WHEN 1 THEN concat('Storm in Great Nat ', {n}, ', ', {seg}, '/household') "
        f"WHEN 2 THEN concat('Quake near Nat ', {n}, '0 and x', {seg}, 'x') "
        f"ELSE CASE WHEN {n} < 2 THEN 'Storm at Hong Kong/Macau' ELSE concat('Land ', {n}, ': ', {seg}) END END",
        "Date of Event (start)": "CAST(ts AS DATE)",
        "Disaster Internal Displacements": "CASE WHEN event_id % 6 <> 0 THEN CAST(floor(value) AS DOUBLE) END",
        "Hazard Type": "event_type", "Hazard Sub Type": "CASE WHEN event_id % 2 = 0 THEN event_type END",
        "Event Codes (Code:Type)": "CASE event_id % 3 WHEN 0 THEN concat('FL-', event_id div 3 % 5000, '-ABC:Glide Number; x:', event_id, ':IFRC Appeal ID') "
        "WHEN 1 THEN concat('loc', event_id, ':Local Identifier') END",
    }
    return table(spark, d, "events").selectExpr(*[f"{e} AS `{name}`" for name, e in columns.items()])


def type_map(spark: SparkSession, d: str) -> DataFrame:
    """Hazard pairs that occur -> disaster pairs; one type is left unmapped."""
    seen = stored(table(spark, d, "events").where("event_type <> 'error'").select("event_type").distinct(), "event-types")
    both = seen.selectExpr(
        "event_type AS `Hazard Type`", "event_type AS `Hazard Sub Type`", "upper(event_type) AS `Disaster Type`",
        "concat('Sub ', event_type) AS `Disaster Subtype`", "1 AS seq",
    )
    only = seen.where("event_type <> 'view'").selectExpr(
        "event_type AS `Hazard Type`", "CAST(NULL AS STRING) AS `Hazard Sub Type`", "initcap(event_type) AS `Disaster Type`",
        "CAST(NULL AS STRING) AS `Disaster Subtype`", "2 AS seq",
    )
    return both.unionByName(only)


def raw_indicators(spark: SparkSession, d: str, variables: list[str] = INDEX_VARIABLES) -> DataFrame:
    """Indicator file rows, values as text with blanks and junk."""
    k, n, m = "o_orderkey", "n_nationkey", "((n_nationkey + 5) % 25)"
    region = (
        f"CASE {k} % 8 WHEN 0 THEN concat('NATION_', {n}) WHEN 1 THEN concat('NATION_', {n}, ' and NATION_', {m}) "
        f"WHEN 2 THEN concat('Central (NATION_', {n}, ' NATION_', {m}, ')') WHEN 3 THEN concat('County of NATION_', {n}) "
        f"WHEN 4 THEN concat('II- NATION_', {n}, ' Region') WHEN 5 THEN 'North, BUILDING, Lowest 25%' "
        f"WHEN 6 THEN concat('Group (NATION_', {n}, ', incl. Atlantis ', {k} % 97, ')') "
        f"ELSE concat('Nation ', {n}, ', NATION_', ({n} + 1) % 25) END"
    )
    values = [
        f"CASE WHEN ({k} + {i}) % 9 = 0 THEN ' ' WHEN ({k} + {i}) % 23 = 0 THEN 'n/a' ELSE CAST({k} * {i} % 1000 AS STRING) END AS {v}"
        for i, v in enumerate(variables, 1)
    ]
    return order_places(spark, d).selectExpr(
        f"{k} AS seq", "concat('R0', r_regionkey) AS iso_code", "r_name AS country",
        f"CASE WHEN {k} % 3 <> 0 THEN 'World' END AS continent", f"CASE WHEN {k} % 20 = 0 THEN 'National' ELSE 'Subnat' END AS level",
        f"concat('R0', r_regionkey, 'r', {n}) AS GDLCODE", f"{region} AS region", "year(o_orderdate) AS year",
        f"concat('SHDI_', {k} % 2, '.csv') AS source_file", "concat('I', r_regionkey) AS ISO2", f"CAST({n} AS STRING) AS iso_num",
        f"CASE WHEN {k} % 2 = 0 THEN 'survey' END AS datasource", *values,
    )


DISPLACED_CODES = ["HKG", "MAC", "CHN", "XKX", "AB9", "SDN"]


def raw_displacement(spark: SparkSession, d: str) -> DataFrame:
    num = lambda i: f"CASE WHEN (o_orderkey + {i}) % 3 <> 0 THEN CAST(o_orderkey * {i} % 1000 AS DOUBLE) END"
    return order_places(spark, d).selectExpr(
        "o_orderkey AS seq", f"{code_sql('n_nationkey', DISPLACED_CODES)} AS ISO3", "n_name AS Name",
        "CASE WHEN o_orderkey % 40 <> 0 THEN year(o_orderdate) END AS Year", "concat('book_sheet', o_orderkey % 2) AS source_file",
        f"{num(1)} AS `Conflict Stock Displacement`", f"{num(2)} AS `Conflict Internal Displacements`",
        f"{num(3)} AS `Disaster Internal Displacements`", "CAST(NULL AS DOUBLE) AS `Disaster Stock Displacement`",
    )


def raw_displacement_groups(spark: SparkSession, d: str) -> DataFrame:
    num = lambda i: f"CASE WHEN (o_orderkey + {i}) % 4 <> 0 THEN CAST(o_orderkey * {i} % 1000 AS DOUBLE) END"
    return order_places(spark, d).selectExpr(
        "o_orderkey AS seq", f"{code_sql('n_nationkey', DISPLACED_CODES)} AS ISO3", "n_name AS Country",
        "CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' END AS Sex",
        "CASE WHEN o_orderpriority < '3' THEN 'Conflict' ELSE 'Disaster' END AS Cause", "year(o_orderdate) AS Year",
        "'book_groups' AS source_file", *[f"{num(i)} AS `{a}`" for i, a in enumerate(AGE_GROUPS, 1)],
    )
