"""SQL twins of ``tables``: common table expressions for the DuckDB check."""

from __future__ import annotations

import math

# The twins state their constants themselves: nothing here comes from the code they check.

# --- fixed values: datasets and variables -----------------------------------------
GRID_DATASETS = [
    "climate", "aerosol", "burnt_area", "soil_moisture", "vegetation", "land_class", "population", "population_age_sex",
]
DATASETS = [*GRID_DATASETS, "indicators", "displacement", "weighted_density"]
MEAN_DATASETS = ["climate", "aerosol", "burnt_area", "soil_moisture", "vegetation"]
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
AGE_GROUPS = ["0-4", "5-11", "12-17", "18-59", "60+"]
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

# --- fixed values: words and marks that are never a place name --------------------
IGNORED_PLACE_WORDS = [
    "", "incl", "total",
    "north", "south", "east", "west",
    "western", "eastern", "northern", "southern", "central",
    "north-western", "north-eastern", "south-western", "south-eastern",
    "north west", "north east", "south west", "south east",
    "north-west", "north-east", "south-west", "south-east",
    "second 25%", "third 25%", "lowest 25%", "highest 25%",
    "urban", "rural", "poor", "nonpoor",
]
PERCENTAGE_MARKS = ["25%", "50%", "75%", "100%"]
DIRECTION_MARKS = ["north-west", "north-east", "south-west", "south-east"]

# --- fixed values: how the adapters read the benchmark tables ---------------------
CLIMATE_BY_EVENT = {
    "view": "total_precipitation",
    "click": "2m_temperature",
    "purchase": "maximum_2m_temperature_since_previous_post_processing",
    "signup": "minimum_2m_temperature_since_previous_post_processing",
    "error": "DUSMASS25",
}
SPECIAL_CODES = ["HKG", "MAC", "ANT", "SCG", "AB9", "XKK", "SRB", "MNE", "CHN", "XKO"]
SPECIAL_CODES_B = ["HKG", "MAC", "ANT", "SCG", "AB9", "XKX", "SRB", "MNE", "CHN", "XKO"]
DISPLACED_CODES = ["HKG", "MAC", "CHN", "XKX", "AB9", "SDN"]


class GRID:
    """The grid of the gridded twins: half a degree from (0, 0)."""

    dlon, dlat, ncols, nrows = 0.5, 0.5, 72, 48


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def case_codes(n: str, codes) -> str:
    whens = " ".join(f"WHEN {n} = {i} THEN {lit(c)}" for i, c in enumerate(codes))
    return f"CASE {whens} ELSE 'N' || lpad(({n})::VARCHAR, 2, '0') END"


def initcap(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


_DS = texts(DATASETS)
_VAR = "[" + ", ".join(texts(DATASET_VARIABLES[d]) for d in DATASETS) + "]"
_COUNTS = "[" + ", ".join(str(len(DATASET_VARIABLES[d])) for d in DATASETS) + "]"

SELECTED = (
    "CASE WHEN dataset = 'population' AND variable = 'population_count' THEN \"sum\" "
    "WHEN dataset = 'population' AND variable = 'population_density' THEN mean "
    "WHEN dataset = 'population_age_sex' AND variable ILIKE 'population_sex_age%' THEN \"sum\" "
    f"WHEN dataset IN {in_list(MEAN_DATASETS)} THEN mean ELSE raw_value END"
)
CATEGORY = (
    "CASE WHEN dataset = 'displacement' THEN 'Displacements' "
    "WHEN dataset = 'indicators' AND variable IN ('surfacetempyear','relhumidityyear','totprecipyear') THEN 'Environmental and Climate Factors' "
    "WHEN dataset IN ('indicators','population','population_age_sex','weighted_density') THEN 'Socio-demographic Indicators' "
    "ELSE 'Environmental and Climate Factors' END"
)


def normalize(x: str) -> str:
    return f"replace(regexp_replace(lower({x}), '[^a-z0-9\\s]', '', 'g'), ' ', '_')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def extract_places(region: str) -> str:
    """A DuckDB list expression with the places of a region label."""
    body = f"replace(replace({region}, 'County of ', ''), ' and ', ', ')"
    inner = f"regexp_extract({body}, '\\(([^)]+)\\)', 1)"
    comma = lambda s: f"list_transform(string_split({s}, ','), lambda p: {strip('p')})"
    listed = (
        f"CASE WHEN contains({body}, '(') AND contains({body}, ')') THEN "
        f"CASE WHEN contains({inner}, ',') THEN {comma(inner)} ELSE string_split_regex({strip(inner)}, '\\s+') END "
        f"ELSE list_filter({comma(body)}, lambda p: p <> '') END"
    )
    tidy = (
        "regexp_replace(regexp_replace(regexp_replace(q, '\\s*region$', '', 'i'), '^[IVX]+-\\s*', ''), '^incl\\.?\\s*', '')"
    )
    marks = " AND ".join(f"NOT contains(lower(w), {lit(m)})" for m in PERCENTAGE_MARKS + DIRECTION_MARKS)
    return (
        f"list_filter(list_transform({listed}, lambda q: {tidy}), "
        f"lambda w: lower(w) NOT IN {in_list(IGNORED_PLACE_WORDS)} AND {marks})"
    )


def cell_area(lat: str, d: float = GRID.dlat) -> str:
    factor = d * d * (math.pi / 180.0) ** 2 * 6371000.0**2
    return f"({factor!r} * cos(radians({lat})))"


_OP = """order_places AS (
  SELECT o.*, c_nationkey, c_mktsegment, n_nationkey, n_name, n_regionkey, r_regionkey, r_name
  FROM orders o JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_OBS1 = f"""obs1 AS (
  SELECT (l_partkey % 11)::INT AS ds,
    ((l_orderkey * 7 + l_linenumber) % 78 % {_COUNTS}[(l_partkey % 11)::INT + 1])::INT AS v,
    n_nationkey AS n, n_regionkey AS r, date_trunc('month', l_shipdate::DATE)::DATE AS date,
    sum(l_quantity) AS s, count(*) AS c, min(l_quantity) AS lo, max(l_quantity) AS hi,
    count(*) FILTER (WHERE l_discount < 0.03) AS gaps
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""

_OBS = f"""obs AS (
  SELECT {_DS}[ds + 1] AS dataset, gid, admin_level, date, variable,
    CASE WHEN ds < 8 THEN s END AS "sum",
    CASE WHEN ds < 8 AND ds <> 5 THEN s / c END AS mean,
    CASE WHEN ds < 8 AND ds <> 5 THEN lo END AS "min",
    CASE WHEN ds < 8 AND ds <> 5 THEN hi END AS "max",
    CASE WHEN ds >= 8 OR ds = 5 OR variable LIKE '2021%' THEN s * 2 END AS raw_value,
    CASE WHEN ds < 8 AND c <> 3 THEN round(100.0::DOUBLE * gaps / c, 2) END AS missing_value_percentage,
    'SRC_' || {_DS}[ds + 1] AS source, CASE WHEN ds % 2 = 0 THEN 'u' END AS unit
  FROM (
    SELECT ds, {_VAR}[ds + 1][v + 1] AS variable, date, l AS admin_level,
      CASE WHEN l = 0 THEN 'R0' || r ELSE 'R0' || r || '.' || n || '_1' END AS gid,
      sum(s) AS s, sum(c)::BIGINT AS c, min(lo) AS lo, max(hi) AS hi, sum(gaps)::BIGINT AS gaps
    FROM obs1, (VALUES (0), (1)) lv(l) GROUP BY ALL))"""

_CATALOG = f"""catalog AS (
  SELECT CASE WHEN ds <> 'climate' THEN ds END AS dataset, variable, 'Label of ' || variable AS label,
    CASE WHEN ds <> 'population' THEN 'Cat ' || ds END AS data_source, ds
  FROM (SELECT {_DS}[i + 1] AS ds, unnest({_VAR}[i + 1]) AS variable FROM range(11) r(i)) WHERE ds <> 'aerosol')"""

_LAYER = f"""layer AS (
  SELECT 'R0' || r_regionkey AS gid_0, r_name AS name_0, 'R0' || r_regionkey || '.' || n_nationkey || '_1' AS gid_1,
    'ISO-' || n_nationkey AS iso_1, n_name AS name_1, 'Nation ' || n_nationkey || '|N-' || n_nationkey AS varname_1,
    CASE WHEN n_nationkey % 3 = 0 THEN 'Ñ ' || n_nationkey WHEN n_nationkey % 3 = 1 THEN '' END AS nl_name_1,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Province' END AS type_1,
    'R0' || r_regionkey || '.' || n_nationkey || '.' || substr(c_mktsegment, 1, 4) || '_1' AS gid_2,
    {initcap('c_mktsegment')} AS name_2, lower(c_mktsegment) AS varname_2
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

_UNITS = """units AS (
  SELECT DISTINCT gid_0 AS gid, gid_0 AS iso3, NULL::VARCHAR AS parent_gid, 0 AS admin_level, name_0 AS name,
    NULL::VARCHAR AS var_names, NULL::VARCHAR AS nl_names, NULL::VARCHAR AS iso3_1, 'Country' AS level_type FROM layer
  UNION ALL SELECT DISTINCT gid_1, gid_0, gid_0, 1, name_1, varname_1, nullif(nl_name_1, ''), iso_1, coalesce(type_1, 'Admin Level 1') FROM layer
  UNION ALL SELECT DISTINCT gid_2, gid_0, gid_1, 2, name_2, varname_2, NULL, NULL, 'Admin Level 2' FROM layer)"""

_GAZ = f"""gaz AS (
  SELECT DISTINCT iso3, admin_level, {normalize('raw')} AS norm_name, gid FROM (
    SELECT iso3, admin_level, gid, unnest(list_concat([name], coalesce(string_split(var_names, '|'), []), coalesce(string_split(nl_names, '|'), []))) AS raw
    FROM units WHERE admin_level IN (1, 2)) WHERE {normalize('raw')} <> ''),
gaz_best AS (
  SELECT iso3, norm_name, admin_level, gid FROM gaz
  QUALIFY row_number() OVER (PARTITION BY iso3, norm_name ORDER BY admin_level, gid) = 1)"""

_EVA = f"""ev_a AS (
  SELECT o_orderkey AS event_id, 'A-' || o_orderkey AS event_name,
    CASE WHEN o_orderkey % 10 <> 0 THEN 'Natural' END AS disaster_group, NULL::VARCHAR AS disaster_subgroup,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Earthquake' WHEN '2-HIGH' THEN 'Flood' WHEN '3-MEDIUM' THEN 'Storm' WHEN '5-LOW' THEN 'Drought' END AS disaster_type,
    CASE o_orderstatus WHEN 'F' THEN 'Flash' WHEN 'O' THEN 'Riverine' END AS disaster_subtype,
    CASE WHEN o_orderkey % 50 <> 0 THEN 'R0' || r_regionkey END AS iso3_code, r_name AS admin_level_0,
    CASE o_orderkey % 3 WHEN 1 THEN [n_name] WHEN 2 THEN []::VARCHAR[] END AS admin_level_1,
    CASE WHEN o_orderkey % 4 = 0 THEN [{initcap('c_mktsegment')}, 'Nowhere'] END AS admin_level_2,
    o_orderdate::DATE AS start_date, (o_orderdate::DATE + (o_orderkey % 10)::INT)::DATE AS end_date,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 100 END AS total_deaths, o_orderkey % 30 AS number_injured,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 1000 END AS number_affected, NULL::BIGINT AS number_homeless,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 500 END AS total_affected, o_totalprice AS total_damage_adjusted,
    NULL::DOUBLE AS reconstruction_costs_adjusted, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice / 4 END AS aid_contribution,
    NULL::BIGINT AS disaster_internal_displacements, 'EMDAT' AS source,
    CASE WHEN o_orderkey % 16 = 4 THEN list_transform(range(40), lambda i: 'HV-' || ((o_orderkey // 16 + i) % 45))
      WHEN o_orderkey % 12 = 0 THEN ['FL-' || (o_orderkey // 4 % 5000), 'EQ-' || (o_orderkey % 1000)]
      WHEN o_orderkey % 4 = 0 THEN ['FL-' || (o_orderkey // 4 % 5000)] END AS glide
  FROM order_places)"""

_EVB = """ev_b AS (
  SELECT event_id, 'B-' || event_id AS event_name,
    CASE event_type WHEN 'error' THEN 'Flood' WHEN 'view' THEN 'Storm' WHEN 'click' THEN 'Earthquake' WHEN 'purchase' THEN 'Drought' WHEN 'signup' THEN 'Wildfire' END AS disaster_type,
    NULL::VARCHAR AS disaster_subtype, 'R0' || r_regionkey AS iso3_code, r_name AS admin_level_0,
    CASE WHEN event_id % 2 = 0 THEN [n_name] END AS admin_level_1, NULL::VARCHAR[] AS admin_level_2,
    (DATE '1995-01-01' + (event_id % 2500)::INT)::DATE AS start_date,
    CASE WHEN event_id % 6 <> 0 THEN floor(value)::BIGINT END AS disaster_internal_displacements, 'IDMC' AS source,
    CASE WHEN event_id % 20 = 7 THEN list_transform(range(40), lambda i: 'HV-' || ((event_id // 20 + i) % 45))
      WHEN event_id % 15 = 0 THEN ['FL-' || (event_id // 3 % 5000), 'EQ-' || (event_id % 1000)]
      WHEN event_id % 3 = 0 THEN ['FL-' || (event_id // 3 % 5000)] END AS glide
  FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CODES = """codes_a AS (SELECT DISTINCT event_id, iso3_code, unnest(glide) AS code FROM ev_a),
codes_b AS (SELECT DISTINCT event_id, iso3_code, unnest(glide) AS code FROM ev_b),
code_pairs AS (SELECT DISTINCT a.event_id AS a_id, b.event_id AS b_id FROM codes_a a JOIN codes_b b USING (code)),
country_pairs AS (
  SELECT p.a_id, p.b_id, a.iso3_code, a.disaster_type AS a_type, b.disaster_type AS b_type, year(a.start_date) AS a_year, year(b.start_date) AS b_year
  FROM code_pairs p JOIN ev_a a ON a.event_id = a_id JOIN ev_b b ON b.event_id = b_id WHERE a.iso3_code = b.iso3_code)"""

_MERGED = """first_match AS (
  SELECT a_id, arg_min(b_id, b_id) AS b_id FROM code_pairs GROUP BY a_id),
ev AS (
  SELECT a.event_id, a.event_name, a.disaster_group, a.disaster_type, a.disaster_subtype, a.iso3_code, a.admin_level_0, a.admin_level_1, a.admin_level_2,
    a.start_date, a.end_date, a.total_deaths, a.number_injured, a.number_affected, a.number_homeless, a.total_affected, a.total_damage_adjusted,
    a.reconstruction_costs_adjusted, a.aid_contribution, b.disaster_internal_displacements, a.source, a.glide
  FROM ev_a a LEFT JOIN first_match m ON a.event_id = m.a_id LEFT JOIN ev_b b ON b.event_id = m.b_id
  UNION ALL
  SELECT event_id, event_name, NULL, disaster_type, disaster_subtype, iso3_code, admin_level_0, admin_level_1, admin_level_2, start_date,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, disaster_internal_displacements, source, glide
  FROM ev_b WHERE event_id NOT IN (SELECT b_id FROM code_pairs))"""


def _shape(kind: str, x0: str, y0: str, w: str, h: str) -> str:
    """A list of directed edges {xa, ya, xb, yb}; outlines one way, holes the other."""

    def ring(*pts) -> str:
        p = [(f"({x0}) + ({w}) * {px}", f"({y0}) + ({h}) * {py}") for px, py in pts]
        return ", ".join(
            f"{{'xa': {a[0]}, 'ya': {a[1]}, 'xb': {b[0]}, 'yb': {b[1]}}}" for a, b in zip(p, p[1:])
        )

    box = ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    hole = ring((0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25), (0.25, 0.25))
    tri = ring((0, 0), (0, 1), (1, 0), (0, 0))
    con = ring((0, 0), (1, 0), (1, 1), (0.5, 0.25), (0, 1), (0, 0))
    return f"CASE {kind} WHEN 0 THEN [{box}] WHEN 1 THEN [{tri}] WHEN 2 THEN [{con}] ELSE [{box}, {hole}] END"


_NX, _NY = "(n_nationkey % 5) * 7 + 0.3::DOUBLE", "(n_nationkey // 5) * 4.6::DOUBLE + 0.2::DOUBLE"
_SX, _SY = "(s_suppkey * 37 % 300) / 10.0::DOUBLE", "(s_suppkey * 53 % 190) / 10.0::DOUBLE"
_TX = "(CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey * 3 + 0.1::DOUBLE ELSE 200.0::DOUBLE END)"
_TSIZE = "(CASE WHEN r_regionkey % 2 = 0 THEN 0.000002::DOUBLE ELSE 1.0::DOUBLE END)"
_COV = f"""shapes AS (
  SELECT 'R0' || n_regionkey || '.' || n_nationkey || '_1' AS gid, 1 AS admin_level,
    {_shape('n_nationkey % 4', _NX, _NY, '6.5::DOUBLE', '4.3::DOUBLE')} AS edges FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 2,
    {_shape('s_suppkey % 4', _SX, _SY, '(2.0::DOUBLE + s_suppkey % 5)', '(1.5::DOUBLE + s_suppkey % 3)')} FROM supplier
  UNION ALL SELECT 'T' || r_regionkey, 0,
    {_shape('0', _TX, 'r_regionkey + 0.2::DOUBLE', _TSIZE, _TSIZE)} FROM region),
edges AS (
  SELECT gid, admin_level, e.xa AS xa, e.ya AS ya, e.xb AS xb, e.yb AS yb FROM (SELECT gid, admin_level, unnest(edges) AS e FROM shapes)),
boxes AS (
  SELECT gid, admin_level, floor(min(xa) / {GRID.dlon})::INT AS c0, ceil(max(xa) / {GRID.dlon})::INT - 1 AS c1,
    floor(min(ya) / {GRID.dlat})::INT AS r0, ceil(max(ya) / {GRID.dlat})::INT - 1 AS r1 FROM edges GROUP BY ALL),
box_cells AS (
  SELECT gid, admin_level, c AS lon_idx, unnest(range(r0, r1 + 1)) AS lat_idx FROM (SELECT *, unnest(range(c0, c1 + 1)) AS c FROM boxes)),
cut AS (
  SELECT b.gid, b.admin_level, lon_idx, lat_idx, sign(xb - xa) AS sgn,
    greatest(least(xa, xb), lon_idx * {GRID.dlon}) AS xl, least(greatest(xa, xb), (lon_idx + 1) * {GRID.dlon}) AS xr,
    xa, ya, (yb - ya) / (xb - xa) AS slope, lat_idx * {GRID.dlat} AS y0, (lat_idx + 1) * {GRID.dlat} AS y1
  FROM box_cells b JOIN edges e USING (gid) WHERE xa <> xb
    AND greatest(xa, xb) > lon_idx * {GRID.dlon} AND least(xa, xb) < (lon_idx + 1) * {GRID.dlon}),
heights AS (
  SELECT *, ya + slope * (xl - xa) AS yl, ya + slope * (xr - xa) AS yr FROM cut),
below AS (
  SELECT *, CASE WHEN yl <= y0 THEN 0 WHEN yl <= y1 THEN (yl - y0) * (yl - y0) / 2 ELSE (y1 - y0) * (y1 - y0) / 2 + (y1 - y0) * (yl - y1) END AS cl,
    CASE WHEN yr <= y0 THEN 0 WHEN yr <= y1 THEN (yr - y0) * (yr - y0) / 2 ELSE (y1 - y0) * (y1 - y0) / 2 + (y1 - y0) * (yr - y1) END AS cr FROM heights),
coverage AS (
  SELECT gid, admin_level, lat_idx::INT AS lat_idx, lon_idx::INT AS lon_idx, fraction, {cell_area(f'(lat_idx + 0.5) * {GRID.dlat}')} AS cell_area FROM (
    SELECT gid, admin_level, lat_idx, lon_idx, abs(sum(sgn * (xr - xl) * CASE WHEN abs(yr - yl) < 1e-12 THEN greatest(least(yl, y1), y0) - y0 ELSE (cr - cl) / (yr - yl) END)) / {GRID.dlon * GRID.dlat} AS fraction
    FROM below GROUP BY ALL) WHERE fraction > 1e-12 AND lon_idx < {GRID.ncols} AND lat_idx < {GRID.nrows})"""

_EV_VAR = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in CLIMATE_BY_EVENT.items())
_CELLS = f"""hourly AS (
  SELECT ts AS time, (user_id * 7 % {GRID.nrows})::INT AS lat_idx, (user_id * 13 % {GRID.ncols})::INT AS lon_idx,
    CASE event_type {_EV_VAR} END AS variable, CASE WHEN event_id % 11 <> 0 THEN value END AS value,
    CASE WHEN event_id % 5 <> 0 THEN 'K' END AS unit FROM events),
daily AS (
  SELECT lat_idx, lon_idx, variable, time::DATE AS date,
    CASE WHEN variable LIKE '%precipitation%' THEN coalesce(sum(value), 0) WHEN variable LIKE 'maximum%' THEN max(value)
      WHEN variable LIKE 'minimum%' THEN min(value) ELSE avg(value) END AS value, max(unit) AS unit
  FROM hourly GROUP BY lat_idx, lon_idx, variable, time::DATE)"""

_BANDS = f"""bands AS (
  SELECT (l_orderkey % {GRID.nrows})::INT AS lat_idx, (l_partkey % {GRID.ncols})::INT AS lon_idx,
    date_trunc('month', l_shipdate::DATE)::DATE AS date, (l_quantity * 10)::INT AS red,
    CASE WHEN l_partkey % 17 = 0 THEN 32767 ELSE floor(p_retailprice)::INT END AS nir, l_linenumber AS quality
  FROM lineitem JOIN part ON l_partkey = p_partkey),
band_cells AS (
  SELECT lat_idx, lon_idx, date, 'NDVI' AS variable, 'unitless' AS unit,
    CASE WHEN quality <= 5 AND red <> 32767 AND nir <> 32767 THEN
      greatest(-1.0, least(1.0, (nir * 0.001::DOUBLE - red * 0.001::DOUBLE) / nullif(nir * 0.001::DOUBLE + red * 0.001::DOUBLE, 0))) END AS value
  FROM bands)"""

_CLASSES = f"""class_cells AS (
  SELECT (p_partkey % {GRID.nrows})::INT AS lat_idx, (p_partkey * 5 % {GRID.ncols})::INT AS lon_idx, DATE '2020-01-01' AS date,
    CASE WHEN p_partkey % 13 <> 0 THEN p_size % 8 END AS value FROM part),
flags AS (SELECT DISTINCT p_size % 8 AS value, 'class' || (p_size % 8) AS meaning FROM part WHERE p_size % 8 <> 7),
histogram AS (
  SELECT gid, admin_level, date, h.value::INT AS class_id, h.value || '_' || coalesce(meaning, 'Unknown') AS variable, n_cells,
    100.0::DOUBLE * n_cells / sum(n_cells) OVER (PARTITION BY gid, admin_level, date) AS percentage
  FROM (SELECT gid, admin_level, date, value, count(*) AS n_cells FROM class_cells JOIN coverage USING (lat_idx, lon_idx)
    WHERE value IS NOT NULL GROUP BY ALL) h LEFT JOIN flags f ON h.value = f.value)"""

_MAPPING = f"""mapping AS (
  SELECT {case_codes('c_nationkey', SPECIAL_CODES)} AS iso3, (c_nationkey * 100 + ascii(c_mktsegment))::BIGINT AS seq,
    'Country ' || c_nationkey AS main0, 'Land ' || c_nationkey AS alt0, 'NATION_' || c_nationkey AS main1,
    'Nat ' || c_nationkey || '|Great Nat ' || c_nationkey AS alt1, CASE WHEN c_nationkey = 8 THEN 'Hong Kong SAR|Macau SAR' END AS local1,
    {initcap('c_mktsegment')} || ' District' AS main2, lower(c_mktsegment) || '|Old ' || lower(c_mktsegment) || ' town' AS alt2,
    CASE WHEN c_nationkey % 2 = 0 THEN 'L' || lower(c_mktsegment) END AS local2
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)),
main_country AS (SELECT iso3, arg_min(main0, seq) AS main0 FROM mapping GROUP BY iso3),
name_sets AS (
  SELECT DISTINCT iso3, level, trim(name) AS name FROM (
    SELECT iso3, 0 AS level, unnest(string_split(main0 || '|' || alt0, '|')) AS name FROM mapping
    UNION ALL SELECT iso3, 1, unnest(string_split(main1 || '|' || alt1 || coalesce('|' || local1, ''), '|')) FROM mapping
    UNION ALL SELECT iso3, 2, unnest(string_split(main2 || '|' || alt2 || coalesce('|' || local2, ''), '|')) FROM mapping)),
scan_sets AS (
  SELECT * FROM name_sets UNION SELECT DISTINCT iso3, 1, unnest(['Hong Kong', 'Macau']) FROM mapping WHERE iso3 = 'CHN')"""

_N = "(user_id % 25)"
_RAWB = f"""raw_b AS (
  SELECT event_id, {case_codes(_N, SPECIAL_CODES_B)} AS iso_raw, 'Nation ' || {_N} AS country_raw, year(ts)::INT AS year,
    CASE event_id % 4
      WHEN 0 THEN 'Flood - nation_' || {_N} || ' - ' || seg || ' 20240101'
      WHEN 1 THEN 'Storm in Great Nat ' || {_N} || ', ' || seg || '/household'
      WHEN 2 THEN 'Quake near Nat ' || {_N} || '0 and x' || seg || 'x'
      ELSE CASE WHEN {_N} < 2 THEN 'Storm at Hong Kong/Macau' ELSE 'Land ' || {_N} || ': ' || seg END END AS text,
    ts::DATE AS start_date, CASE WHEN event_id % 6 <> 0 THEN floor(value)::BIGINT END AS displaced,
    event_type AS hazard, CASE WHEN event_id % 2 = 0 THEN event_type END AS hazard_sub,
    CASE event_id % 3 WHEN 0 THEN 'FL-' || (event_id // 3 % 5000) || '-ABC:Glide Number; x:' || event_id || ':IFRC Appeal ID'
      WHEN 1 THEN 'loc' || event_id || ':Local Identifier' END AS codes
  FROM (SELECT *, ['automobile', 'Old building town', 'furniture', 'household', 'OLD MACHINERY TOWN'][event_id % 5 + 1] AS seg FROM events))"""

_IND_VALUES = ", ".join(
    f"CASE WHEN (o_orderkey + {i}) % 9 = 0 THEN ' ' WHEN (o_orderkey + {i}) % 23 = 0 THEN 'n/a' ELSE (o_orderkey * {i} % 1000)::VARCHAR END AS {v}"
    for names in (INDEX_VARIABLES, AREA_VARIABLES) for i, v in enumerate(names, 1)
)
_M = "((n_nationkey + 5) % 25)"
_IND = f"""raw_ind AS (
  SELECT o_orderkey AS seq, 'R0' || r_regionkey AS iso_code, r_name AS country, CASE WHEN o_orderkey % 3 <> 0 THEN 'World' END AS continent,
    CASE WHEN o_orderkey % 20 = 0 THEN 'National' ELSE 'Subnat' END AS level, 'R0' || r_regionkey || 'r' || n_nationkey AS GDLCODE,
    CASE o_orderkey % 8 WHEN 0 THEN 'NATION_' || n_nationkey WHEN 1 THEN 'NATION_' || n_nationkey || ' and NATION_' || {_M}
      WHEN 2 THEN 'Central (NATION_' || n_nationkey || ' NATION_' || {_M} || ')' WHEN 3 THEN 'County of NATION_' || n_nationkey
      WHEN 4 THEN 'II- NATION_' || n_nationkey || ' Region' WHEN 5 THEN 'North, BUILDING, Lowest 25%'
      WHEN 6 THEN 'Group (NATION_' || n_nationkey || ', incl. Atlantis ' || (o_orderkey % 97) || ')'
      ELSE 'Nation ' || n_nationkey || ', NATION_' || ((n_nationkey + 1) % 25) END AS region,
    year(o_orderdate)::INT AS year, 'SHDI_' || (o_orderkey % 2) || '.csv' AS source_file,
    'I' || r_regionkey AS ISO2, n_nationkey::VARCHAR AS iso_num, CASE WHEN o_orderkey % 2 = 0 THEN 'survey' END AS datasource, {_IND_VALUES}
  FROM order_places),
placed AS (
  SELECT *, CASE WHEN level = 'National' THEN [iso_code] ELSE {extract_places('region')} END AS places FROM raw_ind),
exploded AS (
  SELECT *, unnest(places) AS place, unnest(range(len(places))) AS pos FROM placed),
located AS (
  SELECT e.*, CASE WHEN level = 'National' THEN iso_code ELSE g.gid END AS gid,
    CASE WHEN level = 'National' THEN 0 ELSE g.admin_level END AS admin_level,
    CASE WHEN level <> 'National' AND len(places) <> 1 THEN 'Extracted from: ' || region END AS note
  FROM exploded e LEFT JOIN gaz_best g ON e.iso_code = g.iso3 AND {normalize('place')} = g.norm_name)"""

_DISP = f"""raw_disp AS (
  SELECT o_orderkey AS seq, {case_codes('n_nationkey', DISPLACED_CODES)} AS iso, n_name AS name, CASE WHEN o_orderkey % 40 <> 0 THEN year(o_orderdate) END AS year,
    'book_sheet' || (o_orderkey % 2) AS source_file,
    CASE WHEN (o_orderkey + 1) % 3 <> 0 THEN (o_orderkey % 1000)::DOUBLE END AS d1,
    CASE WHEN (o_orderkey + 2) % 3 <> 0 THEN (o_orderkey * 2 % 1000)::DOUBLE END AS d2,
    CASE WHEN (o_orderkey + 3) % 3 <> 0 THEN (o_orderkey * 3 % 1000)::DOUBLE END AS d3
  FROM order_places),
raw_grp AS (
  SELECT o_orderkey AS seq, {case_codes('n_nationkey', DISPLACED_CODES)} AS iso, n_name AS country,
    CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' END AS sex, CASE WHEN o_orderpriority < '3' THEN 'Conflict' ELSE 'Disaster' END AS cause,
    year(o_orderdate) AS year, 'book_groups' AS source_file,
    {", ".join(f"CASE WHEN (o_orderkey + {i}) % 4 <> 0 THEN (o_orderkey * {i} % 1000)::DOUBLE END AS g{i}" for i in range(1, 6))}
  FROM order_places)"""

# definition, and what it needs before it
PARTS: dict[str, tuple[str, list[str]]] = {
    "order_places": (_OP, []),
    "obs1": (_OBS1, []),
    "obs": (_OBS, ["obs1"]),
    "catalog": (_CATALOG, []),
    "layer": (_LAYER, []),
    "units": (_UNITS, ["layer"]),
    "gaz": (_GAZ, ["units"]),
    "ev_a": (_EVA, ["order_places"]),
    "ev_b": (_EVB, []),
    "codes": (_CODES, ["ev_a", "ev_b"]),
    "ev": (_MERGED, ["codes"]),
    "coverage": (_COV, []),
    "cells": (_CELLS, []),
    "bands": (_BANDS, []),
    "classes": (_CLASSES, ["coverage"]),
    "mapping": (_MAPPING, []),
    "raw_b": (_RAWB, []),
    "indicators": (_IND, ["order_places", "gaz"]),
    "displacement": (_DISP, ["order_places"]),
}

ISO_REMAP = "CASE {x} WHEN 'XKX' THEN 'XKO' WHEN 'AB9' THEN 'SDN' WHEN 'HKG' THEN 'CHN' WHEN 'MAC' THEN 'CHN' ELSE {x} END"
GRIDDED = in_list(GRID_DATASETS)


def with_(*names: str) -> str:
    """``WITH`` clause of the named parts and everything they need, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in PARTS[name][1]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(PARTS[n][0] for n in order) + "\n"
