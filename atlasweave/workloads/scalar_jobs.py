"""Projections, predicates and scalar functions (P and F rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.functions import dates, geo, numbers, text
from atlasweave.operators.grids import index_boxes, rejected_units
from atlasweave.operators.reshape import renamed
from atlasweave.plans.views import category, selected_value
from atlasweave.session import stored
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import CATEGORY, GRIDDED, SELECTED, cell_area, extract_places, normalize, with_


def _join(arr, sep="|"):
    return F.array_join(arr, sep)


@query("p1_select_rename", "SELECT o_orderkey AS event_id, o_orderdate::DATE AS start_date, o_totalprice AS total_damage FROM orders")
def p1(spark, d):
    picked = t.table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return renamed(picked, {"o_orderkey": "event_id", "o_orderdate": "start_date", "o_totalprice": "total_damage"})


@query("p4_constants", "SELECT c_custkey, 'WorldPop' AS source, 1 AS admin_level, 'unitless' AS unit FROM customer")
def p4(spark, d):
    return t.table(spark, d, "customer").select(
        "c_custkey", F.lit("WorldPop").alias("source"), F.lit(1).alias("admin_level"), F.lit("unitless").alias("unit"))


@query("p5_unit_scale", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 1000
  WHEN o_orderpriority = '5-LOW' THEN o_totalprice * 1000000 ELSE o_totalprice END AS value FROM orders""")
def p5(spark, d):
    value = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return t.table(spark, d, "orders").select(
        "o_orderkey", numbers.scale_units(value, F.col("o_orderpriority"), {"1-URGENT": 1000, "5-LOW": 1000000}).alias("value"))


@query("p6_clean_label", """
SELECT p_partkey, replace(replace(lower(trim(replace(' ' || p_name || ', ' || p_type || ' (''000 US$)', '(''000 US$)', ''))), ', ', '_'), ' ', '_') AS label FROM part""")
def p6(spark, d):
    raw = F.concat(F.lit(" "), "p_name", F.lit(", "), "p_type", F.lit(" ('000 US$)"))
    return t.table(spark, d, "part").select("p_partkey", text.clean_label(raw).alias("label"))


@query("p7_safe_numeric", with_("indicators") + "SELECT seq, TRY_CAST(nullif(trim(shdi), '') AS DOUBLE) AS shdi, TRY_CAST(nullif(trim(pop), '') AS DOUBLE) AS pop FROM raw_ind")
def p7(spark, d):
    return t.raw_indicators(spark, d).select(
        "seq", numbers.safe_double(F.col("shdi")).alias("shdi"), numbers.safe_double(F.col("pop")).alias("pop"))


@query("p8_nullable_cast", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN trunc(o_totalprice / 10)::INT END AS total_deaths FROM orders")
def p8(spark, d):
    v = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") / 10)
    return t.table(spark, d, "orders").select("o_orderkey", numbers.nullable_int(v).alias("total_deaths"))


@query("p9_empty_to_null", with_("layer", "ev_a") + """
SELECT 'text' AS kind, nl_name_1 IS NULL OR nl_name_1 = '' AS is_null, count(*) AS n_rows FROM layer GROUP BY ALL
UNION ALL SELECT 'list', coalesce(len(admin_level_1), 0) = 0, count(*) FROM ev_a GROUP BY ALL""")
def p9(spark, d):
    a = t.flat_layer(spark, d).select(F.lit("text").alias("kind"), text.blank_to_null(F.col("nl_name_1")).isNull().alias("is_null"))
    b = t.events_a(spark, d).select(F.lit("list").alias("kind"), text.empty_to_null(F.col("admin_level_1")).isNull().alias("is_null"))
    return a.unionByName(b).groupBy("kind", "is_null").agg(F.count(F.lit(1)).alias("n_rows"))


@query("p10_dropna_any_all", with_("ev_a") + """
SELECT 'any' AS mode, event_id FROM ev_a WHERE iso3_code IS NOT NULL AND disaster_type IS NOT NULL
UNION ALL SELECT 'all', event_id FROM ev_a WHERE total_deaths IS NOT NULL OR number_affected IS NOT NULL""")
def p10(spark, d):
    ev = t.events_a(spark, d)
    any_ = ev.dropna(how="any", subset=["iso3_code", "disaster_type"]).select(F.lit("any").alias("mode"), "event_id")
    all_ = ev.dropna(how="all", subset=["total_deaths", "number_affected"]).select(F.lit("all").alias("mode"), "event_id")
    return any_.unionByName(all_)


@query("p11_array_nonempty", with_("ev_a") + "SELECT event_id FROM ev_a WHERE len(admin_level_1) > 0")
def p11(spark, d):
    return t.events_a(spark, d).where(text.nonempty(F.col("admin_level_1"))).select("event_id")


@query("p12_array_contains", with_("ev_a") + "SELECT event_id FROM ev_a WHERE list_contains(admin_level_2, 'Building')")
def p12(spark, d):
    return t.events_a(spark, d).where(F.array_contains("admin_level_2", "Building")).select("event_id")


@query("p14_selected_value", with_("obs") + f"SELECT dataset, gid, date, variable, round({SELECTED}, 4) AS selected_value FROM obs")
def p14(spark, d):
    return t.observations(spark, d).select(
        "dataset", "gid", "date", "variable", F.round(selected_value(F.col("dataset"), F.col("variable")), 4).alias("selected_value"))


@query("p15_category", with_("obs") + f"SELECT {CATEGORY} AS category, dataset, count(*) AS n_rows FROM obs GROUP BY ALL")
def p15(spark, d):
    return t.observations(spark, d).groupBy(category(F.col("dataset"), F.col("variable")).alias("category"), "dataset").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("p16_coalesce_defaults", with_("obs") + f"""
SELECT dataset, coalesce(CASE WHEN dataset IN {GRIDDED} THEN coalesce(unit, 'N/A') END, '-') AS unit, count(*) AS n_rows,
  round(sum(CASE WHEN dataset IN {GRIDDED} THEN coalesce(missing_value_percentage, 0) END), 2) AS missing FROM obs GROUP BY ALL""")
def p16(spark, d):
    from atlasweave.plans.views import with_defaults

    return with_defaults(t.observations(spark, d)).groupBy("dataset", F.coalesce("unit", F.lit("-")).alias("unit")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("missing_value_percentage"), 2).alias("missing"))


@query("p18_iso3_prefix", with_("obs") + "SELECT substr(gid, 1, 3) AS iso3, count(*) AS n_rows FROM obs GROUP BY ALL")
def p18(spark, d):
    return t.observations(spark, d).groupBy(F.substring("gid", 1, 3).alias("iso3")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("p20_json_predicate", "SELECT event_id, user_id FROM events WHERE json_extract_string(props, '$.k') = '69'")
def p20(spark, d):
    return t.table(spark, d, "events").where(F.get_json_object("props", "$.k") == "69").select("event_id", "user_id")


@query("p21_quality_band", with_("obs") + """
SELECT dataset, CASE WHEN m IS NULL THEN 'unknown' WHEN m < 10 THEN 'good' WHEN m < 30 THEN 'usable' WHEN m > 50 THEN 'poor' ELSE 'partial' END AS band,
  count(*) AS n_rows FROM (SELECT dataset, missing_value_percentage AS m FROM obs) GROUP BY ALL""")
def p21(spark, d):
    return t.observations(spark, d).groupBy("dataset", numbers.quality_band(F.col("missing_value_percentage")).alias("band")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("p22_clamp_end_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE greatest(o_orderdate::DATE, (o_orderdate::DATE + (o_orderkey % 10 - 5)::INT)::DATE) END AS end_date FROM orders""")
def p22(spark, d):
    k, start = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    end = F.when(k % 13 != 0, F.date_add(start, (k % 10 - 5).cast("int")))
    return t.table(spark, d, "orders").select("o_orderkey", dates.clamp_end(start, end).alias("end_date"))


_F1 = """
SELECT o_orderkey, TRY_CAST(printf('%04d-%02d-%02d', y, coalesce(m, 1), coalesce(dd, 1)) AS DATE) AS start_date FROM (
  SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderkey % 7 <> 0 THEN month(o_orderdate) END AS m,
    CASE WHEN o_orderkey % 11 = 0 THEN 31 WHEN o_orderkey % 3 <> 0 THEN day(o_orderdate) END AS dd FROM orders)"""


@query("f1_partial_date", _F1)
def f1(spark, d):
    return t.raw_events_a(spark, d).select(
        F.col("event_id").alias("o_orderkey"),
        dates.partial_date(F.col("Start Year"), F.col("Start Month"), F.col("Start Day")).alias("start_date"))


@query("f2_year_to_date", "SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS date FROM orders")
def f2(spark, d):
    return t.table(spark, d, "orders").select("o_orderkey", dates.year_to_date(F.year("o_orderdate")).alias("date"))


@query("f4_parse_typed_codes", """
SELECT o_orderkey AS event_id, unnest(CASE o_orderkey % 4 WHEN 0 THEN ['GLIDE', 'USGS'] WHEN 1 THEN ['GLIDE', 'GLIDE'] ELSE [] END) AS code_type,
  unnest(CASE o_orderkey % 4 WHEN 0 THEN ['FL-' || (o_orderkey // 4 % 5000), 'us:' || o_orderkey] WHEN 1 THEN ['A-' || o_orderkey, 'B-' || o_orderkey] ELSE [] END) AS code_value
FROM orders""")
def f4(spark, d):
    return t.raw_events_a(spark, d).select("event_id", F.explode(text.typed_codes(F.col("External IDs"))).alias("c")).select(
        "event_id", "c.code_type", "c.code_value")


@query("f5_parse_code_type", """
SELECT event_id, unnest(CASE event_id % 3 WHEN 0 THEN ['Glide Number', 'IFRC Appeal ID'] WHEN 1 THEN ['Local Identifier'] ELSE [] END) AS code_type,
  unnest(CASE event_id % 3 WHEN 0 THEN ['FL-' || (event_id // 3 % 5000) || '-ABC', 'x:' || event_id] WHEN 1 THEN ['loc' || event_id] ELSE [] END) AS code_value
FROM events""")
def f5(spark, d):
    return t.raw_events_b(spark, d).select("event_id", F.explode(text.valued_codes(F.col("Event Codes (Code:Type)"))).alias("c")).select(
        "event_id", "c.code_type", "c.code_value")


_F6_CODE = "CASE event_id % 4 WHEN 0 THEN 'FL-2020-' || event_id || '-USA' WHEN 1 THEN 'FL-2020-' || event_id WHEN 2 THEN 'nodash' END"


@query("f6_strip_suffix_flag", f"""
SELECT event_id, regexp_replace(code, '-[^-]*$', '') AS stripped, coalesce(NOT contains(code, '-') OR regexp_matches(code, '-\\p{{Lu}}{{3}}$'), true) AS valid_iso3,
  CASE WHEN code IS NULL THEN 'EQ-1' ELSE regexp_replace(code, '-[^-]*$', '') || '|EQ-1' END AS all_stripped,
  coalesce(NOT contains(code, '-') OR regexp_matches(code, '-\\p{{Lu}}{{3}}$'), true) AS all_valid
FROM (SELECT event_id, {_F6_CODE} AS code FROM events)""")
def f6(spark, d):
    k = F.col("event_id")
    code = (
        F.when(k % 4 == 0, F.concat(F.lit("FL-2020-"), k.cast("string"), F.lit("-USA")))
        .when(k % 4 == 1, F.concat(F.lit("FL-2020-"), k.cast("string"))).when(k % 4 == 2, F.lit("nodash")))
    many = F.array(code, F.lit("EQ-1-ABC"))
    return t.table(spark, d, "events").select(
        "event_id", text.strip_last_segment(code).alias("stripped"), text.has_iso3_suffix(code).alias("valid_iso3"),
        _join(text.strip_suffix_array(many)).alias("all_stripped"), text.all_iso3_suffix(many).alias("all_valid"))


_F7_OTHER = "CASE o_orderkey % 3 WHEN 0 THEN 'NATION_6' WHEN 1 THEN 'NATION_7' ELSE 'Elsewhere' END"


@query("f7_parse_units", with_("order_places") + f"""
SELECT o_orderkey AS event_id,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN n_nationkey = 3 THEN {_F7_OTHER} WHEN o_orderkey % 5 = 1 THEN 'Nat ' || n_nationkey ELSE '' END AS admin1,
  CASE WHEN o_orderkey % 5 = 0 OR n_nationkey = 3 THEN '' WHEN o_orderkey % 5 = 1 THEN lower(c_mktsegment)
    WHEN o_orderkey % 5 = 2 THEN 'Old ' || lower(c_mktsegment) || ' town|Unknown' ELSE '' END AS admin2
FROM order_places""")
def f7(spark, d):
    u = text.parse_units(F.col("Admin Units"))
    return t.raw_events_a(spark, d).select("event_id", _join(u["admin1"]).alias("admin1"), _join(u["admin2"]).alias("admin2"))


@query("f8_pipe_to_array", with_("layer") + """
SELECT gid_2, array_to_string(string_split(varname_1, '|'), ';') AS var_names, CASE WHEN nl_name_1 <> '' THEN nl_name_1 END AS nl_names FROM layer""")
def f8(spark, d):
    return t.flat_layer(spark, d).select(
        "gid_2", _join(text.pipe_to_array(F.col("varname_1")), ";").alias("var_names"),
        _join(text.pipe_to_array(F.col("nl_name_1")), ";").alias("nl_names"))


@query("f9_normalize_name", f"""
SELECT doc_id, md5({normalize('text')}) AS normalized, md5({normalize("translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'aaaaaaceeeeiiiinoooooouuuuyy')")}) AS folded FROM documents""")
def f9(spark, d):
    return t.table(spark, d, "documents").select(
        "doc_id", F.md5(text.normalize_name(F.col("text"))).alias("normalized"),
        F.md5(text.normalize_name(F.col("text"), fold_accents=True)).alias("folded"))


@query("f10_extract_places", with_("indicators") + f"""
SELECT seq, array_to_string({extract_places('region')}, '|') AS places,
  CASE WHEN len({extract_places('region')}) <> 1 THEN 'Extracted from: ' || region END AS note FROM raw_ind""")
def f10(spark, d):
    places = text.extract_places(F.col("region"))
    return t.raw_indicators(spark, d).select("seq", _join(places).alias("places"), text.extraction_note(F.col("region"), places).alias("note"))


@query("f11_event_name", with_("ev_a") + """
SELECT event_id, coalesce(iso3_code, 'UNKNOWN-ISO3-CODE') || '_' || coalesce(disaster_type, 'UNKNOWN-DISASTER-TYPE') || '_' || coalesce(disaster_subtype, 'UNKNOWN-DISASTER-SUBTYPE')
  || '_' || strftime(start_date, '%Y%m%d') || '_' || substr(sha256('EMDAT|' || event_id), 1, 8) AS event_name FROM ev_a""")
def f11(spark, d):
    label = text.event_label(
        F.col("iso3_code"), F.col("disaster_type"), F.col("disaster_subtype"), F.col("start_date"), [F.col("source"), F.col("event_id")])
    return t.events_a(spark, d).select("event_id", label.alias("event_name"))


@query("f12_pack_json", with_("ev_a") + """
SELECT event_id, '{' || '"event_name":"' || event_name || '"' || coalesce(',"disaster_type":"' || disaster_type || '"', '') || coalesce(',"total_deaths":' || total_deaths, '') || '}' AS metadata FROM ev_a""")
def f12(spark, d):
    return t.events_a(spark, d).select(
        "event_id", text.pack_json([F.col("event_name"), F.col("disaster_type"), F.col("total_deaths")]).alias("metadata"))


@query("f13_pack_json_nulls", with_("ev_a") + """
SELECT event_id, '{' || '"event_name":"' || event_name || '"' || coalesce(',"disaster_type":"' || disaster_type || '"', ',"disaster_type":null') || coalesce(',"total_deaths":' || total_deaths, ',"total_deaths":null') || '}' AS metadata FROM ev_a""")
def f13(spark, d):
    return t.events_a(spark, d).select(
        "event_id", text.pack_json([F.col("event_name"), F.col("disaster_type"), F.col("total_deaths")], keep_nulls=True).alias("metadata"))


@query("f17_cell_area", with_("cells") + f"""
SELECT lat_idx, count(*) AS n_cells, round(sum({cell_area('(lat_idx + 0.5) * 0.5')}) / 1e6, 3) AS area_km2 FROM hourly GROUP BY ALL""")
def f17(spark, d):
    area = geo.cell_area(F.col("lat"), t.GRID.dlat, t.GRID.dlon)
    return t.hourly_cells(spark, d).groupBy("lat_idx").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.sum(area) / 1e6, 3).alias("area_km2"))


@query("f18_normalized_difference", with_("bands") + """
SELECT date, count(*) AS n_cells, count(value) AS n_valid, round(sum(value), 4) AS total, round(min(value), 6) AS lo, round(max(value), 6) AS hi FROM band_cells GROUP BY ALL""")
def f18(spark, d):
    v = numbers.normalized_difference(F.col("red"), F.col("nir"), F.col("quality"))
    return t.bands(spark, d).select("date", v.alias("v")).groupBy("date").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("v").alias("n_valid"), F.round(F.sum("v"), 4).alias("total"),
        F.round(F.min("v"), 6).alias("lo"), F.round(F.max("v"), 6).alias("hi"))


@query("f21_short_uuid", "SELECT count(*) AS n_rows, count(*) AS n_hex, count(*) AS n_distinct FROM supplier")
def f21(spark, d):
    """Random ids: one a row, eight hexadecimal digits, none twice (a repetition among so few has a chance of 1 in 10,000 or less)."""
    ids = stored(t.table(spark, d, "supplier").select(text.short_uuid().alias("short_id")), "short-ids")
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("short_id").rlike("^[0-9a-f]{8}$")).alias("n_hex"),
                   F.countDistinct("short_id").alias("n_distinct"))


@query("f22_geometry_quality", """
SELECT 'S' || s_suppkey AS gid, CASE s_suppkey % 7 WHEN 0 THEN 'ring not closed' WHEN 1 THEN 'outside lon/lat range' WHEN 2 THEN 'no geometry' WHEN 3 THEN 'ring too short' WHEN 4 THEN 'coordinate not finite' END AS problem
FROM supplier WHERE s_suppkey % 7 < 5""")
def f22(spark, d):
    s = F.col("s_suppkey")
    broken = F.transform(
        "rings",
        lambda r: F.struct(
            r["hole"].alias("hole"),
            F.when(s % 7 == 0, F.slice(r["points"], 1, 4))
            .when(s % 7 == 1, F.transform(r["points"], lambda p: F.struct((p["x"] + 300).alias("x"), p["y"].alias("y"))))
            .when(s % 7 == 3, F.slice(r["points"], 1, 2))
            .when(s % 7 == 4, F.transform(r["points"], lambda p: F.struct(F.lit(float("nan")).alias("x"), p["y"].alias("y"))))
            .otherwise(r["points"]).alias("points"),
        ),
    )
    boxes = t.table(spark, d, "supplier").select(
        "s_suppkey", F.concat(F.lit("S"), s.cast("string")).alias("gid"),
        t.shape_rings("0", "CAST(s_suppkey % 30 AS DOUBLE)", "CAST(s_suppkey % 20 AS DOUBLE)", "2.0D", "1.0D").alias("rings"))
    return rejected_units(boxes.select("gid", F.when(s % 7 != 2, broken).alias("rings")))


@query("f23_bbox_buffer", with_("coverage") + """
SELECT gid, round(min(least(xa, xb)) - 1, 6) AS min_x, round(min(least(ya, yb)) - 1, 6) AS min_y, round(max(greatest(xa, xb)) + 1, 6) AS max_x, round(max(greatest(ya, yb)) + 1, 6) AS max_y
FROM edges GROUP BY gid""")
def f23(spark, d):
    b = index_boxes(t.shaped_units(spark, d), t.GRID)
    return b.select("gid", *[F.round(c, 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


