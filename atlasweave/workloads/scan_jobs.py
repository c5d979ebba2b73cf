"""Scans and sinks (S rows of the inventory)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from atlasweave.functions import dates
from atlasweave.operators.keys import insert_ignore, keep_first, key_violations, upsert
from atlasweave.plans.reports import constraint_violations
from atlasweave.schemas import TABLES
from atlasweave.session import scratch_path, stored
from atlasweave.sources import scans, sinks, upsert_log
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import lit, with_


@query("s1_scan_source_file", """
SELECT 'lineitem.parquet' AS source_file, l_returnflag, count(*) AS n_rows, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL""")
def s1(spark, d):
    rows = scans.read_tables(spark, d, contains="LINE", fmt="parquet")
    return rows.groupBy("source_file", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
    )


@query("s2_union_by_name", """
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def s2(spark, d):
    c = t.table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = t.table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s, allowMissingColumns=True)


@query("s3_tagged_scan", """
SELECT 'orders_2024_sheet1' AS source_file, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL""")
def s3(spark, d):
    rows = scans.read_sheet(spark, f"{d}/orders.parquet", "orders_2024", "sheet1")
    return rows.groupBy("source_file", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


def feature_lines(spark, d):
    """One GeoJSON collection per supplier, as text."""
    s = F.col("s_suppkey")
    ring = F.col("rings")[0]["points"]
    coords = F.array(F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    shaped = t.table(spark, d, "supplier").select(
        "*", t.shape_rings("0", "CAST(s_suppkey % 30 AS DOUBLE)", "CAST(s_suppkey % 20 AS DOUBLE)", "2.0D", "1.0D").alias("rings"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            (2000 + s % 20).cast("int").alias("year"), F.concat(F.lit("G"), s.cast("string")).alias("GID_1"),
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("ISO"), F.col("s_acctbal").alias("PWD_G"),
            F.col("s_name").alias("Adm_N"), (s % 30).cast("double").alias("lon"), (s % 20).cast("double").alias("lat"),
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
    )
    return shaped.select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("value"))


FEATURE_DDL = "year:int,GID_1:string,ISO:string,PWD_G:double,Adm_N:string,lon:double,lat:double"


def features(spark, d):
    path = scratch_path(spark, "features")
    feature_lines(spark, d).write.text(path)
    return scans.read_features(spark, path, FEATURE_DDL, one_per_line=True)


@query("s4_geojson_features", """
SELECT 'G' || s_suppkey AS GID_1, (2000 + s_suppkey % 20)::INT AS year, s_acctbal AS PWD_G, 5 AS n_points,
  (s_suppkey % 30 + 2)::DOUBLE AS max_x, (s_suppkey % 20 + 1)::DOUBLE AS max_y FROM supplier""")
def s4(spark, d):
    pts = F.col("rings")[0]["points"]
    return features(spark, d).select(
        "GID_1", "year", "PWD_G", F.size(pts).alias("n_points"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("max_x"), F.array_max(F.transform(pts, lambda p: p["y"])).alias("max_y"))


@query("s5_boundary_level", with_("units") + "SELECT gid, admin_level FROM units WHERE admin_level = 1")
def s5(spark, d):
    path = scratch_path(spark, "units")
    sinks.append_table(t.units(spark, d), path, ["admin_level"])
    level = scans.boundary_level(spark.read.parquet(path), 1)
    return level.select("gid", F.lit(1).alias("admin_level"))


@query("s6_grid_scan", with_("cells") + """
SELECT variable, coalesce(unit, 'unknown') AS unit, count(*) AS n_cells, count(value) AS n_values, round(sum(value), 4) AS total FROM hourly GROUP BY ALL""")
def s6(spark, d):
    return scans.grid_cells(t.hourly_cells(spark, d)).groupBy("variable", "unit").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_values"), F.round(F.sum("value"), 4).alias("total"))


@query("s7_band_scan", with_("bands") + """
SELECT quality, count(*) AS n_cells, sum(red)::BIGINT AS red, sum(nir)::BIGINT AS nir FROM bands GROUP BY ALL""")
def s7(spark, d):
    return t.bands(spark, d).groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum("red").alias("red"), F.sum("nir").alias("nir"))


@query("s8_date_from_path", """
SELECT CASE WHEN o_orderkey % 10 <> 0 THEN make_date(year(o_orderdate), 1, 1) END AS date, count(*) AS n_files FROM orders GROUP BY ALL""")
def s8(spark, d):
    k = F.col("o_orderkey")
    folder = F.when(k % 10 != 0, F.year("o_orderdate").cast("string")).otherwise(F.lit("misc"))
    path = F.concat(F.lit("/grids/"), folder, F.lit("/cell_"), k.cast("string"), F.lit(".tif"))
    return t.table(spark, d, "orders").groupBy(dates.date_from_path(path).alias("date")).agg(F.count(F.lit(1)).alias("n_files"))


@query("s9_date_from_name", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS date FROM orders""")
def s9(spark, d):
    k = F.col("o_orderkey")
    name = (
        F.when(k % 3 == 0, F.concat(F.lit("MOD."), F.date_format("o_orderdate", "'A'yyyyDDD"), F.lit(".006.hdf")))
        .when(k % 3 == 1, F.concat(F.lit("daily."), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".nc4")))
        .otherwise(F.lit("readme.txt")))
    return t.table(spark, d, "orders").select("o_orderkey", dates.date_from_name(name).alias("date"))


@query("s10_variable_from_name", """
SELECT CASE p_partkey % 3 WHEN 0 THEN 'population_sex_age_f_' || p_size || '_count'
  WHEN 1 THEN '2021_2022_population_sex_age_t_m_' || p_size || '_count' END AS variable, count(*) AS n_files
FROM part WHERE p_partkey % 3 < 2 GROUP BY ALL""")
def s10(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    name = (
        F.when(k % 3 == 0, F.concat(F.lit("global_f_"), size, F.lit("_2010_1km.tif")))
        .when(k % 3 == 1, F.concat(F.lit("global_t_m_"), size, F.lit("_2022_1km.tif")))
        .otherwise(F.concat(F.lit("x_"), size, F.lit(".tif"))))
    return (
        t.table(spark, d, "part").select(dates.variable_from_name(name).alias("variable"))
        .where(F.col("variable").isNotNull()).groupBy("variable").agg(F.count(F.lit(1)).alias("n_files")))


_CODES = scans.VARIABLE_CODES["climate"]


@query("s11_variable_map", f"""
SELECT CASE WHEN code = 'tp' THEN {lit(_CODES['tp'])} WHEN code = 't2m' THEN {lit(_CODES['t2m'])} WHEN code = 'ssr' THEN {lit(_CODES['ssr'])} ELSE code END AS variable, count(*) AS n_rows
FROM (SELECT CASE event_type WHEN 'view' THEN 'tp' WHEN 'click' THEN 't2m' WHEN 'error' THEN 'ssr' ELSE event_type END AS code FROM events) GROUP BY ALL""")
def s11(spark, d):
    code = F.when(F.col("event_type") == "view", "tp").when(F.col("event_type") == "click", "t2m").when(
        F.col("event_type") == "error", "ssr").otherwise(F.col("event_type"))
    coded = t.table(spark, d, "events").select(code.alias("code"))
    return scans.name_variables(coded, "code", _CODES).groupBy("variable").agg(F.count(F.lit(1)).alias("n_rows"))


@query("s13_insert_ignore", with_("ev_a") + """
, incoming AS (SELECT event_id, disaster_type, iso3_code, start_date FROM ev_a WHERE event_id % 3 <> 0),
existing AS (SELECT disaster_type, iso3_code, start_date FROM ev_a WHERE event_id % 3 = 0)
SELECT event_id, disaster_type, iso3_code, start_date FROM (
  SELECT *, row_number() OVER (PARTITION BY disaster_type, iso3_code, start_date ORDER BY event_id) AS rn FROM incoming) i
WHERE disaster_type IS NULL OR iso3_code IS NULL OR start_date IS NULL OR (rn = 1 AND NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.disaster_type = i.disaster_type AND e.iso3_code = i.iso3_code AND e.start_date = i.start_date))""")
def s13(spark, d):
    ev = t.events_a(spark, d).select("event_id", "disaster_type", "iso3_code", "start_date")
    return insert_ignore(
        ev.where("event_id % 3 = 0"), ev.where("event_id % 3 <> 0"), ["disaster_type", "iso3_code", "start_date"], ["event_id"])


@query("s14_upsert_last_wins", """
WITH old AS (SELECT o_custkey, o_orderstatus, o_totalprice AS raw_value, o_orderpriority AS note FROM orders WHERE o_orderkey % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1),
new AS (SELECT o_custkey, o_orderstatus, arg_max(o_totalprice, o_orderkey) AS raw_value, arg_min(o_orderpriority, o_orderkey) AS note
  FROM orders WHERE o_orderkey % 2 = 1 GROUP BY ALL)
SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(o.o_orderstatus, n.o_orderstatus) AS o_orderstatus,
  coalesce(n.raw_value, o.raw_value) AS raw_value, coalesce(o.note, n.note) AS note
FROM old o FULL JOIN new n ON o.o_custkey = n.o_custkey AND o.o_orderstatus = n.o_orderstatus""")
def s14(spark, d):
    rows = t.table(spark, d, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("raw_value"), F.col("o_orderpriority").alias("note"), "o_orderkey")
    key = ["o_custkey", "o_orderstatus"]
    existing = keep_first(rows.where("o_orderkey % 2 = 0"), key, ["o_orderkey"]).drop("o_orderkey")
    return upsert(existing, rows.where("o_orderkey % 2 = 1"), key, ["raw_value"], ["o_orderkey"])


def _upserted(old: str, *batches: str) -> str:
    """Rows of ``old`` (no key twice) after the batches: the last batch's value, the first note."""
    key = "o_custkey, o_orderstatus"
    reduced = ", ".join(
        f"n{i} AS (SELECT {key}, arg_max(o_totalprice, o_orderkey) AS raw_value, arg_min(o_orderpriority, o_orderkey) AS note FROM orders WHERE {b} GROUP BY ALL)"
        for i, b in enumerate(batches))
    names = [f"n{i}" for i in range(len(batches))]
    joins = " ".join(f"FULL JOIN {n} USING ({key})" for n in names)
    return f"""
WITH old AS (SELECT {key}, o_totalprice AS raw_value, o_orderpriority AS note FROM orders WHERE {old}
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY o_orderkey) = 1), {reduced}
SELECT {key}, coalesce({", ".join(f"{n}.raw_value" for n in reversed(names))}, old.raw_value) AS raw_value,
  coalesce(old.note, {", ".join(f"{n}.note" for n in names)}) AS note FROM old {joins}"""


@query("s14_upsert_log", _upserted("o_orderkey % 4 = 0", "o_orderkey % 4 = 1", "o_orderkey % 4 = 2", "o_orderkey % 4 = 3"))
def s14_log(spark, d):
    """Four batches logged one after another, compacted in between, merged when read."""
    key, target = ["o_custkey", "o_orderstatus"], scratch_path(spark, "upsert-log")
    rows = t.table(spark, d, "orders").select(
        *key, F.col("o_totalprice").alias("raw_value"), F.col("o_orderpriority").alias("note"), "o_orderkey")
    first = keep_first(rows.where("o_orderkey % 4 = 0"), key, ["o_orderkey"])
    upsert_log.append(first, target, key, ["raw_value"], ["o_orderkey"])
    for batch in (1, 2, 3):
        upsert_log.append(rows.where(f"o_orderkey % 4 = {batch}"), target, key, ["raw_value"], ["o_orderkey"])
        if batch == 2:
            upsert_log.compact(spark, target, key)
    return upsert_log.current(spark, target, key).drop("o_orderkey")


@query("s13_load_insert_ignore", with_("ev_a") + """
, mine AS (SELECT event_id, disaster_type, iso3_code, start_date FROM ev_a),
incoming AS (SELECT * FROM mine WHERE event_id % 3 <> 0), existing AS (SELECT * FROM mine WHERE event_id % 3 = 0)
SELECT * FROM existing UNION ALL
SELECT event_id, disaster_type, iso3_code, start_date FROM (
  SELECT *, row_number() OVER (PARTITION BY disaster_type, iso3_code, start_date ORDER BY event_id) AS rn FROM incoming) i
WHERE disaster_type IS NULL OR iso3_code IS NULL OR start_date IS NULL OR (rn = 1 AND NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.disaster_type = i.disaster_type AND e.iso3_code = i.iso3_code AND e.start_date = i.start_date))""")
def s13_load(spark, d):
    """A table after rows with new keys were appended to its files."""
    ev = stored(t.events_a(spark, d).select("event_id", "disaster_type", "iso3_code", "start_date"), "events")
    target = scratch_path(spark, "events-table")
    sinks.append_table(ev.where("event_id % 3 = 0"), target)
    sinks.load_insert_ignore(
        spark, target, ev.where("event_id % 3 <> 0"), ["disaster_type", "iso3_code", "start_date"], ["event_id"])
    return spark.read.parquet(target)


@query("s12_relation", "SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")
def s12(spark, d):
    """A table of the catalog, bucketed by its key, read by name: grouping by the key does not move its rows."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    sinks.write_bucketed(t.table(spark, d, "orders"), name, ["o_custkey"], 8, scratch_path(spark, name))
    return scans.read_relation(spark, name).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s16_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s16(spark, d):
    source = t.table(spark, d, "customer")
    path = scratch_path(spark, "csv")
    sinks.write_csv(source, path)
    return spark.read.option("header", True).schema(source.schema).csv(path)


@query("s17_month_partition", """
SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def s17(spark, d):
    path = scratch_path(spark, "monthly")
    sinks.write_monthly(t.table(spark, d, "orders"), "o_orderdate", path)
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s19_schema_conformance", with_("obs") + """
SELECT 'observations' AS table_name, rule, violations FROM (
  SELECT 'dataset is null' AS rule, count(*) FILTER (dataset IS NULL) AS violations FROM obs
  UNION ALL SELECT 'gid is null', count(*) FILTER (gid IS NULL) FROM obs
  UNION ALL SELECT 'admin_level is null', count(*) FILTER (admin_level IS NULL) FROM obs
  UNION ALL SELECT 'date is null', count(*) FILTER (date IS NULL) FROM obs
  UNION ALL SELECT 'variable is null', count(*) FILTER (variable IS NULL) FROM obs
  UNION ALL SELECT 'gid longer than 20', count(*) FILTER (length(gid) > 20) FROM obs
  UNION ALL SELECT 'variable longer than 100', count(*) FILTER (length(variable) > 100) FROM obs
  UNION ALL SELECT 'duplicate key', (SELECT count(*) FROM (SELECT 1 FROM obs GROUP BY dataset, gid, admin_level, date, variable HAVING count(*) > 1)))""")
def s19(spark, d):
    obs = t.observations(spark, d)
    rules = TABLES["observations"]
    duplicates = key_violations(obs, rules.key).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("observations").alias("table_name"), F.lit("duplicate key").alias("rule"), "violations")
    return constraint_violations(obs, rules, "observations").unionByName(duplicates)
