"""Quality and coverage reports (V rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.operators.keys import key_violations
from atlasweave.plans import reports
from atlasweave.schemas import GRID_DATASETS, NAMED_DATASETS, TABLES
from atlasweave.session import stored
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import in_list, with_


@query("v1_event_matching", with_("ev") + """
SELECT metric, value::DOUBLE AS value FROM (
  SELECT 'total_a' AS metric, count(*) AS value FROM ev_a UNION ALL SELECT 'a_with_code', count(*) FROM ev_a WHERE len(glide) > 0
  UNION ALL SELECT 'a_without_code', count(*) FROM ev_a WHERE coalesce(len(glide), 0) = 0 UNION ALL SELECT 'total_b', count(*) FROM ev_b
  UNION ALL SELECT 'b_with_code', count(*) FROM ev_b WHERE len(glide) > 0 UNION ALL SELECT 'b_without_code', count(*) FROM ev_b WHERE coalesce(len(glide), 0) = 0
  UNION ALL SELECT 'b_with_places', count(*) FROM ev_b WHERE len(admin_level_1) > 0 OR len(admin_level_2) > 0
  UNION ALL SELECT 'b_places_pct', round(100.0::DOUBLE * count(*) FILTER (len(admin_level_1) > 0 OR len(admin_level_2) > 0) / count(*), 1) FROM ev_b
  UNION ALL SELECT 'b_matched', count(DISTINCT b_id) FROM code_pairs UNION ALL SELECT 'b_unmatched', (SELECT count(*) FROM ev_b) - count(DISTINCT b_id) FROM code_pairs
  UNION ALL SELECT 'total_merged', count(*) FROM ev UNION ALL SELECT 'source_' || coalesce(source, 'NULL'), count(*) FROM ev GROUP BY source)""")
def v1(spark, d):
    return reports.event_matching(t.events_a(spark, d), t.events_b(spark, d), t.events(spark, d))


def _complete_sql() -> str:
    rows = []
    for c in reports.EVENT_COLUMNS:
        cond = f"len({c}) > 0" if c in ("admin_level_1", "admin_level_2", "glide") else f"{c} IS NOT NULL"
        rows.append(f"SELECT source, '{c}' AS column_name, count(*) AS total, count(*) FILTER ({cond}) AS non_null FROM ev GROUP BY source")
    return with_("ev") + ", c AS (" + " UNION ALL ".join(rows) + """)
SELECT subset, column_name, total, non_null, round(100.0::DOUBLE * non_null / total, 1) AS pct FROM (
  SELECT source AS subset, column_name, total, non_null FROM c UNION ALL SELECT 'ALL', column_name, sum(total)::BIGINT, sum(non_null)::BIGINT FROM c GROUP BY column_name)"""


@query("v2_completeness", _complete_sql())
def v2(spark, d):
    return reports.event_completeness(t.events(spark, d))


@query("v3_grid_completeness", with_("obs") + f"""
SELECT dataset, count(*) AS records, round(coalesce(avg(missing_value_percentage), 0), 4) AS avg_missing, round(coalesce(quantile_cont(missing_value_percentage, 0.5), 0), 4) AS median_missing,
  count(*) FILTER (missing_value_percentage < 10) AS under_10, count(*) FILTER (missing_value_percentage < 30) AS under_30, count(DISTINCT variable) AS n_variables, count(DISTINCT gid) AS n_units
FROM obs WHERE dataset IN {in_list(GRID_DATASETS)} GROUP BY dataset""")
def v3(spark, d):
    return reports.grid_completeness(t.observations(spark, d)).withColumns(
        {c: F.round(c, 4) for c in ("avg_missing", "median_missing")})


@query("v4_named_completeness", with_("obs") + f"""
SELECT dataset, count(*) AS records, count(DISTINCT variable) AS n_variables, count(DISTINCT gid) AS n_units, count(raw_value) AS with_value FROM obs WHERE dataset IN {in_list(NAMED_DATASETS)} GROUP BY dataset""")
def v4(spark, d):
    return reports.named_completeness(t.observations(spark, d))


@query("v5_temporal_coverage", with_("ev", "obs") + """
SELECT 'events' AS table_name, min(start_date) AS min_date, max(start_date) AS max_date, count(DISTINCT start_date) AS n_dates, count(DISTINCT iso3_code) AS n_units FROM ev
UNION ALL SELECT dataset, min(date), max(date), count(DISTINCT date), count(DISTINCT gid) FROM obs GROUP BY dataset""")
def v5(spark, d):
    return reports.temporal_coverage(t.events(spark, d), t.observations(spark, d))


@query("v6_integrity", with_("ev", "obs", "units") + """
SELECT 'events_total' AS metric, count(*) AS value FROM ev UNION ALL SELECT 'events_valid_country', count(*) FROM ev WHERE iso3_code IN (SELECT iso3 FROM units WHERE admin_level = 0)
UNION ALL SELECT 'distinct_variables', count(DISTINCT variable) FROM obs""")
def v6(spark, d):
    return reports.referential_integrity(t.events(spark, d), t.units(spark, d), t.observations(spark, d))


@query("v7_consistency", with_("codes") + """
, per_code AS (SELECT a.code, count(DISTINCT a.iso3_code) + count(DISTINCT b.iso3_code) AS n FROM codes_a a JOIN codes_b b USING (code) GROUP BY a.code)
SELECT 'total_pairs' AS metric, count(*) AS value FROM country_pairs UNION ALL SELECT 'same_type', count(*) FROM country_pairs WHERE a_type = b_type
UNION ALL SELECT 'same_year', count(*) FROM country_pairs WHERE a_year = b_year UNION ALL SELECT 'shared_codes', count(*) FROM per_code
UNION ALL SELECT 'multi_country_codes', count(*) FROM per_code WHERE n > 2""")
def v7(spark, d):
    return reports.consistency(t.events_a(spark, d), t.events_b(spark, d))


@query("v7_mismatch_top", with_("codes") + """
SELECT a_type, b_type, count(*) AS n_pairs FROM country_pairs WHERE a_type <> b_type GROUP BY ALL ORDER BY n_pairs DESC, a_type, b_type LIMIT 10""")
def v7_top(spark, d):
    return reports.type_mismatches(t.events_a(spark, d), t.events_b(spark, d))


@query("v8_country_top", with_("ev") + """
SELECT iso3_code, max(admin_level_0) AS country_name, count(*) AS event_count, count(DISTINCT disaster_type) AS hazard_types, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources
FROM ev WHERE iso3_code IS NOT NULL GROUP BY iso3_code ORDER BY event_count DESC, iso3_code LIMIT 20""")
def v8(spark, d):
    return reports.top_countries(t.events(spark, d))


@query("v12_hazard_variety", with_("ev") + """
SELECT iso3_code, max(admin_level_0) AS country_name, count(*) AS event_count, count(DISTINCT disaster_type) AS hazard_types, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources
FROM ev WHERE iso3_code IS NOT NULL GROUP BY iso3_code ORDER BY event_count DESC, iso3_code LIMIT 30""")
def v12(spark, d):
    return reports.top_countries(t.events(spark, d), k=30)


@query("v8_countries_by_source", with_("ev") + """
SELECT 'ALL' AS source, count(DISTINCT iso3_code) AS countries, count(*) AS events FROM ev UNION ALL SELECT coalesce(source, 'NULL'), count(DISTINCT iso3_code), count(*) FROM ev GROUP BY source""")
def v8_sources(spark, d):
    return reports.countries_by_source(t.events(spark, d))


@query("v9_type_distribution", with_("ev") + """
SELECT 'group' AS section, coalesce(disaster_group, '[not classified]') AS name, NULL AS subtype, count(*) AS events, NULL::BIGINT AS countries FROM ev GROUP BY disaster_group
UNION ALL SELECT 'type', coalesce(disaster_type, '[null]'), NULL, count(*), count(DISTINCT iso3_code) FROM ev GROUP BY disaster_type
UNION ALL (SELECT 'subtype', coalesce(disaster_type, '[null]') AS n, coalesce(disaster_subtype, '[null]') AS s, count(*) AS c, NULL FROM ev GROUP BY disaster_type, disaster_subtype ORDER BY c DESC, n, s LIMIT 25)""")
def v9(spark, d):
    return reports.type_distribution(t.events(spark, d))


@query("v10_obs_coverage", with_("obs") + """
SELECT dataset, count(*) AS records, count(DISTINCT substr(gid, 1, 3)) AS countries, string_agg(DISTINCT admin_level::VARCHAR, ', ' ORDER BY admin_level::VARCHAR) AS levels, count(DISTINCT gid) AS n_units FROM obs GROUP BY dataset""")
def v10(spark, d):
    return reports.observation_coverage(t.observations(spark, d))


@query("v13_key_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def v13(spark, d):
    return key_violations(t.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("v14_constraint_violations", with_("units", "ev") + """
SELECT * FROM (
  SELECT 'admin_units' AS table_name, 'gid is null' AS rule, count(*) FILTER (gid IS NULL) AS violations FROM units
  UNION ALL SELECT 'admin_units', 'iso3 is null', count(*) FILTER (iso3 IS NULL) FROM units UNION ALL SELECT 'admin_units', 'admin_level is null', count(*) FILTER (admin_level IS NULL) FROM units
  UNION ALL SELECT 'admin_units', 'name is null', count(*) FILTER (name IS NULL) FROM units UNION ALL SELECT 'admin_units', 'iso3 longer than 3', count(*) FILTER (length(iso3) > 3) FROM units
  UNION ALL SELECT 'admin_units', 'gid longer than 20', count(*) FILTER (length(gid) > 20) FROM units UNION ALL SELECT 'admin_units', 'name longer than 100', count(*) FILTER (length(name) > 100) FROM units
  UNION ALL SELECT 'events', 'event_id is null', count(*) FILTER (event_id IS NULL) FROM ev UNION ALL SELECT 'events', 'event_name longer than 255', count(*) FILTER (length(event_name) > 255) FROM ev
  UNION ALL SELECT 'events', 'iso3_code longer than 3', count(*) FILTER (length(iso3_code) > 3) FROM ev
  UNION ALL SELECT 'admin_units', 'parent missing', count(*) FROM units u WHERE admin_level > 0 AND NOT EXISTS (SELECT 1 FROM units p WHERE p.gid = u.parent_gid AND p.admin_level = u.admin_level - 1))""")
def v14(spark, d):
    units = stored(t.units(spark, d), "units")
    parents = reports.parent_violations(units).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("admin_units").alias("table_name"), F.lit("parent missing").alias("rule"), "violations")
    return (
        reports.constraint_violations(units, TABLES["admin_units"], "admin_units")
        .unionByName(reports.constraint_violations(t.events(spark, d), TABLES["events"], "events"))
        .unionByName(parents))


@query("v17_report_union", with_("obs") + """
SELECT 'coverage' AS section, count(DISTINCT dataset) AS lines, NULL::VARCHAR AS error FROM obs
UNION ALL SELECT 'broken', 0, 'AnalysisException' UNION ALL SELECT 'overlap', 1, NULL""")
def v17(spark, d):
    """Lines per section of a report, one section of which fails."""
    obs, ev = t.observations(spark, d), t.events(spark, d)
    report = reports.run_sections(spark, {
        "coverage": lambda: reports.observation_coverage(obs),
        "broken": lambda: obs.select("no_such_column"),
        "overlap": lambda: reports.country_overlap(ev, obs),
    })
    return report.groupBy("section").agg(F.count("line").alias("lines"), F.max("error").alias("error"))
