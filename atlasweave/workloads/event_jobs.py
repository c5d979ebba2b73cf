"""Event cleaning, merging and places (N1-N4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.plans import events as ev
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import case_codes, with_
from atlasweave.workloads.tables import SPECIAL_CODES

_ALIASES = """
, alias1 AS (SELECT iso3, alias, arg_min(main, seq) AS main FROM (
    SELECT iso3, seq, main1 AS main, unnest(list_concat([main1], string_split(alt1, '|'))) AS alias FROM mapping) GROUP BY ALL),
alias2 AS (SELECT iso3, alias, arg_min(main, seq) AS main FROM (
    SELECT iso3, seq, main2 AS main, unnest(list_concat([main2], string_split(alt2, '|'), coalesce(string_split(local2, '|'), []))) AS alias FROM mapping) GROUP BY ALL)"""


def _listed(column: str, alias: str, name: str) -> str:
    return f"""{name} AS (
  SELECT event_id, string_agg(coalesce(main, x), '|' ORDER BY pos) AS names FROM (
    SELECT event_id, iso3_code, unnest({column}) AS x, unnest(range(len({column}))) AS pos FROM mapped)
  LEFT JOIN {alias} ON iso3_code = iso3 AND x = alias GROUP BY event_id)"""


_K = "o_orderkey"
_OTHER = f"CASE {_K} % 3 WHEN 0 THEN 'NATION_6' WHEN 1 THEN 'NATION_7' ELSE 'Elsewhere' END"
_UNITS = f"""CASE WHEN {_K} % 5 = 0 THEN 'not a list' WHEN n_nationkey = 3 THEN '[{{''adm1_name'':''' || {_OTHER} || '''}}]'
    WHEN {_K} % 5 = 1 THEN '[{{''adm1_name'':''Nat ' || n_nationkey || '''}},{{''adm2_name'':''' || lower(c_mktsegment) || '''}}]'
    WHEN {_K} % 5 = 2 THEN '[{{"adm2_code": 5, "adm2_name": "Old ' || lower(c_mktsegment) || ' town"}}, {{"adm2_name": "Unknown"}}]' END"""
_N1 = with_("order_places", "mapping") + _ALIASES + f"""
, parts AS (
  SELECT {_K} AS event_id, n_nationkey AS n, n_name, r_name, o_totalprice, {_K} AS k, o_orderpriority, o_orderstatus,
    {case_codes('n_nationkey', SPECIAL_CODES)} AS iso, year(o_orderdate)::INT AS y,
    CASE WHEN {_K} % 7 <> 0 THEN month(o_orderdate) END AS sm, CASE WHEN {_K} % 11 = 0 THEN 31 WHEN {_K} % 3 <> 0 THEN day(o_orderdate) END AS sd,
    CASE WHEN {_K} % 2 = 0 THEN month(o_orderdate) END AS em, {_UNITS} AS units_text,
    CASE WHEN {_K} % 4 = 0 THEN 'GLIDE:FL-' || ({_K} // 4 % 5000) || '|USGS:us:' || {_K} || '|junk' WHEN {_K} % 4 = 1 THEN 'GLIDE:A-' || {_K} || '|GLIDE:B-' || {_K} END AS ids,
    CASE WHEN {_K} % 5 = 0 THEN [] WHEN n_nationkey = 3 THEN [{_OTHER}] WHEN {_K} % 5 = 1 THEN ['Nat ' || n_nationkey] ELSE [] END AS a1,
    CASE WHEN {_K} % 5 = 0 OR n_nationkey = 3 THEN [] WHEN {_K} % 5 = 1 THEN [lower(c_mktsegment)] WHEN {_K} % 5 = 2 THEN ['Old ' || lower(c_mktsegment) || ' town', 'Unknown'] ELSE [] END AS a2
  FROM order_places),
mapped AS (
  SELECT *, CASE iso WHEN 'HKG' THEN 'CHN' WHEN 'MAC' THEN 'CHN' WHEN 'ANT' THEN 'NLD' WHEN 'AB9' THEN 'SDN' WHEN 'XKK' THEN 'XKO'
      WHEN 'SCG' THEN CASE k % 3 WHEN 0 THEN 'SRB' WHEN 1 THEN 'MNE' END ELSE iso END AS iso3_code,
    CASE iso WHEN 'HKG' THEN 'China' WHEN 'MAC' THEN 'China' WHEN 'ANT' THEN 'Netherlands' WHEN 'AB9' THEN 'Sudan' WHEN 'XKK' THEN 'Kosovo'
      WHEN 'SCG' THEN CASE k % 3 WHEN 0 THEN 'Serbia' WHEN 1 THEN 'Montenegro' END END AS fixed_country,
    CASE WHEN iso IN ('HKG', 'MAC', 'ANT') THEN list_append(a1, n_name) ELSE a1 END AS b1,
    CASE WHEN iso = 'AB9' THEN list_append(a2, 'Abyei Area') ELSE a2 END AS b2,
    TRY_CAST(printf('%04d-%02d-%02d', y, coalesce(sm, 1), coalesce(sd, 1)) AS DATE) AS start_date,
    TRY_CAST(printf('%04d-%02d-%02d', y, coalesce(em, 1), 1) AS DATE) AS end_raw,
    CASE WHEN k % 6 <> 0 THEN o_orderpriority END AS disaster_type, CASE WHEN k % 4 <> 0 THEN o_orderstatus END AS disaster_subtype
  FROM parts WHERE n <> 3 OR (k % 5 <> 0 AND k % 3 < 2)),
{_listed('b1', 'alias1', 'l1')}, {_listed('b2', 'alias2', 'l2')}
SELECT m.event_id, m.iso3_code, coalesce(fixed_country, c.main0, n_name) AS admin_level_0, coalesce(l1.names, '') AS admin_level_1, coalesce(l2.names, '') AS admin_level_2,
  start_date, CASE WHEN end_raw < start_date THEN start_date ELSE end_raw END AS end_date, disaster_type, disaster_subtype,
  CASE WHEN k % 7 <> 0 THEN k % 100 END AS total_deaths, k % 30 AS number_injured, CASE WHEN k % 2 = 0 THEN k % 1000 END AS number_affected, k % 500 AS total_affected,
  round(o_totalprice * 1000, 2) AS aid_contribution, CASE WHEN k % 8 <> 0 THEN (k * 3000)::DOUBLE END AS total_damage_adjusted,
  CASE k % 4 WHEN 0 THEN 'FL-' || (k // 4 % 5000) WHEN 1 THEN 'A-' || k || '|B-' || k END AS glide, CASE WHEN k % 4 = 0 THEN 'us:' || k END AS usgs,
  m.iso3_code || '_' || coalesce(disaster_type, 'UNKNOWN-DISASTER-TYPE') || '_' || coalesce(disaster_subtype, 'UNKNOWN-DISASTER-SUBTYPE') || '_'
    || coalesce(strftime(start_date, '%Y%m%d'), 'UNKNOWN-START-DATE') || '_' || substr(sha256('EMDAT|' || k), 1, 8) AS event_name,
  '{{"DisNo.":"D-' || k || '","Classification Key":"nat-x"' || coalesce(',"External IDs":"' || ids || '"', '') || ',"Subregion":"' || r_name || '","Region":"' || r_name || '","Start Year":' || y
    || coalesce(',"Start Month":' || sm, '') || coalesce(',"Start Day":' || sd, '') || ',"End Year":' || y || coalesce(',"End Month":' || em, '') || ',"End Day":1'
    || coalesce(',"Admin Units":"' || replace(units_text, '"', '\\"') || '"', '') || '}}' AS metadata
FROM mapped m LEFT JOIN main_country c ON m.iso3_code = c.iso3 LEFT JOIN l1 ON l1.event_id = m.event_id LEFT JOIN l2 ON l2.event_id = m.event_id"""


@query("n1_clean_events_a", _N1)
def n1(spark, d):
    clean = ev.clean_events_a(t.raw_events_a(spark, d), t.place_mapping(spark, d))
    join = lambda c: F.array_join(c, "|").alias(c)
    return clean.select(
        "event_id", "iso3_code", "admin_level_0", join("admin_level_1"), join("admin_level_2"), "start_date", "end_date", "disaster_type",
        "disaster_subtype", "total_deaths", "number_injured", "number_affected", "total_affected", F.round("aid_contribution", 2).alias("aid_contribution"),
        "total_damage_adjusted", join("glide"), join("usgs"), "event_name", "metadata")


_PLACES = """
, patterns AS (SELECT iso3, '\\b(?:' || string_agg(low, '|' ORDER BY length(low) DESC, low) || ')\\b' AS p FROM (SELECT DISTINCT iso3, lower(name) AS low FROM scan_sets) GROUP BY iso3),
b AS (SELECT *, CASE iso_raw WHEN 'HKG' THEN 'CHN' WHEN 'MAC' THEN 'CHN' WHEN 'ANT' THEN 'NLD' WHEN 'AB9' THEN 'SDN' WHEN 'XKX' THEN 'XKO' ELSE iso_raw END AS iso3_code FROM raw_b),
hits AS (SELECT DISTINCT event_id, iso3, unnest(regexp_extract_all(lower(text), p)) AS low FROM b JOIN patterns ON iso3 = iso3_code),
named AS (SELECT event_id, h.iso3, n.level, n.name FROM hits h JOIN scan_sets n ON h.iso3 = n.iso3 AND h.low = lower(n.name) WHERE n.level > 0),
mains AS (SELECT event_id, n.level, n.name, CASE n.level WHEN 1 THEN arg_min(main1, seq) ELSE arg_min(main2, seq) END AS main FROM named n JOIN mapping m ON n.iso3 = m.iso3 AND CASE n.level
  WHEN 1 THEN contains(lower(main1 || '|' || alt1 || '|' || coalesce(local1, '')), lower(n.name)) ELSE contains(lower(main2 || '|' || alt2 || '|' || coalesce(local2, '')), lower(n.name)) END
  GROUP BY event_id, n.level, n.iso3, n.name),
firsts AS (SELECT event_id, level, main, min(lpad((1000 - length(name))::VARCHAR, 4, '0') || name) AS o FROM mains GROUP BY ALL),
listed AS (SELECT event_id, level, string_agg(main, '|' ORDER BY o) AS names FROM firsts GROUP BY ALL)"""


@query("n2_clean_events_b", with_("mapping", "raw_b") + _PLACES + """
, typed AS (SELECT *, CASE WHEN hazard = 'error' OR (hazard = 'view' AND event_id % 2 = 1) THEN hazard WHEN event_id % 2 = 0 THEN upper(hazard) ELSE upper(hazard[1]) || lower(hazard[2:]) END AS disaster_type,
  CASE WHEN event_id % 2 = 1 THEN NULL WHEN hazard = 'error' THEN 'error' ELSE 'Sub ' || hazard END AS disaster_subtype FROM b)
SELECT b.event_id, iso3_code, c.main0 AS admin_level_0, coalesce(l1.names, '') AS admin_level_1, coalesce(l2.names, '') AS admin_level_2, start_date, displaced AS disaster_internal_displacements,
  disaster_type, disaster_subtype, CASE WHEN b.event_id % 3 = 0 THEN 'FL-' || (b.event_id // 3 % 5000) END AS glide, CASE WHEN b.event_id % 3 = 0 THEN 'x:' || b.event_id END AS ifrc_appeal_id,
  CASE WHEN b.event_id % 3 = 1 THEN 'loc' || b.event_id END AS local_identifier,
  iso3_code || '_' || disaster_type || '_' || coalesce(disaster_subtype, 'UNKNOWN-DISASTER-SUBTYPE') || '_' || strftime(start_date, '%Y%m%d') || '_' || substr(sha256('IDMC|' || b.event_id), 1, 8) AS event_name,
  '{"Event Name":"' || text || '"' || coalesce(',"Event Codes (Code:Type)":"' || codes || '"', '') || ',"Year":' || year || ',"Hazard Type":"' || hazard || '"' || coalesce(',"Hazard Sub Type":"' || hazard_sub || '"', '') || '}' AS metadata
FROM typed b LEFT JOIN main_country c ON iso3_code = c.iso3 LEFT JOIN listed l1 ON l1.event_id = b.event_id AND l1.level = 1 LEFT JOIN listed l2 ON l2.event_id = b.event_id AND l2.level = 2""")
def n2(spark, d):
    clean = ev.clean_events_b(t.raw_events_b(spark, d), t.place_mapping(spark, d), t.type_map(spark, d))
    join = lambda c: F.array_join(c, "|").alias(c)
    return clean.select(
        "event_id", "iso3_code", "admin_level_0", join("admin_level_1"), join("admin_level_2"), "start_date", "disaster_internal_displacements",
        "disaster_type", "disaster_subtype", join("glide"), join("ifrc_appeal_id"), join("local_identifier"), "event_name", "metadata")


@query("n3_merge_events", with_("ev") + """
SELECT source, event_id, event_name, disaster_type, iso3_code, start_date, total_deaths, disaster_internal_displacements, array_to_string(glide, '|') AS glide FROM ev""")
def n3(spark, d):
    return t.events(spark, d).select(
        "source", "event_id", "event_name", "disaster_type", "iso3_code", "start_date", "total_deaths", "disaster_internal_displacements",
        F.array_join("glide", "|").alias("glide"))


@query("n4_merged_event_places", with_("ev", "units") + """
, flat AS (
  SELECT source, event_id, iso3_code, 0 AS admin_level, admin_level_0 AS admin_name FROM ev
  UNION ALL SELECT source, event_id, iso3_code, 1, unnest(admin_level_1) FROM ev
  UNION ALL SELECT source, event_id, iso3_code, 2, unnest(admin_level_2) FROM ev)
SELECT source, event_id, f.admin_level, admin_name, u.gid, u.level_type FROM flat f
JOIN units u ON f.admin_level = u.admin_level AND f.admin_name = u.name AND (f.iso3_code = u.iso3 OR f.iso3_code IS NULL)""")
def n4(spark, d):
    u = t.units(spark, d).select("gid", "iso3", "admin_level", "name", "level_type")
    return ev.events_with_geometry(t.events(spark, d), u).select("source", "event_id", "admin_level", "admin_name", "gid", "level_type")


@query("p9_stored_lists", with_("ev") + """
SELECT event_id, source, CASE WHEN len(admin_level_1) > 0 THEN array_to_string(admin_level_1, '|') END AS admin_level_1, admin_level_1 IS NOT NULL AND len(admin_level_1) = 0 AS emptied,
  CASE WHEN len(glide) > 0 THEN array_to_string(glide, '|') END AS glide FROM ev""")
def p9_stored(spark, d):
    """Merged events in the form they are loaded in: empty lists are null."""
    events = t.events(spark, d).withColumn("emptied", F.coalesce(F.size("admin_level_1") == 0, F.lit(False)))
    return ev.stored_lists(events).select(
        "event_id", "source", F.array_join("admin_level_1", "|").alias("admin_level_1"), "emptied", F.array_join("glide", "|").alias("glide"))
