"""Joins (J rows of the inventory, without the spatial ones)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.operators import codes, places
from atlasweave.operators.reshape import combine_wide, flatten_levels
from atlasweave.plans import reports, views
from atlasweave.plans.events import found_places, place_targets
from atlasweave.session import stored
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import DATASET_VARIABLES, DATASETS, SELECTED, case_codes, normalize, with_
from atlasweave.workloads.tables import SPECIAL_CODES


@query("j1_code_semi", with_("codes") + "SELECT event_id, event_name FROM ev_b WHERE event_id IN (SELECT b_id FROM code_pairs)")
def j1(spark, d):
    return codes.code_semi(stored(t.events_b(spark, d), "events-b"), t.events_a(spark, d), "event_id", "glide").select("event_id", "event_name")


@query("j2_code_anti", with_("codes") + "SELECT event_id, event_name FROM ev_b WHERE event_id NOT IN (SELECT b_id FROM code_pairs)")
def j2(spark, d):
    return codes.code_anti(stored(t.events_b(spark, d), "events-b"), t.events_a(spark, d), "event_id", "glide").select("event_id", "event_name")


@query("j3_code_pairs_same_country", with_("codes") + """
SELECT iso3_code, a_type, a_year::INT AS a_year, b_type, b_year::INT AS b_year, count(*) AS n_pairs FROM country_pairs GROUP BY ALL""")
def j3(spark, d):
    return reports.type_pairs(t.events_a(spark, d), t.events_b(spark, d))


@query("j4_update_from", with_("ev") + """
SELECT event_id, disaster_internal_displacements FROM ev WHERE source = 'EMDAT'""")
def j4(spark, d):
    return codes.update_from(
        stored(t.events_a(spark, d), "events-a"), t.events_b(spark, d), "event_id", "event_id", "glide", "disaster_internal_displacements"
    ).select("event_id", "disaster_internal_displacements")


@query("j5_shared_code_countries", with_("codes") + """
, p AS (SELECT a.code, a.iso3_code AS ai, b.iso3_code AS bi FROM codes_a a JOIN codes_b b USING (code))
SELECT code, count(DISTINCT ai) AS left_countries, count(DISTINCT bi) AS right_countries, count(DISTINCT ai) + count(DISTINCT bi) AS total_countries FROM p GROUP BY code""")
def j5(spark, d):
    return codes.shared_code_countries(t.events_a(spark, d), t.events_b(spark, d), "glide", "iso3_code")


@query("j6_catalog_label", with_("catalog", "obs") + """
SELECT o.dataset, coalesce(e.label, g.label, o.variable) AS label, coalesce(e.data_source, g.data_source, o.source) AS source, count(*) AS n_rows
FROM obs o LEFT JOIN catalog e ON e.dataset = o.dataset AND e.variable = o.variable
LEFT JOIN catalog g ON g.dataset IS NULL AND g.variable = o.variable GROUP BY ALL""")
def j6(spark, d):
    labelled = views.label_variables(t.observations(spark, d), t.catalog(spark, d))
    return labelled.groupBy(
        "dataset", F.coalesce("label", "variable").alias("label"), F.coalesce("data_source", "source").alias("source")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query("j7_conditional_left", with_("obs", "units") + """
SELECT o.gid, o.admin_level, u.iso3_1, count(*) AS n_rows FROM obs o LEFT JOIN units u ON o.admin_level = 1 AND o.gid = u.gid AND u.admin_level = 1 GROUP BY ALL""")
def j7(spark, d):
    level1 = t.units(spark, d).where("admin_level = 1").select(F.col("gid").alias("_g"), "iso3_1")
    obs = t.observations(spark, d)
    return obs.join(level1, (F.col("admin_level") == 1) & (F.col("gid") == F.col("_g")), "left").groupBy(
        "gid", "admin_level", "iso3_1").agg(F.count(F.lit(1)).alias("n_rows"))


def _pivot_sql(name: str, dataset: str, labels, value: str) -> str:
    cols = ", ".join(f"max(CASE WHEN variable = '{v}' THEN {value} END) AS \"{label}\"" for v, label in labels.items())
    return f"{name} AS (SELECT gid, admin_level, date, {cols} FROM obs WHERE dataset = '{dataset}' GROUP BY ALL)"


def _full_chain_sql() -> str:
    """Eleven pivots, full-joined one after the other."""
    names = [f"w{i}" for i in range(len(DATASETS))]
    parts = [_pivot_sql(n, ds, {v: f"{ds}: {v}" for v in DATASET_VARIABLES[ds]}, f"({SELECTED})") for n, ds in zip(names, DATASETS)]
    joins = names[0] + "".join(f" FULL JOIN {n} USING (gid, admin_level, date)" for n in names[1:])
    cols = ", ".join(f'round("{ds}: {v}", 4) AS "{ds}: {v}"' for ds in DATASETS for v in DATASET_VARIABLES[ds])
    return with_("obs") + ", " + ", ".join(parts) + f" SELECT gid, admin_level, date, {cols} FROM {joins}"


@query("j8_full_outer_chain", _full_chain_sql())
def j8(spark, d):
    """Wide tables of all eleven datasets, full-joined in one shuffle."""
    obs = stored(t.observations(spark, d), "observations")
    keys = ["gid", "admin_level", "date"]
    parts = [views.wide_view(obs, ds, {v: f"{ds}: {v}" for v in DATASET_VARIABLES[ds]}) for ds in DATASETS]
    wide = combine_wide(parts, keys)
    return wide.select(*keys, *[F.round(f"`{c}`", 4).alias(c) for c in wide.columns if c not in keys])


_EVENT_COLUMNS = ["event_id", "event_name", "disaster_type", "source", "total_deaths", "disaster_internal_displacements"]


@query("j9_obs_event_full", with_("obs", "ev") + ", " + _pivot_sql("w", "climate", views.CLIMATE_LABELS, "mean") + """
SELECT coalesce(w.gid, e.iso3_code) AS gid, admin_level, coalesce(w.date, e.start_date) AS date, """ + ", ".join(
    f'round("{c}", 4) AS "{c}"' for c in views.CLIMATE_LABELS.values()) + """, event_id, event_name, disaster_type, source, total_deaths, disaster_internal_displacements
FROM w FULL JOIN ev e ON w.gid = e.iso3_code AND w.date = e.start_date""")
def j9(spark, d):
    wide = views.wide_view(t.observations(spark, d), "climate", views.CLIMATE_LABELS)
    both = views.country_event_view(wide, t.events(spark, d).select("iso3_code", "start_date", *_EVENT_COLUMNS))
    return both.select(
        "gid", "admin_level", "date", *[F.round(f"`{c}`", 4).alias(c) for c in views.CLIMATE_LABELS.values()], *_EVENT_COLUMNS)


@query("j10_events_with_geometry", with_("ev_a", "units") + """
, flat AS (
  SELECT event_id, iso3_code, 0 AS admin_level, admin_level_0 AS admin_name FROM ev_a
  UNION ALL SELECT event_id, iso3_code, 1, unnest(admin_level_1) FROM ev_a
  UNION ALL SELECT event_id, iso3_code, 2, unnest(admin_level_2) FROM ev_a)
SELECT event_id, f.iso3_code, f.admin_level, admin_name, u.gid FROM flat f
JOIN units u ON f.admin_level = u.admin_level AND f.admin_name = u.name AND (f.iso3_code = u.iso3 OR f.iso3_code IS NULL)""")
def j10(spark, d):
    flat = flatten_levels(t.events_a(spark, d)).select("event_id", "iso3_code", "admin_level", "admin_name")
    u = t.units(spark, d).select("gid", "iso3", "admin_level", "name")
    return places.attach_units(flat, u, "iso3_code", "admin_level", "admin_name")


@query("j11_name_match_precedence", with_("ev_a", "gaz") + f"""
, named AS (SELECT event_id, iso3_code, unnest(list_concat(coalesce(admin_level_1, []), coalesce(admin_level_2, []))) AS place FROM ev_a)
SELECT event_id, place, g.gid, g.admin_level FROM named n LEFT JOIN gaz_best g ON n.iso3_code = g.iso3 AND {normalize('place')} = g.norm_name""")
def j11(spark, d):
    empty = F.array().cast("array<string>")
    named = t.events_a(spark, d).select(
        "event_id", "iso3_code",
        F.explode(F.concat(F.coalesce("admin_level_1", empty), F.coalesce("admin_level_2", empty))).alias("place"))
    return places.match_names(named, places.gazetteer(t.units(spark, d)), "iso3_code", "place").select(
        "event_id", "place", "gid", "admin_level")


_ALIAS = """
, alias_rows AS (
  SELECT iso3, seq, main2 AS main, unnest(list_concat([main2], string_split(alt2, '|'), coalesce(string_split(local2, '|'), []))) AS alias FROM mapping),
alias_best AS (SELECT iso3, alias, arg_min(main, seq) AS main FROM alias_rows GROUP BY ALL)"""


@query("j12_alias_lookup", with_("order_places", "mapping") + _ALIAS + f"""
, src AS (
  SELECT o_orderkey AS event_id, {case_codes('n_nationkey', SPECIAL_CODES)} AS iso,
    unnest([lower(c_mktsegment), 'Elsewhere', 'Old ' || lower(c_mktsegment) || ' town']) AS name, unnest([0, 1, 2]) AS pos FROM order_places)
SELECT event_id, string_agg(coalesce(main, name), '|' ORDER BY pos) AS names FROM src LEFT JOIN alias_best ON iso = iso3 AND name = alias GROUP BY event_id""")
def j12(spark, d):
    low = F.lower("c_mktsegment")
    src = t.order_places(spark, d).select(
        F.col("o_orderkey").alias("event_id"), t.country_code("n_nationkey", SPECIAL_CODES).alias("iso"),
        F.array(low, F.lit("Elsewhere"), F.concat(F.lit("Old "), low, F.lit(" town"))).alias("names"))
    out = places.alias_lookup(stored(src, "listed"), t.place_mapping(spark, d), "event_id", "iso", {2: "names"})
    return out.select("event_id", F.array_join("names", "|").alias("names"))


@query("j13_contains_lookup", with_("mapping") + """
SELECT n.iso3, n.level, n.name, arg_min(CASE n.level WHEN 1 THEN m.main1 ELSE m.main2 END, m.seq) AS main
FROM name_sets n JOIN mapping m ON n.iso3 = m.iso3 AND CASE n.level
  WHEN 1 THEN contains(lower(main1), lower(n.name)) OR contains(lower(alt1), lower(n.name)) OR coalesce(contains(lower(local1), lower(n.name)), false)
  WHEN 2 THEN contains(lower(main2), lower(n.name)) OR contains(lower(alt2), lower(n.name)) OR coalesce(contains(lower(local2), lower(n.name)), false) END
WHERE n.level > 0 GROUP BY ALL""")
def j13(spark, d):
    m = stored(t.place_mapping(spark, d), "mapping")
    return place_targets(m, stored(places.name_sets(m), "names"))


@query("j14_gazetteer_scan", with_("mapping", "raw_b") + """
, patterns AS (SELECT iso3, '\\b(?:' || string_agg(low, '|' ORDER BY length(low) DESC, low) || ')\\b' AS p FROM (SELECT DISTINCT iso3, lower(name) AS low FROM scan_sets) GROUP BY iso3),
hits AS (SELECT DISTINCT event_id, iso3, unnest(regexp_extract_all(lower(text), p)) AS low FROM raw_b JOIN patterns ON iso3 = CASE iso_raw WHEN 'HKG' THEN 'CHN' WHEN 'MAC' THEN 'CHN' WHEN 'ANT' THEN 'NLD' WHEN 'AB9' THEN 'SDN' WHEN 'XKX' THEN 'XKO' ELSE iso_raw END)
SELECT event_id, h.iso3, n.level, n.name FROM hits h JOIN scan_sets n ON h.iso3 = n.iso3 AND h.low = lower(n.name)""")
def j14(spark, d):
    raw = codes.remap_countries(
        t.raw_events_b(spark, d).select("event_id", F.trim("ISO3").alias("iso"), F.col("`Country / Territory`").alias("c"), F.col("Event Name").alias("text")),
        codes.REMAPS_PLAIN, "iso", "c")
    return places.scan_names(raw, stored(places.scanned_names(t.place_mapping(spark, d)), "names"), "event_id", "iso", "text")


# Words are runs of letters, digits and underscores; a phrase is two of them with one blank between.
_RUN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+"
_SENTENCE_END = "(\\p{L}+ \\p{L}+)\\."


@query("j14_gazetteer_documents", f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, text FROM documents),
phrases AS (SELECT DISTINCT lang, lower(p) AS p FROM (SELECT lang, unnest(regexp_extract_all(text, '{_SENTENCE_END}', 1)) AS p FROM docs)),
names AS (SELECT lang, p FROM phrases UNION SELECT lang, string_split(p, ' ')[2] FROM phrases),
runs AS (SELECT r, doc_id, lang, unnest(l) AS run, generate_subscripts(l, 1) AS k FROM (
  SELECT r, doc_id, lang, regexp_extract_all(lower(text), '{_RUN}') AS l FROM docs)),
words AS (SELECT *, CASE WHEN lead(run) OVER w = ' ' THEN run || ' ' || lead(run, 2) OVER w END AS pair FROM runs WINDOW w AS (PARTITION BY r ORDER BY k)
  QUALIFY regexp_matches(run, '^[\\p{{L}}\\p{{N}}_]')),
known AS (SELECT w.*, p.p IS NOT NULL AS pair_known, s.p IS NOT NULL AS word_known FROM words w
  LEFT JOIN names p ON p.lang = w.lang AND p.p = w.pair LEFT JOIN names s ON s.lang = w.lang AND s.p = w.run),
chains AS (SELECT *, k // 2 - row_number() OVER (PARTITION BY r, pair_known ORDER BY k) AS chain FROM known),
taken AS (SELECT *, pair_known AND row_number() OVER (PARTITION BY r, pair_known, chain ORDER BY k) % 2 = 1 AS pair_taken FROM chains),
placed AS (SELECT *, coalesce(lag(pair_taken) OVER (PARTITION BY r ORDER BY k), false) AS covered FROM taken)
SELECT DISTINCT doc_id, CASE WHEN pair_taken THEN pair ELSE run END AS name FROM placed WHERE pair_taken OR (word_known AND NOT covered)""")
def j14_documents(spark, d):
    """All documents scanned, as they are, for the last two words and the last word of every sentence of their language."""
    docs = t.table(spark, d, "documents").select("doc_id", "lang", "text")
    ends = F.regexp_extract_all("text", F.lit(_SENTENCE_END), F.lit(1))
    phrases = docs.select("lang", F.explode(F.array_distinct(F.transform(ends, F.lower))).alias("p")).distinct()
    names = phrases.select("lang", F.explode(F.array("p", F.element_at(F.split("p", " "), 2))).alias("name")).distinct()
    # a gazetteer is a table; here it is derived from the texts first
    names = stored(names.select(F.col("lang").alias("iso3"), F.lit(1).alias("level"), "name"), "names")
    return places.scan_names(docs, names, "doc_id", "lang", "text").select("doc_id", "name")


@query("j15_pair_map_nullsafe", """
SELECT event_id, CASE WHEN event_type = 'error' OR (event_type = 'view' AND event_id % 2 = 1) THEN event_type WHEN event_id % 2 = 0 THEN upper(event_type)
    ELSE upper(event_type[1]) || lower(event_type[2:]) END AS disaster_type,
  CASE WHEN event_id % 2 = 1 THEN NULL WHEN event_type = 'error' THEN 'error' ELSE 'Sub ' || event_type END AS disaster_subtype FROM events""")
def j15(spark, d):
    k = F.col("event_id")
    raw = t.table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("Hazard Type"), F.when(k % 2 == 0, F.col("event_type")).alias("Hazard Sub Type"))
    out = codes.map_pair(
        raw, t.type_map(spark, d), ("Hazard Type", "Hazard Sub Type"), ("Disaster Type", "Disaster Subtype"), "seq",
        ("disaster_type", "disaster_subtype"))
    return out.select("event_id", "disaster_type", "disaster_subtype")


@query("j16_evidence_resolution", with_("order_places") + """
SELECT o_orderkey AS event_id, CASE WHEN n_nationkey <> 3 THEN 'other' WHEN o_orderkey % 3 = 0 THEN 'SRB' ELSE 'MNE' END AS iso, CASE WHEN n_nationkey <> 3 THEN n_name WHEN o_orderkey % 3 = 0 THEN 'Serbia' ELSE 'Montenegro' END AS country
FROM order_places WHERE n_nationkey <> 3 OR o_orderkey % 3 < 2""")
def j16(spark, d):
    k = F.col("o_orderkey")
    listed = (
        F.when(k % 3 == 0, F.array(F.lit("NATION_7"), F.lit("NATION_6")))
        .when(k % 3 == 1, F.array(F.lit("Nat 7")))
        .otherwise(F.array(F.lit("Elsewhere"))))
    src = t.order_places(spark, d).select(
        k.alias("event_id"), F.when(F.col("n_nationkey") == 3, "SCG").otherwise(F.lit("other")).alias("iso"), F.col("n_name").alias("country"),
        listed.alias("admin1"))
    names = places.name_sets(t.place_mapping(spark, d)).where("level > 0")
    return places.resolve_by_evidence(
        stored(src, "listed"), names, "event_id", "iso", "country", ["admin1"], "SCG", [("SRB", "Serbia"), ("MNE", "Montenegro")]
    ).select("event_id", "iso", "country")


@query("j17_code_remap_append", with_("order_places") + f"""
, src AS (SELECT o_orderkey AS event_id, {case_codes('n_nationkey', SPECIAL_CODES)} AS iso, n_name AS country FROM order_places)
SELECT event_id, CASE iso WHEN 'HKG' THEN 'CHN' WHEN 'MAC' THEN 'CHN' WHEN 'ANT' THEN 'NLD' WHEN 'AB9' THEN 'SDN' WHEN 'XKK' THEN 'XKO' ELSE iso END AS iso,
  CASE iso WHEN 'HKG' THEN 'China' WHEN 'MAC' THEN 'China' WHEN 'ANT' THEN 'Netherlands' WHEN 'AB9' THEN 'Sudan' WHEN 'XKK' THEN 'Kosovo' ELSE country END AS country,
  CASE WHEN iso IN ('HKG', 'MAC', 'ANT') THEN 'first|' || country ELSE 'first' END AS admin1, CASE WHEN iso = 'AB9' THEN 'Abyei Area' ELSE '' END AS admin2 FROM src""")
def j17(spark, d):
    src = t.order_places(spark, d).select(
        F.col("o_orderkey").alias("event_id"), t.country_code("n_nationkey", SPECIAL_CODES).alias("iso"), F.col("n_name").alias("country"),
        F.array(F.lit("first")).alias("admin1"), F.array().cast("array<string>").alias("admin2"))
    out = codes.remap_countries(src, codes.REMAPS_WITH_PLACES, "iso", "country", "admin1", "admin2")
    return out.select("event_id", "iso", "country", F.array_join("admin1", "|").alias("admin1"), F.array_join("admin2", "|").alias("admin2"))


@query("j18_orphans", """
SELECT 'R' || (o_custkey % 30) AS orphan, count(*) AS n_rows FROM orders WHERE o_custkey % 30 > 24 GROUP BY ALL""")
def j18(spark, d):
    child = t.table(spark, d, "orders").select(F.concat(F.lit("R"), (F.col("o_custkey") % 30).cast("string")).alias("unit"))
    parent = t.table(spark, d, "nation").select(F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("gid"))
    return reports.orphans(child, "unit", parent, "gid")


@query("j19_overlap_counts", with_("ev", "obs") + """
SELECT (SELECT count(DISTINCT iso3_code) FROM ev) AS event_countries, (SELECT count(DISTINCT substr(gid, 1, 3)) FROM obs WHERE dataset = 'climate') AS observation_countries,
  (SELECT count(*) FROM (SELECT DISTINCT iso3_code AS i FROM ev) JOIN (SELECT DISTINCT substr(gid, 1, 3) AS i FROM obs WHERE dataset = 'climate') USING (i)) AS both""")
def j19(spark, d):
    return reports.country_overlap(t.events(spark, d), t.observations(spark, d))


@query("j22_class_lookup", with_("classes") + """
SELECT p_partkey, c.value AS class_id, c.value || '_' || coalesce(meaning, 'Unknown') AS variable
FROM (SELECT p_partkey, (p_size % 8)::INT AS value FROM part) c LEFT JOIN flags f ON c.value = f.value""")
def j22(spark, d):
    from atlasweave.operators.grids import label_classes

    coded = t.table(spark, d, "part").select("p_partkey", (F.col("p_size") % 8).cast("int").alias("class_id"))
    return label_classes(coded, t.class_flags(spark, d))


@query("n2_places_from_text", with_("mapping", "raw_b") + """
, patterns AS (SELECT iso3, '\\b(?:' || string_agg(low, '|' ORDER BY length(low) DESC, low) || ')\\b' AS p FROM (SELECT DISTINCT iso3, lower(name) AS low FROM scan_sets) GROUP BY iso3),
hits AS (SELECT DISTINCT event_id, iso3, unnest(regexp_extract_all(lower(text), p)) AS low FROM raw_b JOIN patterns ON iso3 = iso_raw),
named AS (SELECT event_id, h.iso3, n.level, n.name FROM hits h JOIN scan_sets n ON h.iso3 = n.iso3 AND h.low = lower(n.name) WHERE n.level > 0)
SELECT DISTINCT event_id, n.level, CASE n.level WHEN 1 THEN arg_min(main1, seq) ELSE arg_min(main2, seq) END AS main FROM named n JOIN mapping m ON n.iso3 = m.iso3 AND CASE n.level
  WHEN 1 THEN contains(lower(main1 || '|' || alt1 || '|' || coalesce(local1, '')), lower(n.name)) ELSE contains(lower(main2 || '|' || alt2 || '|' || coalesce(local2, '')), lower(n.name)) END
GROUP BY event_id, n.level, n.iso3, n.name""")
def n2_places(spark, d):
    raw = t.raw_events_b(spark, d).select("event_id", F.trim("ISO3").alias("iso"), F.col("Event Name").alias("text"))
    found = found_places(raw, t.place_mapping(spark, d), "event_id", "iso", "text")
    tagged = lambda level: F.transform(
        f"admin_level_{level}", lambda m: F.struct(F.lit(level).alias("level"), m.alias("main")))
    items = F.concat(tagged(1), tagged(2))
    return found.select("event_id", F.explode(items).alias("x")).select("event_id", "x.level", "x.main")
