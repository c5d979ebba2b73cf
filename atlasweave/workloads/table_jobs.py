"""Aggregations, picks per key and reshaping (A, W and U rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.operators import keys, reshape, summaries
from atlasweave.plans import reports, views
from atlasweave.operators.places import name_sets
from atlasweave.functions.text import replace_word, typed_codes
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import SELECTED, with_


def _rounded(df, columns):
    return df.select(*[F.round(f"`{c}`", 4).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def _pivot_sql(labels, value):
    return ", ".join(f"round(max(CASE WHEN variable = '{v}' THEN {value} END), 4) AS \"{n}\"" for v, n in labels.items())


@query("a4_pivot_max", with_("obs") + f"""
SELECT gid, admin_level, date, {_pivot_sql(views.CLIMATE_LABELS, 'mean')} FROM obs WHERE dataset = 'climate' GROUP BY ALL""")
def a4(spark, d):
    return _rounded(views.wide_view(t.observations(spark, d), "climate", views.CLIMATE_LABELS), views.CLIMATE_LABELS.values())


_AGE_SEX = {v: v for v in t.DATASET_VARIABLES["population_age_sex"][::13]}


@query("a5_pivot_selected", with_("obs") + f"""
, s AS (SELECT gid, admin_level, date, variable, dataset, {SELECTED} AS v FROM obs WHERE dataset IN ('population', 'population_age_sex'))
SELECT gid, admin_level, date, {_pivot_sql({**views.POPULATION_LABELS, **_AGE_SEX}, 'v')} FROM s GROUP BY ALL""")
def a5(spark, d):
    labels = {("population", v): n for v, n in views.POPULATION_LABELS.items()} | {("population_age_sex", v): n for v, n in _AGE_SEX.items()}
    obs = t.observations(spark, d).where(F.col("dataset").isin("population", "population_age_sex"))
    return _rounded(views.combined_view(obs, labels), labels.values())


@query("a6_group_sum_zero", with_("ev_a") + """
SELECT iso3_code, disaster_type, coalesce(sum(number_homeless), 0)::BIGINT AS number_homeless, coalesce(sum(total_deaths), 0)::BIGINT AS total_deaths
FROM ev_a WHERE iso3_code IS NOT NULL AND disaster_type IS NOT NULL GROUP BY ALL""")
def a6(spark, d):
    ev = t.events_a(spark, d).dropna(subset=["iso3_code", "disaster_type"])
    return ev.groupBy("iso3_code", "disaster_type").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("number_homeless", "total_deaths")])


@query("a7_event_rollup", with_("ev") + """
SELECT start_date AS date, iso3_code AS iso3, disaster_type AS variable, count(*) AS selected_value, sum(total_deaths)::BIGINT AS total_deaths, sum(number_injured)::BIGINT AS number_injured,
  sum(number_affected)::BIGINT AS number_affected, sum(number_homeless)::BIGINT AS number_homeless, sum(total_affected)::BIGINT AS total_affected, round(sum(total_damage_adjusted), 4) AS total_damage_adjusted,
  round(sum(reconstruction_costs_adjusted), 4) AS reconstruction_costs_adjusted, round(sum(aid_contribution), 4) AS aid_contribution, sum(disaster_internal_displacements)::BIGINT AS disaster_internal_displacements
FROM ev GROUP BY ALL""")
def a7(spark, d):
    out = views.event_rollup(t.events(spark, d))
    money = ("total_damage_adjusted", "reconstruction_costs_adjusted", "aid_contribution")
    return out.select(*[F.round(c, 4).alias(c) if c in money else F.col(c) for c in out.columns])


@query("a13_having_avg", with_("obs") + """
SELECT gid, variable, round(avg(missing_value_percentage), 4) AS avg_missing FROM obs WHERE dataset = 'climate' GROUP BY ALL HAVING avg(missing_value_percentage) > 25""")
def a13(spark, d):
    obs = t.observations(spark, d).where("dataset = 'climate'")
    return obs.groupBy("gid", "variable").agg(F.avg("missing_value_percentage").alias("m")).where("m > 25").select(
        "gid", "variable", F.round("m", 4).alias("avg_missing"))


@query("a14_median", with_("obs") + """
SELECT dataset, coalesce(round(quantile_cont(missing_value_percentage, 0.5), 4), 0) AS median_missing FROM obs GROUP BY dataset""")
def a14(spark, d):
    return reports.median_missing(t.observations(spark, d)).select("dataset", F.round("median_missing", 4).alias("median_missing"))


@query("a15_listagg_distinct", with_("ev") + """
SELECT iso3_code, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM ev GROUP BY iso3_code""")
def a15(spark, d):
    return t.events(spark, d).select("iso3_code", "source").groupBy("iso3_code").agg(
        F.expr("listagg(DISTINCT source, ', ') WITHIN GROUP (ORDER BY source)").alias("sources"))


@query("a16_collect_name_sets", with_("mapping") + "SELECT iso3, level, string_agg(name, '|' ORDER BY name) AS names FROM name_sets GROUP BY ALL")
def a16(spark, d):
    return name_sets(t.place_mapping(spark, d)).groupBy("iso3", "level").agg(
        F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


@query("a20_value_counts", "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY ALL")
def a20(spark, d):
    return summaries.value_counts(t.table(spark, d, "customer"), "c_mktsegment")


def _profile_sql(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
        f"round(quantile_cont({c}, 0.25), 4)::DOUBLE AS p25, round(quantile_cont({c}, 0.5), 4)::DOUBLE AS p50, round(quantile_cont({c}, 0.75), 4)::DOUBLE AS p75 FROM {source}"
        for c in columns)


_PROFILED = ["total_deaths", "number_injured", "total_damage_adjusted", "number_homeless"]


@query("a21_profile", with_("ev_a") + _profile_sql(_PROFILED, "ev_a"))
def a21(spark, d):
    return _rounded(summaries.profile(t.events_a(spark, d), _PROFILED), ("mean", "std", "p25", "p50", "p75"))


@query("w1_keep_first", """
SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1""")
def w1(spark, d):
    rows = t.table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return keys.keep_first(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("w3_surrogate_id", """
SELECT event_id, row_number() OVER (ORDER BY substr(sha256(event_id::VARCHAR), 1, 4), event_id) AS id, CAST('0x' || substr(sha256(event_type || '|' || event_id), 1, 15) AS BIGINT) AS hash_id FROM events""")
def w3(spark, d):
    ev = t.table(spark, d, "events").select("event_id", "event_type")
    return keys.dense_id(ev, "event_id").select("event_id", "id", keys.hash_id(["event_type", "event_id"]).alias("hash_id"))


@query("w6_top_k", with_("ev") + "SELECT iso3_code, disaster_type, count(*) AS n_events FROM ev GROUP BY ALL ORDER BY n_events DESC, iso3_code NULLS FIRST, disaster_type NULLS FIRST LIMIT 10")
def w6(spark, d):
    counted = t.events(spark, d).groupBy("iso3_code", "disaster_type").agg(F.count(F.lit(1)).alias("n_events"))
    return keys.top_k(counted, 10, ["n_events"], ["iso3_code", "disaster_type"])


@query("u1_union_all_tagged", """
SELECT dataset, count(*) AS n_rows, round(sum(value), 2) AS total, count(unit) AS with_unit FROM (
  SELECT 'orders' AS dataset, o_totalprice AS value, NULL AS unit FROM orders UNION ALL SELECT 'lines', l_extendedprice, l_returnflag FROM lineitem
  UNION ALL SELECT 'parts', p_retailprice, NULL FROM part) GROUP BY dataset""")
def u1(spark, d):
    both = reshape.union_tagged({
        "orders": t.table(spark, d, "orders").select(F.col("o_totalprice").alias("value")),
        "lines": t.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("value"), F.col("l_returnflag").alias("unit")),
        "parts": t.table(spark, d, "part").select(F.col("p_retailprice").alias("value")),
    })
    return both.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total"), F.count("unit").alias("with_unit"))


@query("u3_set_difference", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u3(spark, d):
    o = t.table(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").subtract(o.where("o_orderstatus = 'P'").select("o_custkey"))


@query("u5_unpivot_keep_nulls", """
SELECT o_orderkey, unnest(['price', 'deaths', 'none']) AS variable, unnest([o_totalprice, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 100)::DOUBLE END, NULL]) AS raw_value FROM orders""")
def u5(spark, d):
    k = F.col("o_orderkey")
    wide = t.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.when(k % 7 != 0, (k % 100).cast("double")).alias("deaths"), F.lit(None).cast("double").alias("none"))
    return reshape.unpivot(wide, ["o_orderkey"], ["price", "deaths", "none"])


@query("u6_composite_variable", """
SELECT c_mktsegment || '_' || o_orderstatus || '_' || replace(o_orderpriority, 'URGENT', 'NOW') AS variable, count(*) AS n_rows FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def u6(spark, d):
    name = F.concat_ws("_", "c_mktsegment", "o_orderstatus", replace_word(F.col("o_orderpriority"), "URGENT", "NOW"))
    return t.order_places(spark, d).groupBy(name.alias("variable")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("u8_flatten_admin", with_("ev_a") + """
SELECT event_id, 0 AS admin_level, admin_level_0 AS admin_name FROM ev_a UNION ALL SELECT event_id, 1, unnest(admin_level_1) FROM ev_a
UNION ALL SELECT event_id, 2, unnest(admin_level_2) FROM ev_a""")
def u8(spark, d):
    return reshape.flatten_levels(t.events_a(spark, d)).select("event_id", "admin_level", "admin_name")


@query("u9_admin_hierarchy", with_("units") + "SELECT gid, iso3, parent_gid, admin_level, name, var_names, nl_names, iso3_1, level_type FROM units")
def u9(spark, d):
    u = t.units(spark, d)
    return u.select("gid", "iso3", "parent_gid", "admin_level", "name", F.array_join("var_names", "|").alias("var_names"),
                    F.array_join("nl_names", "|").alias("nl_names"), "iso3_1", "level_type")


@query("u10_codes_to_columns", """
SELECT o_orderkey AS event_id, CASE o_orderkey % 4 WHEN 0 THEN 'FL-' || (o_orderkey // 4 % 5000) WHEN 1 THEN 'A-' || o_orderkey || '|B-' || o_orderkey END AS glide,
  CASE o_orderkey % 4 WHEN 0 THEN 'us:' || o_orderkey END AS usgs, NULL::VARCHAR AS dfo FROM orders""")
def u10(spark, d):
    parsed = t.raw_events_a(spark, d).select("event_id", typed_codes(F.col("External IDs")).alias("codes"))
    wide = reshape.codes_to_columns(parsed, "codes", {"GLIDE": "glide", "USGS": "usgs", "DFO": "dfo"})
    return wide.select("event_id", *[F.array_join(c, "|").alias(c) for c in ("glide", "usgs", "dfo")])


@query("u10_code_types", "SELECT * FROM (VALUES ('GLIDE'), ('USGS')) v(code_type) WHERE EXISTS (SELECT 1 FROM orders)")
def u10_types(spark, d):
    parsed = t.raw_events_a(spark, d).select(typed_codes(F.col("External IDs")).alias("codes"))
    return reshape.code_types(parsed, "codes")
