"""Name-matched loading (N5-N10) and its reports (V15, V16, X2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.functions.text import normalize_name
from atlasweave.operators import places
from atlasweave.plans import indicators as ind
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.scan_jobs import features
from atlasweave.workloads.sql import ISO_REMAP, normalize, texts, with_

_VALUES = ", ".join(
    f"TRY_CAST(nullif(trim({v}), '') AS DOUBLE)" + (" * 1000" if v == "pop" else "") for v in ind.INDEX_VARIABLES)


@query("n5_indicator_match", with_("indicators") + f"""
, winners AS (SELECT * FROM located WHERE gid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gid, admin_level, year ORDER BY seq DESC, pos DESC) = 1)
SELECT gid, admin_level, make_date(year, 1, 1) AS date, note, source_file AS source,
  '{{"country":"' || country || '","continent":' || coalesce('"' || continent || '"', 'null') || ',"iso_code":"' || iso_code || '","level":"' || level || '","GDLCODE":"' || GDLCODE || '","region":"' || region || '","year":' || year || '}}' AS metadata,
  unnest({texts(ind.INDEX_VARIABLES)}) AS variable, unnest([{_VALUES}]) AS raw_value FROM winners""")
def n5(spark, d):
    names = places.gazetteer(t.units(spark, d))
    obs, _ = ind.load_indicators(t.raw_indicators(spark, d), names, ind.INDEX_VARIABLES, ind.INDEX_SCALE)
    return obs


_AREA_VALUES = ", ".join(
    f"TRY_CAST(nullif(trim({v}), '') AS DOUBLE)" + (" * 1000000" if v == "regpopm" else "") for v in ind.AREA_VARIABLES)


@query("n5_area_match", with_("indicators") + f"""
, winners AS (SELECT * FROM located WHERE gid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gid, admin_level, year ORDER BY seq DESC, pos DESC) = 1)
SELECT gid, admin_level, make_date(year, 1, 1) AS date,
  '{{"iso_code":"' || iso_code || '","ISO2":"' || ISO2 || '","iso_num":"' || iso_num || '","country":"' || country || '","year":' || year || ',"datasource":' || coalesce('"' || datasource || '"', 'null') || ',"GDLCODE":"' || GDLCODE || '","level":"' || level || '","region":"' || region || '"}}' AS metadata,
  unnest({texts(ind.AREA_VARIABLES)}) AS variable, unnest([{_AREA_VALUES}]) AS raw_value FROM winners""")
def n5_area(spark, d):
    names = places.gazetteer(t.units(spark, d))
    obs, _ = ind.load_indicators(t.raw_indicators(spark, d, ind.AREA_VARIABLES), names, ind.AREA_VARIABLES, ind.AREA_SCALE, ind.AREA_METADATA)
    return obs.select("gid", "admin_level", "date", "metadata", "variable", "raw_value")


@query("n5_unmatched", with_("indicators") + "SELECT DISTINCT iso_code, place, region FROM located WHERE gid IS NULL")
def n5_unmatched(spark, d):
    names = places.gazetteer(t.units(spark, d))
    _, unmatched = ind.load_indicators(t.raw_indicators(spark, d), names, ind.INDEX_VARIABLES)
    return unmatched


@query("n5_weather_match", with_("indicators") + """
, winners AS (SELECT * FROM located WHERE gid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gid, admin_level, year ORDER BY seq DESC, pos DESC) = 1)
SELECT gid, admin_level, make_date(year, 1, 1) AS date,
  '{"iso_code":"' || iso_code || '","country":"' || country || '","GDLCODE":"' || GDLCODE || '","level":"' || level || '","region":"' || region || '","continent":' ||
    coalesce('"' || continent || '"', 'null') || ',"year":' || year || '}' AS metadata, unnest(['surfacetempyear', 'relhumidityyear', 'totprecipyear']) AS variable,
  unnest([TRY_CAST(nullif(trim(shdi), '') AS DOUBLE), TRY_CAST(nullif(trim(edindex), '') AS DOUBLE), TRY_CAST(nullif(trim(lifexp), '') AS DOUBLE)]) AS raw_value FROM winners""")
def n5_weather(spark, d):
    raw = t.raw_indicators(spark, d).withColumnsRenamed({"shdi": "surfacetempyear", "edindex": "relhumidityyear", "lifexp": "totprecipyear"})
    obs, _ = ind.load_indicators(raw, places.gazetteer(t.units(spark, d)), ind.WEATHER_VARIABLES, metadata=ind.WEATHER_METADATA)
    return obs.select("gid", "admin_level", "date", "metadata", "variable", "raw_value")


_NEW = ISO_REMAP.format(x="iso")


@query("n6_displacement", with_("displacement") + f"""
, firsts AS (SELECT * FROM raw_disp QUALIFY row_number() OVER (PARTITION BY iso, name, year, source_file ORDER BY seq) = 1),
sums AS (SELECT {_NEW} AS gid, name, year, source_file AS source, coalesce(sum(d1), 0) AS d1, coalesce(sum(d2), 0) AS d2, coalesce(sum(d3), 0) AS d3 FROM firsts WHERE year IS NOT NULL GROUP BY ALL),
long AS (SELECT gid, make_date(year, 1, 1) AS date, name, source, '{{"ISO3":"' || gid || '","Name":"' || name || '","Year":' || year || '}}' AS metadata,
  unnest(['Conflict Total Displacement', 'Conflict Internal Displacements', 'Disaster Internal Displacements', 'Disaster Total Displacement']) AS variable, unnest([d1, d2, d3, 0]) AS v FROM sums)
SELECT gid, 0 AS admin_level, date, variable, sum(v) AS raw_value, arg_max(source, source || '~' || name) AS source, arg_max(metadata, source || '~' || name) AS metadata FROM long GROUP BY ALL""")
def n6(spark, d):
    return ind.displacement(t.raw_displacement(spark, d))


@query("n6_displacement_last", with_("displacement") + f"""
, firsts AS (SELECT * FROM raw_disp QUALIFY row_number() OVER (PARTITION BY iso, name, year, source_file ORDER BY seq) = 1),
sums AS (SELECT {_NEW} AS gid, name, year, source_file AS source, coalesce(sum(d1), 0) AS d1, coalesce(sum(d2), 0) AS d2, coalesce(sum(d3), 0) AS d3 FROM firsts WHERE year IS NOT NULL GROUP BY ALL),
long AS (SELECT gid, make_date(year, 1, 1) AS date, name, source,
  unnest(['Conflict Total Displacement', 'Conflict Internal Displacements', 'Disaster Internal Displacements', 'Disaster Total Displacement']) AS variable, unnest([d1, d2, d3, 0]) AS v FROM sums)
SELECT gid, date, variable, arg_max(v, source || '~' || name) AS raw_value FROM long GROUP BY ALL""")
def n6_last(spark, d):
    return ind.displacement(t.raw_displacement(spark, d), on_collision="last").select("gid", "date", "variable", "raw_value")


@query("n7_displacement_sadd", with_("displacement") + f"""
, firsts AS (SELECT * FROM raw_grp QUALIFY row_number() OVER (PARTITION BY iso, year, sex, cause ORDER BY seq) = 1),
sums AS (SELECT {_NEW} AS gid, country, year, sex, cause, source_file, {", ".join(f"coalesce(sum(g{i}), 0) AS g{i}" for i in range(1, 6))} FROM firsts WHERE sex IS NOT NULL GROUP BY ALL),
long AS (SELECT gid, make_date(year, 1, 1) AS date, cause || '_' || sex AS cs, unnest({texts(ind.AGE_GROUPS)}) AS age, unnest([g1, g2, g3, g4, g5]) AS v FROM sums)
SELECT gid, 0 AS admin_level, date, cs || '_' || age AS variable, sum(v) AS raw_value FROM long GROUP BY ALL""")
def n7(spark, d):
    return ind.displacement_by_group(t.raw_displacement_groups(spark, d)).select("gid", "admin_level", "date", "variable", "raw_value")


@query("n8_density_features", """
SELECT 'G' || s_suppkey AS gid, 1 AS admin_level, make_date((2000 + s_suppkey % 20)::INT, 1, 1) AS date, 'Population_Weighted_Density_G' AS variable, s_acctbal AS raw_value,
  'GID directly from WorldPop' AS note, 'WorldPop' AS source, '{"ISO":"N' || s_nationkey || '","Adm_N":"' || s_name || '"}' AS metadata FROM supplier""")
def n8(spark, d):
    return ind.density_observations(features(spark, d), F.col("GID_1"), 1, {"ISO": "ISO", "Adm_N": "Adm_N"})


@query("n10_gazetteer", with_("gaz") + "SELECT iso3, admin_level, norm_name, gid FROM gaz")
def n10(spark, d):
    return places.gazetteer(t.units(spark, d))


@query("v16_match_rate", with_("indicators") + """
SELECT iso_code, source_file, count(*) AS n_places, count(gid) AS n_matched, round(100.0::DOUBLE * count(gid) / count(*), 2) AS match_pct FROM located GROUP BY ALL""")
def v16(spark, d):
    located = ind.located_indicators(t.raw_indicators(spark, d), places.gazetteer(t.units(spark, d)))
    return places.match_rate(located, ["iso_code", "source_file"])


@query("x2_custom_normalizer", with_("indicators") + f"""
, g2 AS (SELECT iso3, replace(norm_name, '_', '') AS n2, min(admin_level * 1000000) AS o FROM gaz GROUP BY ALL)
SELECT seq, place, g2.o IS NOT NULL AS matched FROM exploded LEFT JOIN g2 ON iso_code = iso3 AND replace({normalize('place')}, '_', '') = n2""")
def x2(spark, d):
    rule = lambda c: F.replace(normalize_name(c), F.lit("_"), F.lit(""))
    names = places.gazetteer(t.units(spark, d), rule)
    located = ind.located_indicators(t.raw_indicators(spark, d), names, rule=rule)
    national = F.col("level") == "National"
    matched = F.when(national, F.lit(False)).otherwise(F.col("gid").isNotNull())
    return located.select("seq", "place", matched.alias("matched"))
