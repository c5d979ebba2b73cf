"""Serving views (M rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasweave.operators.reshape import renamed
from atlasweave.plans import views
from atlasweave.plans.materialised import PARTITIONS, load_observations, refresh_view
from atlasweave.schemas import CATALOG_LABELS
from atlasweave.session import scratch_path, stored
from atlasweave.sources import sinks
from atlasweave.workloads import query
from atlasweave.workloads import tables as t
from atlasweave.workloads.sql import CATEGORY, DATASET_VARIABLES, DATASETS, GRIDDED, MEAN_DATASETS, SELECTED, in_list, with_

_ARRAYS = ["admin_level_1", "admin_level_2", "usgs", "glide", "dfo", "local_identifier", "ifrc_appeal_id", "government_assigned_identifier"]
_ABSENT = {"disaster_subgroup", "metadata", "usgs", "dfo", "local_identifier", "ifrc_appeal_id", "government_assigned_identifier"}


def _event_column(name: str) -> str:
    if name in _ABSENT:
        return "NULL::VARCHAR"
    if name in _ARRAYS:
        return f"array_to_string({name}, '|')"
    return name


@query("m12_events_view", with_("ev") + "SELECT " + ", ".join(f'{_event_column(c)} AS "{label}"' for c, label in views.EVENT_LABELS.items()) + " FROM ev")
def m12(spark, d):
    shown = views.events_view(t.events(spark, d))
    lists = {views.EVENT_LABELS[c] for c in _ARRAYS}
    return shown.select(*[F.array_join(f"`{c}`", "|").alias(c) if c in lists else F.col(f"`{c}`") for c in shown.columns])


_MEASURES = ", ".join(
    f"round(sum({m}), 4) AS {m}" if "damage" in m or "costs" in m or "aid" in m else f"sum({m})::BIGINT AS {m}" for m in views.EVENT_MEASURES)
_MONEY = ["total_damage_adjusted", "reconstruction_costs_adjusted", "aid_contribution"]


@query("m14_eav_view", with_("catalog", "obs", "ev") + f"""
SELECT start_date AS date, iso3_code AS iso3, 'EM-DAT & IDMC-GIDD - Event - Disaster Displacement data' AS source, 'Disaster Types' AS category, disaster_type AS variable,
  count(*)::DOUBLE AS selected_value, {_MEASURES} FROM ev GROUP BY start_date, iso3_code, disaster_type
UNION ALL
SELECT date, gid, coalesce(e.data_source, g.data_source, o.source), {CATEGORY.replace("dataset", "o.dataset").replace("variable", "o.variable")}, coalesce(e.label, g.label, o.variable),
  round({SELECTED.replace("dataset", "o.dataset").replace("variable", "o.variable")}, 4), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM obs o LEFT JOIN catalog e ON e.dataset = o.dataset AND e.variable = o.variable LEFT JOIN catalog g ON g.dataset IS NULL AND g.variable = o.variable WHERE o.admin_level = 0""")
def m14(spark, d):
    v = views.eav_view(t.observations(spark, d), t.catalog(spark, d), t.events(spark, d))
    rounded = {c: F.round(c, 4) for c in _MONEY} | {"selected_value": F.round("selected_value", 4)}
    return v.withColumns(rounded)


@query("m15_long_view", with_("catalog", "obs", "units") + f"""
SELECT o.gid, o.admin_level, date, coalesce(e.label, g.label, o.variable) AS variable, round("sum", 4) AS "sum", round(mean, 4) AS mean, "min", "max", raw_value,
  CASE WHEN o.dataset IN {GRIDDED} THEN coalesce(missing_value_percentage, 0) END AS missing_value_percentage, coalesce(e.data_source, g.data_source, o.source) AS source,
  CASE WHEN o.dataset IN {GRIDDED} THEN coalesce(unit, 'N/A') END AS unit, round({SELECTED.replace("dataset", "o.dataset").replace("variable", "o.variable")}, 4) AS selected_value,
  substr(o.gid, 1, 3) AS iso3_level_0, CASE WHEN o.admin_level = 1 THEN u.iso3_1 END AS iso3_level_1
FROM obs o LEFT JOIN catalog e ON e.dataset = o.dataset AND e.variable = o.variable LEFT JOIN catalog g ON g.dataset IS NULL AND g.variable = o.variable
LEFT JOIN units u ON o.admin_level = 1 AND u.admin_level = 1 AND o.gid = u.gid""")
def m15(spark, d):
    v = views.long_view(t.observations(spark, d), t.catalog(spark, d), t.units(spark, d))
    return v.withColumns({c: F.round(c, 4) for c in ("sum", "mean", "selected_value")})


# Column names that the catalog does not give, and those the SQL expects of it.
_UNLISTED = {"climate": views.CLIMATE_LABELS, "aerosol": views.AEROSOL_LABELS}
_ALL = {
    (ds, v): _UNLISTED[ds][v] if ds in _UNLISTED else f"Label of {v}" for ds in DATASETS for v in DATASET_VARIABLES[ds]
}


def _labels(spark, d):
    return views.all_labels(t.catalog(spark, d), _UNLISTED)


@query("m13_combined_view", with_("obs") + f"""
, s AS (SELECT gid, admin_level, date, dataset, variable, {SELECTED} AS v FROM obs)
SELECT gid, admin_level, date, """ + ", ".join(
    f"round(max(CASE WHEN dataset = '{ds}' AND variable = '{v}' THEN v END), 4) AS \"{label}\"" for (ds, v), label in _ALL.items()) + " FROM s GROUP BY ALL")
def m13(spark, d):
    """All 232 variables side by side, columns as the catalog names them."""
    labels = _labels(spark, d)
    wide = views.combined_view(t.observations(spark, d), labels)
    return wide.select("gid", "admin_level", "date", *[F.round(f"`{c}`", 4).alias(c) for c in labels.values()])


_SHOWN = [c for c in views.EVENT_LABELS if c not in _ARRAYS and c not in ("iso3_code", "start_date")]


@query("m16_country_event_view", with_("obs", "ev") + f"""
, s AS (SELECT gid, admin_level, date, dataset, variable, {SELECTED} AS v FROM obs),
w AS (SELECT gid, admin_level, date, """ + ", ".join(
    f"round(max(CASE WHEN dataset = '{ds}' AND variable = '{v}' THEN v END), 4) AS \"{label}\"" for (ds, v), label in _ALL.items()) + """ FROM s GROUP BY ALL)
SELECT coalesce(w.gid, e.iso3_code) AS gid, w.admin_level, coalesce(w.date, e.start_date) AS date, """ + ", ".join(
    f'"{label}"' for label in _ALL.values()) + ", " + ", ".join(f'{"NULL::VARCHAR" if c in _ABSENT else "e." + c} AS "{views.EVENT_LABELS[c]}"' for c in _SHOWN) + """
FROM w FULL JOIN ev e ON w.gid = e.iso3_code AND w.date = e.start_date""")
def m16(spark, d):
    """All variables of all datasets with the labelled events of the country and date."""
    labels = _labels(spark, d)
    wide = views.combined_view(t.observations(spark, d), labels)
    shown = t.events(spark, d).select("iso3_code", "start_date", *[F.col(c).alias(views.EVENT_LABELS[c]) for c in _SHOWN])
    both = views.country_event_view(wide, shown)
    return both.select(
        "gid", "admin_level", "date", *[F.round(f"`{c}`", 4).alias(c) for c in labels.values()],
        *[F.col(f"`{views.EVENT_LABELS[c]}`") for c in _SHOWN])


def _wide_sql(dataset: str, labels: dict[str, str]) -> str:
    return with_("obs") + f", s AS (SELECT gid, admin_level, date, variable, dataset, {SELECTED} AS v FROM obs WHERE dataset = '{dataset}') SELECT gid, admin_level, date, " + ", ".join(
        f"round(max(CASE WHEN variable = '{v}' THEN v END), 4) AS \"{label}\"" for v, label in labels.items()) + " FROM s GROUP BY ALL"


def _shown(wide, labels):
    return wide.select("gid", "admin_level", "date", *[F.round(f"`{c}`", 4).alias(c) for c in labels.values()])


def _wide(number: int, dataset: str) -> None:
    """A view of a few variables under their own names."""
    labels = {v: v for v in DATASET_VARIABLES[dataset]}

    @query(f"m{number}_{dataset}_view", _wide_sql(dataset, labels))
    def wide(spark, d):
        return _shown(views.wide_view(t.observations(spark, d), dataset, labels), labels)


def _wide_by_catalog(number: int, dataset: str) -> None:
    """A view in the full width of the catalog: 38, 78, 67 and 34 columns."""

    @query(f"m{number}_{dataset}_view", _wide_sql(dataset, {v: f"Label of {v}" for v in DATASET_VARIABLES[dataset]}))
    def wide(spark, d):
        labels = views.catalog_labels(t.catalog(spark, d), dataset)
        return _shown(views.wide_view(t.observations(spark, d), dataset, labels), labels)


# number of the view in the inventory -> its dataset
for _number, _dataset in {2: "aerosol", 3: "burnt_area", 4: "soil_moisture", 5: "vegetation", 7: "population", 9: "weighted_density"}.items():
    _wide(_number, _dataset)
for _number, _dataset in {6: "land_class", 8: "population_age_sex", 10: "displacement", 11: "indicators"}.items():
    _wide_by_catalog(_number, _dataset)


@query("m17_catalog", with_("catalog", "obs") + f"""
, used AS (SELECT DISTINCT dataset AS ds, variable FROM obs)
SELECT {CATEGORY.replace("dataset", "c.ds").replace("variable", "c.variable")} AS "Category", data_source AS "Data Source", c.variable AS "Original Variable Name",
  label AS "Modified Variable Name/Label", NULL::VARCHAR AS "Unit", NULL::VARCHAR AS "Pre-Calculation", c.variable || ' of ' || c.ds AS "Description",
  CASE WHEN c.ds IN {in_list(MEAN_DATASETS)} THEN 'mean' ELSE 'raw_value' END AS "Selected Value (Areal Calculation)",
  '1992-1998' AS "Temperal Coverage", 'month' AS "Temperal Resolution", 'all units' AS "Geo Coverage", dataset AS "Original DB Table Name",
  'SRC_' || c.ds AS "Original Data Source" FROM catalog c JOIN used u ON c.ds = u.ds AND c.variable = u.variable""")
def m17(spark, d):
    """The catalog under its descriptive column names, entries of variables that were observed."""
    entries = t.catalog(spark, d)
    used = t.observations(spark, d).select(F.concat(F.lit("SRC_"), "dataset").alias("s"), F.col("variable").alias("v")).distinct()
    kept = entries.join(used, (F.col("original_source") == F.col("s")) & (F.col("variable") == F.col("v")), "left_semi")
    return renamed(kept, CATALOG_LABELS)


_CHANGED = "dataset IN ('climate', 'population') AND month(date) = 6"


@query("s18_view_refresh", with_("catalog", "obs", "units") + f"""
, changed AS (SELECT * REPLACE (CASE WHEN {_CHANGED} THEN "sum" + 1 ELSE "sum" END AS "sum", CASE WHEN {_CHANGED} THEN mean + 1 ELSE mean END AS mean) FROM obs)
SELECT o.dataset, o.gid, o.admin_level, date, coalesce(e.label, g.label, o.variable) AS variable, round("sum", 4) AS "sum", round(mean, 4) AS mean,
  round({SELECTED.replace("dataset", "o.dataset").replace("variable", "o.variable")}, 4) AS selected_value
FROM changed o LEFT JOIN catalog e ON e.dataset = o.dataset AND e.variable = o.variable LEFT JOIN catalog g ON g.dataset IS NULL AND g.variable = o.variable""")
def s18(spark, d):
    """A materialised long view after a batch: changed and new observations of two datasets, other partitions untouched."""
    table, view = scratch_path(spark, "observations"), scratch_path(spark, "long-view")
    catalog, units = t.catalog(spark, d), stored(t.units(spark, d), "units")
    build = lambda obs: views.long_view(obs, catalog, units, keep=("dataset",))
    obs = stored(t.observations(spark, d), "all-observations")
    new = F.expr(_CHANGED) & (F.col("dataset") == "climate")
    sinks.write_observations(obs.where(~new), table)
    sinks.write_view(build(spark.read.parquet(table)), view, PARTITIONS)
    batch = obs.where(_CHANGED).withColumns({"sum": F.col("sum") + 1, "mean": F.col("mean") + 1, "seq": F.lit(1)})
    refresh_view(spark, view, table, build, load_observations(spark, table, batch, ["seq"]))
    return spark.read.parquet(view).select(
        "dataset", "gid", "admin_level", "date", "variable", *[F.round(c, 4).alias(c) for c in ("sum", "mean", "selected_value")])
