"""Quality and coverage reports, each a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.functions.text import nonempty
from atlasweave.operators.codes import code_pair_counts, code_semi, shared_code_countries
from atlasweave.operators.keys import top_k
from atlasweave.operators.reshape import union_tagged
from atlasweave.operators.summaries import completeness, group_medians
from atlasweave.session import scratch_path, stored
from atlasweave.schemas import GRID_DATASETS, NAMED_DATASETS, TableRules

# --- fixed values: columns of the completeness report ---------------------------
EVENT_COLUMNS = [
    "event_name", "disaster_type", "disaster_subtype", "iso3_code", "admin_level_0", "admin_level_1",
    "admin_level_2", "start_date", "total_deaths", "number_injured", "number_affected",
    "number_homeless", "total_affected", "total_damage_adjusted", "disaster_internal_displacements",
    "glide",
]
NOT_CLASSIFIED, NO_VALUE = "[not classified]", "[null]"


def _count(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def event_matching(a: DataFrame, b: DataFrame, merged: DataFrame) -> DataFrame:
    """Totals, code availability, matches and places as (metric, value) rows.

    The three tables are read once, as narrow rows tagged by table; totals and totals by
    source come out of one aggregation over grouping sets.
    """
    located = F.coalesce(nonempty(F.col("admin_level_1")) | nonempty(F.col("admin_level_2")), F.lit(False))
    tagged = stored(
        union_tagged(
            {
                name: df.select(
                    "event_id", "event_name", "source", "glide", nonempty(F.col("glide")).alias("has_code"), located.alias("has_place"))
                for name, df in {"a": a, "b": b, "merged": merged}.items()
            }, "section"),
        "matching")
    total = F.count(F.lit(1))
    counts = tagged.groupingSets([["section"], ["section", "source"]], "section", "source").agg(
        F.grouping("source").alias("all"), total.alias("n"), _count(F.col("has_code")).alias("with_code"), _count(F.col("has_place")).alias("with_places"))
    pct = F.coalesce(F.round(100.0 * F.col("with_places") / F.nullif("n", F.lit(0)), 1), F.lit(0.0))
    metric = lambda name, value: F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
    shown = (
        F.when((F.col("section") == "a") & (F.col("all") == 1), F.array(
            metric("total_a", F.col("n")), metric("a_with_code", F.col("with_code")), metric("a_without_code", F.col("n") - F.col("with_code"))))
        .when((F.col("section") == "b") & (F.col("all") == 1), F.array(
            metric("total_b", F.col("n")), metric("b_with_code", F.col("with_code")), metric("b_without_code", F.col("n") - F.col("with_code")),
            metric("b_with_places", F.col("with_places")), metric("b_places_pct", pct)))
        .when((F.col("section") == "merged") & (F.col("all") == 1), F.array(metric("total_merged", F.col("n"))))
        .when(F.col("section") == "merged", F.array(F.struct(
            F.concat(F.lit("source_"), F.coalesce("source", F.lit("NULL"))).alias("metric"), F.col("n").cast("double").alias("value"))))
    )
    totals = counts.select(F.explode(shown).alias("m")).select("m.*")
    part = lambda name: tagged.where(F.col("section") == name)
    names = code_semi(part("b"), part("a"), "event_id", "glide").select("event_name", F.lit(1).alias("matched"))
    matched = names.unionByName(part("b").select(F.lit(None).cast("string").alias("event_name"), F.lit(0).alias("matched"))).agg(
        F.countDistinct("event_name").alias("b_matched"), _count(F.col("matched") == 0).alias("n"))
    matches = matched.select(F.explode(F.array(
        metric("b_matched", F.col("b_matched")), metric("b_unmatched", F.col("n") - F.col("b_matched")))).alias("m")).select("m.*")
    return totals.unionByName(matches)


def event_completeness(events: DataFrame, columns: Sequence[str] = tuple(EVENT_COLUMNS)) -> DataFrame:
    return completeness(events, columns, by="source")


def grid_completeness(obs: DataFrame) -> DataFrame:
    """Per gridded dataset: rows, mean and median missing share, rows below limits, variables, units.

    The table is first reduced to one row per (dataset, variable, unit); the
    distinct counts then run on that small table instead of expanding every row.
    """
    mine = stored(obs.where(F.col("dataset").isin(GRID_DATASETS)).select("dataset", "variable", "gid", "missing_value_percentage"), "grid-rows")
    m = F.col("missing_value_percentage")
    small = mine.groupBy("dataset", "variable", "gid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(m).alias("s"), F.count(m).alias("c"),
        _count(m < 10).alias("u10"), _count(m < 30).alias("u30"),
    )
    main = small.groupBy("dataset").agg(
        F.sum("n").alias("records"),
        F.coalesce(F.sum("s") / F.nullif(F.sum("c"), F.lit(0)), F.lit(0.0)).alias("avg_missing"),
        F.sum("u10").alias("under_10"), F.sum("u30").alias("under_30"),
        F.countDistinct("variable").alias("n_variables"), F.countDistinct("gid").alias("n_units"),
    )
    return main.join(median_missing(mine), "dataset")


def median_missing(obs: DataFrame) -> DataFrame:
    """Exact median of the missing share per dataset; 0 when there is none."""
    return group_medians(obs, "dataset", "missing_value_percentage", "median_missing", 0.0)


def _named_reduced(obs: DataFrame) -> DataFrame:
    return obs.groupBy("dataset", "variable", "gid").agg(
        F.count(F.lit(1)).alias("n"), F.count("raw_value").alias("v")
    )


def named_completeness(obs: DataFrame) -> DataFrame:
    """Per name-matched dataset: rows, variables, units, rows with a value."""
    return _named_reduced(obs.where(F.col("dataset").isin(NAMED_DATASETS))).groupBy("dataset").agg(
        F.sum("n").alias("records"), F.countDistinct("variable").alias("n_variables"),
        F.countDistinct("gid").alias("n_units"), F.sum("v").alias("with_value"),
    )


def temporal_coverage(events: DataFrame, obs: DataFrame) -> DataFrame:
    """First and last date, distinct dates and distinct units per table."""
    def covered(df: DataFrame, table, date: str, unit: str) -> DataFrame:
        return (
            df.groupBy(table.alias("table_name"), F.col(date).alias("d"), F.col(unit).alias("u")).agg(F.lit(1).alias("x"))
            .groupBy("table_name")
            .agg(
                F.min("d").alias("min_date"), F.max("d").alias("max_date"),
                F.countDistinct("d").alias("n_dates"), F.countDistinct("u").alias("n_units"),
            )
        )

    return covered(events, F.lit("events"), "start_date", "iso3_code").unionByName(
        covered(obs, F.col("dataset"), "date", "gid")
    )


def referential_integrity(events: DataFrame, units: DataFrame, obs: DataFrame) -> DataFrame:
    """Events with a known country, and distinct variables overall, as (metric, value)."""
    countries = units.where("admin_level = 0").select(F.col("iso3").alias("_iso")).distinct()
    checked = events.select(F.col("iso3_code")).groupBy("iso3_code").agg(F.count(F.lit(1)).alias("n")).join(
        countries, F.col("iso3_code") == F.col("_iso"), "left"
    )
    ev = checked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events_total"),
        F.coalesce(F.sum(F.when(F.col("_iso").isNotNull(), F.col("n"))), F.lit(0)).alias("events_valid_country"),
    )
    rows = ev.unpivot([], ["events_total", "events_valid_country"], "metric", "value")
    variables = obs.select("variable").distinct().agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("distinct_variables").alias("metric"), "value"
    )
    return rows.unionByName(variables)


def type_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of same-country event pairs sharing a code, by type and year of both sides."""
    left = a.select("event_id", "glide", "iso3_code", F.col("disaster_type").alias("a_type"), F.year("start_date").alias("a_year"))
    right = b.select("event_id", "glide", "iso3_code", F.col("disaster_type").alias("b_type"), F.year("start_date").alias("b_year"))
    return code_pair_counts(
        left, right, "event_id", "glide", "iso3_code", ["a_type", "a_year"], ["b_type", "b_year"]
    )


def consistency(a: DataFrame, b: DataFrame) -> DataFrame:
    """Agreement of the two sources on shared events, as (metric, value) rows."""
    pairs = type_pairs(a, b)
    n = F.col("n_pairs")
    agreed = pairs.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_pairs"),
        F.coalesce(F.sum(F.when(F.col("a_type") == F.col("b_type"), n)), F.lit(0)).alias("same_type"),
        F.coalesce(F.sum(F.when(F.col("a_year") == F.col("b_year"), n)), F.lit(0)).alias("same_year"),
    )
    codes = shared_code_countries(a, b, "glide", "iso3_code").agg(
        F.count(F.lit(1)).alias("shared_codes"), _count(F.col("total_countries") > 2).alias("multi_country_codes")
    )
    melt = lambda df: df.unpivot([], df.columns, "metric", "value")
    return melt(agreed).unionByName(melt(codes))


def type_mismatches(a: DataFrame, b: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent disagreements on the event type."""
    pairs = type_pairs(a, b).where(F.col("a_type") != F.col("b_type"))
    return top_k(
        pairs.groupBy("a_type", "b_type").agg(F.sum("n_pairs").alias("n_pairs")), k, ["n_pairs"], ["a_type", "b_type"]
    )


def countries_by_source(events: DataFrame) -> DataFrame:
    """Distinct countries and events, overall (source ``ALL``) and per source."""
    small = stored(events.groupBy("source", "iso3_code").agg(F.count(F.lit(1)).alias("n")), "per-country")
    per = small.groupBy(F.coalesce("source", F.lit("NULL")).alias("source")).agg(
        F.countDistinct("iso3_code").alias("countries"), F.sum("n").alias("events")
    )
    total = small.agg(F.countDistinct("iso3_code").alias("countries"), F.sum("n").alias("events")).select(
        F.lit("ALL").alias("source"), "countries", "events"
    )
    return total.unionByName(per)


def top_countries(events: DataFrame, k: int = 20) -> DataFrame:
    """Countries with most events: a name, event count, hazard variety, source list."""
    small = (
        events.where(F.col("iso3_code").isNotNull())
        .groupBy("iso3_code", "source", "disaster_type")
        .agg(F.count(F.lit(1)).alias("n"), F.max("admin_level_0").alias("name"))
    )
    per = small.groupBy("iso3_code").agg(
        F.max("name").alias("country_name"), F.sum("n").alias("event_count"),
        F.countDistinct("disaster_type").alias("hazard_types"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
    )
    return top_k(per, k, ["event_count"], ["iso3_code"])


def type_distribution(events: DataFrame, k: int = 25) -> DataFrame:
    """Events per group, per type (with countries) and for the top-k subtypes."""
    small = stored(events.groupBy("disaster_group", "disaster_type", "disaster_subtype", "iso3_code").agg(
        F.count(F.lit(1)).alias("n")
    ), "per-type")
    none = F.lit(None)
    groups = small.groupBy("disaster_group").agg(F.sum("n").alias("events")).select(
        F.lit("group").alias("section"), F.coalesce("disaster_group", F.lit(NOT_CLASSIFIED)).alias("name"),
        none.cast("string").alias("subtype"), "events", none.cast("bigint").alias("countries"),
    )
    types = small.groupBy("disaster_type").agg(
        F.sum("n").alias("events"), F.countDistinct("iso3_code").alias("countries")
    ).select(
        F.lit("type").alias("section"), F.coalesce("disaster_type", F.lit(NO_VALUE)).alias("name"),
        none.cast("string").alias("subtype"), "events", "countries",
    )
    subtypes = top_k(
        small.groupBy("disaster_type", "disaster_subtype").agg(F.sum("n").alias("events")).select(
            F.lit("subtype").alias("section"), F.coalesce("disaster_type", F.lit(NO_VALUE)).alias("name"),
            F.coalesce("disaster_subtype", F.lit(NO_VALUE)).alias("subtype"), "events",
            none.cast("bigint").alias("countries"),
        ),
        k, ["events"], ["name", "subtype"],
    )
    return groups.unionByName(types).unionByName(subtypes)


def observation_coverage(obs: DataFrame) -> DataFrame:
    """Per dataset: rows, countries, list of levels, units."""
    small = obs.groupBy("dataset", "admin_level", "gid").agg(F.count(F.lit(1)).alias("n"))
    return small.groupBy("dataset").agg(
        F.sum("n").alias("records"),
        F.countDistinct(F.substring("gid", 1, 3)).alias("countries"),
        F.array_join(F.array_sort(F.collect_set(F.col("admin_level").cast("string"))), ", ").alias("levels"),
        F.countDistinct("gid").alias("n_units"),
    )


def country_overlap(events: DataFrame, obs: DataFrame, dataset: str = "climate") -> DataFrame:
    """Countries with events, with observations, with both: one row.

    Both key sets are stacked and counted per country, so there is no join.
    """
    ev = events.where(F.col("iso3_code").isNotNull()).select(
        F.col("iso3_code").alias("iso3"), F.lit(1).alias("e"), F.lit(0).alias("g")
    )
    geo = obs.where(F.col("dataset") == dataset).select(
        F.substring("gid", 1, 3).alias("iso3"), F.lit(0).alias("e"), F.lit(1).alias("g")
    )
    per = ev.unionByName(geo).groupBy("iso3").agg(F.max("e").alias("e"), F.max("g").alias("g"))
    return per.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("event_countries"),
        F.coalesce(F.sum("g"), F.lit(0)).alias("observation_countries"),
        F.coalesce(F.sum(F.col("e") * F.col("g")), F.lit(0)).alias("both"),
    )


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows per key value that has no parent row."""
    counted = df.groupBy(F.col(key).alias("orphan")).agg(F.count(F.lit(1)).alias("n_rows"))
    p = parents.select(F.col(parent_key).alias("orphan")).distinct()
    return counted.join(p, "orphan", "left_anti")


def constraint_violations(df: DataFrame, rules: TableRules, table: str) -> DataFrame:
    """Nulls in required columns and texts over their length: one scan, counts only."""
    checks = {f"{c} is null": F.col(c).isNull() for c in rules.required if c in df.columns}
    checks |= {f"{c} longer than {n}": F.length(c) > n for c, n in rules.max_length.items() if c in df.columns}
    counts = df.agg(*[_count(cond).alias(name) for name, cond in checks.items()])
    return counts.unpivot([], [f"`{c}`" for c in checks], "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def parent_violations(units: DataFrame) -> DataFrame:
    """Units whose parent id is no unit of the level above."""
    parents = units.select(F.col("gid").alias("_p"), (F.col("admin_level") + 1).alias("_l"))
    return units.where(F.col("admin_level") > 0).join(
        parents, (F.col("parent_gid") == F.col("_p")) & (F.col("admin_level") == F.col("_l")), "left_anti"
    ).select("gid", "admin_level", "parent_gid")


def run_sections(spark: SparkSession, sections: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """All report sections as (section, line, error) rows; a failing one is one error row.

    Each section runs once, on its own, and its lines are kept in the scratch
    folder; a failure in planning or running it is isolated.
    """
    parts = []
    for name, build in sections.items():
        try:
            df = build()
            lines = df.select(
                F.lit(name).alias("section"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("line"),
                F.lit(None).cast("string").alias("error"),
            )
            path = scratch_path(spark, f"report-{name}")
            lines.write.parquet(path)
            parts.append(spark.read.schema(lines.schema).parquet(path))
        except Exception as problem:  # noqa: BLE001 - any failure becomes a row
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("section"), F.lit(None).cast("string").alias("line"),
                    F.lit(type(problem).__name__).alias("error"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


