"""Long/wide reshaping, tagged unions and hierarchy tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many columns a pivot is one pass of conditional aggregates (one
# shuffle); beyond it Spark's two-step pivot keeps the generated code small.
_ONE_PASS_COLUMNS = 40


def unpivot(
    df: DataFrame, ids: Sequence[str], variables: Sequence[str], name: str = "variable", value: str = "raw_value"
) -> DataFrame:
    """Wide -> long; null values stay."""
    return df.unpivot(list(ids), list(variables), name, value)


def pivot_max(
    df: DataFrame, keys: Sequence[str], variable: str, value: str, labels: Mapping[str, str]
) -> DataFrame:
    """Long -> wide with ``max``; ``labels`` maps known variables to column names.

    Every key of the input has a row, whatever its variables.
    """
    if len(labels) <= _ONE_PASS_COLUMNS:
        return df.groupBy(*keys).agg(
            *[
                F.max(F.when(F.col(variable) == known, F.col(value))).alias(label)
                for known, label in labels.items()
            ]
        )
    wide = df.groupBy(*keys).pivot(variable, list(labels)).agg(F.max(value))
    return wide.select(*keys, *[F.col(f"`{k}`").alias(v) for k, v in labels.items()])


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """UNION ALL of named tables with the name as a column; absent columns are null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def combine_wide(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of many wide tables with unique keys, in one shuffle.

    A chain of full joins shuffles at every step and cannot be reordered. With
    unique, non-null keys it equals the union of the tables followed by one
    aggregation that takes the only non-null value per column.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    values = [c for c in stacked.columns if c not in set(keys)]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def flatten_levels(events: DataFrame) -> DataFrame:
    """One row per event and administrative name: level 0 always, 1 and 2 if listed.

    -> all input columns plus ``admin_level, admin_name``. One generator, so the
    events are read once.
    """

    def named(col: str, level: int) -> Column:
        names = F.coalesce(F.col(col), F.array().cast("array<string>"))
        return F.transform(
            names, lambda n: F.struct(F.lit(level).alias("admin_level"), n.alias("admin_name"))
        )

    zero = F.array(F.struct(F.lit(0).alias("admin_level"), F.col("admin_level_0").alias("admin_name")))
    items = F.concat(zero, named("admin_level_1", 1), named("admin_level_2", 2))
    return events.select("*", F.explode(items).alias("_a")).select(
        *events.columns, "_a.admin_level", "_a.admin_name"
    )


def codes_to_columns(df: DataFrame, codes: str, types: Mapping[str, str]) -> DataFrame:
    """One array column per code type (type -> column name); null when absent."""
    from atlasweave.functions.text import codes_of_type

    return df.withColumns({name: codes_of_type(F.col(codes), kind) for kind, name in types.items()})


def code_types(df: DataFrame, codes: str) -> DataFrame:
    """The distinct code types that occur."""
    return df.select(F.explode(codes).alias("c")).select("c.code_type").distinct()


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select exactly the mapped columns under their new names, in order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])
