"""Observation tables and materialised views, loaded and refreshed by partition.

Both are folders per dataset and level. A batch touches few of them; only those are
merged, and only those partitions of a view are built again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.operators.keys import upsert
from atlasweave.schemas import OBSERVATION_KEY, OBSERVATION_VALUES
from atlasweave.session import stored
from atlasweave.sources import sinks

PARTITIONS = ["dataset", "admin_level"]

Touched = list[tuple[str, int]]


def touched_partitions(batch: DataFrame) -> Touched:
    """The (dataset, level) pairs of a batch: at most the number of datasets times that of levels."""
    return sorted(tuple(r) for r in batch.select(*PARTITIONS).distinct().collect())


def only(df: DataFrame, touched: Touched) -> DataFrame:
    """Rows of the touched partitions; a filter on partition columns, so other folders are not opened."""
    wanted = [(F.col("dataset") == dataset) & (F.col("admin_level") == level) for dataset, level in touched]
    return df.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def load_observations(
    spark: SparkSession, path: str, batch: DataFrame, order: Sequence[str], replaced: Sequence[str] = tuple(OBSERVATION_VALUES)
) -> Touched:
    """Upsert a batch into the observation table at ``path``. -> the partitions it touched

    The merged partitions are stored before they replace the old ones, so a failed
    task reads what it read before.
    """
    batch = stored(batch, "batch")
    touched = touched_partitions(batch)
    mine = only(spark.read.parquet(path), touched)
    columns = [c for c in replaced if c in mine.columns]
    merged = stored(upsert(mine, batch, ["dataset", *OBSERVATION_KEY], columns, order), "merged")
    if touched:
        sinks.replace_partitions(merged, path, PARTITIONS)
    return touched


def refresh_view(
    spark: SparkSession, view: str, observations: str, build: Callable[[DataFrame], DataFrame], touched: Touched
) -> None:
    """Build the touched partitions of ``view`` again from those of the observation table.

    ``build`` makes view rows, with dataset and level, of observations; each row of the
    view must depend on observations of its own partition only.
    """
    if touched:
        rows = build(only(spark.read.parquet(observations), touched))
        sinks.replace_partitions(rows, view, PARTITIONS)
