"""Registered queries over the benchmark tables.

``tables`` maps those tables to the canonical ones; every other module registers
queries with :func:`query`. A query's SQL twin, where SQL can say it, is written
against the same mapping (see ``sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atlasweave.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB twin."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load_all() -> None:
    from atlasweave.workloads import (  # noqa: F401
        event_jobs,
        grid_jobs,
        indicator_jobs,
        join_jobs,
        report_jobs,
        scan_jobs,
        scalar_jobs,
        stream_jobs,
        table_jobs,
        view_jobs,
    )
