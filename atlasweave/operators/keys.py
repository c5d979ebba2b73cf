"""Row selection and identity per key: first, last, upsert, ids, top-k.

A pick per key is an aggregate over a packed row (``min_by`` / ``max_by``), not
a ranking window: rows of one key are reduced on the map side before the
shuffle, so a key that holds a third of the table is no heavier than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.session import stored


def _rest(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(keys)]


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (which must be unique in a key)."""
    rest = _rest(df, keys)
    pick = F.min_by(F.struct(*rest), _order_struct(order)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``order``."""
    rest = _rest(df, keys)
    pick = F.max_by(F.struct(*rest), _order_struct(order)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, "_row.*").select(*df.columns)


def _known_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming keys that exist already.

    Semi-joining the key columns of the large table with the incoming keys lets
    the optimizer broadcast the incoming side when it is small, so loading a
    small batch does not shuffle the table.
    """
    return existing.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of ``incoming`` whose key is new, one (the first) per key.

    A key with a null part never conflicts, as in SQL, so such rows all pass.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    incoming = stored(incoming, "incoming")
    keyed = keep_first(incoming.where(~has_null), keys, order)
    new = keyed.join(_known_keys(existing, keyed, keys), list(keys), "left_anti")
    return new.select(*incoming.columns).unionByName(incoming.where(has_null))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    replaced: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """``existing`` (unique, non-null keys) after loading ``incoming``.

    The last incoming row wins per key. Only the ``replaced`` columns change on a
    conflict; the other columns keep the value of the row that created the key.
    ``order`` names columns of ``incoming`` that fix the load order. The batch is
    reduced to one row per key first; both joins can then broadcast it.
    """
    others = [c for c in existing.columns if c not in set(keys) | set(replaced)]
    by = _order_struct(order)
    aggs = [F.max_by(F.struct(*replaced), by).alias("_new")]
    if others:
        aggs.append(F.min_by(F.struct(*others), by).alias("_first"))
    batch = stored(incoming.groupBy(*keys).agg(*aggs), "batch")
    hit = F.col("_new").isNotNull()
    changed = existing.join(batch.select(*keys, "_new"), list(keys), "left").select(
        *keys,
        *[F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in replaced],
        *others,
    )
    added = batch.join(_known_keys(existing, batch, keys), list(keys), "left_anti").select(
        *keys,
        *[F.col("_new")[c].alias(c) for c in replaced],
        *[F.col("_first")[c].alias(c) for c in others],
    )
    return changed.unionByName(added).select(*existing.columns)


def hash_id(columns: Sequence[str], bits: int = 60) -> Column:
    """A repeatable non-negative id from the columns' text, without any shuffle."""
    digest = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("bigint")


def dense_id(df: DataFrame, key: str, name: str = "id", digits: int = 4) -> DataFrame:
    """Number the rows 1..n without gaps, in parallel and repeatably.

    A global ``row_number`` would sort everything in one task. Rows are spread
    evenly over ``16 ** digits`` buckets by the hash of a unique ``key``, numbered
    inside their bucket by ``key``, and shifted by the size of earlier buckets.
    """
    spread = df.withColumn("_slice", F.substring(F.sha2(F.col(key).cast("string"), 256), 1, digits))
    sizes = spread.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket reaches this window, however many rows are numbered
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(key))
    return (
        spread.withColumn("_rn", within)
        .join(before, "_slice")
        .withColumn(name, (F.col("_before") + F.col("_rn")).cast("bigint"))
        .drop("_slice", "_rn", "_before")
    )


def top_k(df: DataFrame, k: int, by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The k largest rows by ``by``; ``ties`` (ascending) make the cut repeatable."""
    return df.orderBy(*[F.col(c).desc() for c in by], *[F.col(c).asc() for c in ties]).limit(k)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
