"""Summaries used by the reports: completeness, profiles, exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.session import sized_broadcast, stored


def value_counts(df: DataFrame, column: str, name: str = "n_rows") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(column))


def filled(df: DataFrame, column: str) -> Column:
    """True where a column has content; an empty array has none."""
    if df.schema[column].dataType.typeName() == "array":
        return F.coalesce(F.size(column) > 0, F.lit(False))
    return F.col(column).isNotNull()


def completeness(df: DataFrame, columns: Sequence[str], by: str | None = None, all_label: str = "ALL") -> DataFrame:
    """Rows with content and their percentage per column, for all rows and per ``by``.

    The table is read once: every column is counted in the same aggregation, the
    totals are added up from the groups.
    -> (subset, column_name, total, non_null, pct)
    """
    group = F.col(by) if by else F.lit(None).cast("string")
    counts = df.groupBy(group.alias("subset")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(filled(df, c), 1)).alias(c) for c in columns],
    )
    long = counts.unpivot(["subset", "total"], list(columns), "column_name", "non_null")
    # the groups and their total come out of one aggregation; rows without a group count in the total only
    both = long.groupingSets([["column_name", "subset"], ["column_name"]], "column_name", "subset").agg(
        F.grouping("subset").alias("_all"), F.sum("total").alias("total"), F.sum("non_null").alias("non_null"))
    rows = both.where((F.col("_all") == 1) | (F.lit(by is not None) & F.col("subset").isNotNull())).select(
        F.when(F.col("_all") == 1, F.lit(all_label)).otherwise(F.col("subset")).alias("subset"), "column_name", "total", "non_null")
    pct = F.when(F.col("total") > 0, F.round(100.0 * F.col("non_null") / F.col("total"), 1)).otherwise(0.0)
    return rows.withColumn("pct", pct)


# A double's fields: 52 bits of mantissa below an exponent that is 1023 for 1.0.
_MANTISSA, _BIAS = 2.0**52, 1023


def order_key(value: Column) -> Column:
    """A double as a whole number in the same order: equal values, and only they, have equal keys.

    The key of a positive number is its exponent and mantissa side by side, that of a
    negative one the same, negated. Built by exact arithmetic: scaling by powers of two
    loses no bit. Both zeros are equal, NaN comes last.
    """
    size = F.abs(value)
    tiny = size < 2.0**-1022  # no leading one; scaled in two steps, as 2^1074 is no double
    guess = F.least(F.floor(F.log2(size)), F.lit(_BIAS))
    scale = F.pow(F.lit(2.0), guess.cast("double"))
    over, under = size / scale >= 2, size / scale < 1  # log2 may round across a power of two
    exponent = guess + F.when(over, 1).when(under, -1).otherwise(0)
    fraction = size / scale * F.when(over, 0.5).when(under, 2.0).otherwise(1.0) - 1
    normal = (exponent + _BIAS) * int(_MANTISSA) + (fraction * _MANTISSA).cast("long")
    key = (
        F.when(F.isnan(value), F.lit(2047 * 2**52 + 2**51))
        .when(size == float("inf"), F.lit(2047 * 2**52))
        .when(tiny, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise(normal)
    )
    return F.when(value < 0, -key).otherwise(key)


def of_order_key(key: Column) -> Column:
    """The double of an :func:`order_key`."""
    size = F.abs(key)
    exponent = F.shiftright(size, 52)
    mantissa = size.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    number = (
        F.when(size > 2047 * 2**52, F.lit(float("nan")))
        .when(exponent == 2047, F.lit(float("inf")))
        .when(exponent == 0, mantissa * 2.0**-537 * 2.0**-537)
        .otherwise((mantissa / _MANTISSA + 1) * F.pow(F.lit(2.0), (exponent - _BIAS).cast("double")))
    )
    return F.when(key < 0, -number).otherwise(number)


#: Bits of a key that one pass of the selection tells apart.
_DIGIT = 16


def key_rows(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, key) of every row, null keys included, stored: the only time ``df`` is read."""
    return stored(df.select(F.col(group).alias("group"), order_key(F.col(value).cast("double")).alias("key")), "keys")


def _bins(rows: DataFrame, shift: int, *by: str) -> DataFrame:
    """Per ``by``: the values of the next digit in order, each with its row count, least and greatest key.

    Rows are counted before the shuffle; at most 2^16 bins a group leave it.
    """
    counted = rows.groupBy(*by, F.shiftright("key", shift).alias("digit")).agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    return counted.groupBy(*by).agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("digit", "n", "lo", "hi"))).alias("bins"))


# The bin that holds row number ``rank``, and how many rows the bins before it have.
_HOLDING = """aggregate(bins, named_struct('before', 0L, 'bin', cast(null as struct<digit: bigint, n: bigint, lo: bigint, hi: bigint>)),
    (s, x) -> if(s.bin is not null, s, if(rank < s.before + x.n, named_struct('before', s.before, 'bin', x),
                                          named_struct('before', s.before + x.n, 'bin', s.bin))))"""


def key_quantiles(rows: DataFrame, probs: Sequence[float], most: int = 1_000_000) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``rows`` (group, key) -> (group, prob, quantile).

    Radix selection: a first pass counts the first 16 bits of all keys, which tells the bin
    that holds each wanted row; later passes take the next 16 bits of the rows in those bins
    only. A bin of one distinct key is done, so values that fill half a table end the search.
    No rows are ranked and none are dealt by group: each pass counts on the map side.
    Up to ``most`` bins that are still open meet the rows as a counted broadcast.
    """
    rows = rows.where("key IS NOT NULL")
    position = F.col("prob") * (F.col("total") - 1)
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.floor(position).alias("rank")), F.struct(F.lit(1).alias("end"), F.ceil(position).alias("rank"))))
    picked = lambda df: df.withColumn("at", F.expr(_HOLDING)).select(
        "group", "prob", "end", "part", (F.col("rank") - F.col("at.before")).alias("rank"),
        F.col("at.bin.digit").alias("digit"), F.col("at.bin.lo").alias("lo"), F.col("at.bin.hi").alias("hi"))
    shift = 64 - _DIGIT
    asked = _bins(rows, shift, "group").withColumn("prob", F.explode(F.array(*[F.lit(p) for p in probs])))
    now = stored(picked(asked.select("group", "bins", "prob", (position - F.floor(position)).alias("part"), ends.alias("e")).select(
        "group", "bins", "prob", "part", "e.end", "e.rank")), "selection")
    done = []
    while True:
        done.append(now.where("lo = hi"))
        wanted = now.where("lo < hi")
        if shift == 0 or wanted.isEmpty():
            break
        bins = wanted.select(F.col("group").alias("g"), F.col("digit").alias("d")).distinct()
        rows = stored(rows.join(
            sized_broadcast(bins, most), F.col("group").eqNullSafe(F.col("g")) & (F.shiftright("key", shift) == F.col("d"))
        ).select("group", "key"), "in-bins")
        upper, shift = shift, shift - _DIGIT
        finer = _bins(rows.withColumn("d", F.shiftright("key", upper)), shift, "group", "d").select(F.col("group").alias("g"), "d", "bins")
        now = stored(picked(wanted.join(finer, F.col("group").eqNullSafe(F.col("g")) & (F.col("digit") == F.col("d")))), "selection")
    value = lambda end: F.max(F.when(F.col("end") == end, of_order_key(F.col("lo"))))
    return (
        reduce(DataFrame.unionByName, done)
        .groupBy("group", "prob", "part").agg(value(0).alias("a"), value(1).alias("b"))
        .select("group", "prob", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
            F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("quantile"))
    )


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group -> (group, prob, quantile); groups without a value have none."""
    return key_quantiles(key_rows(df, group, value), probs).withColumnRenamed("group", group)


def group_medians(df: DataFrame, group: str, value: str, name: str, default: float) -> DataFrame:
    """The exact median of every group of ``df``, which is read once; ``default`` where a group has no value."""
    rows = key_rows(df, group, value)
    medians = key_quantiles(rows, [0.5]).select(F.col("group").alias("g"), F.col("quantile").alias(name))
    return rows.select("group").distinct().join(medians, F.col("group").eqNullSafe(F.col("g")), "left").select(
        F.col("group").alias(group), F.coalesce(name, F.lit(default)).alias(name))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row each."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    rows = key_rows(long, "column_name", "value")
    basic = rows.select(F.col("group").alias("column_name"), of_order_key(F.col("key")).alias("value")).groupBy("column_name").agg(
        F.count("value").alias("n_values"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    probs = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = key_quantiles(rows, list(probs)).groupBy(F.col("group").alias("column_name")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in probs.items()])
    return basic.join(quartiles, "column_name", "left")
