"""Joins of event tables on shared codes held in arrays, and code remapping.

Array overlap is always rewritten to hash joins on exploded codes, with one
side reduced to one row per code first. Pairs of rows are built under codes that
few rows share only: a code shared by a third of both tables is counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.session import stored


def exploded_codes(df: DataFrame, keep: Sequence[str], codes: str) -> DataFrame:
    """One row per distinct non-null code of a row, with the ``keep`` columns."""
    return df.select(*keep, F.explode(F.array_distinct(codes)).alias("code")).where(
        F.col("code").isNotNull()
    )


def _ids_with_shared_code(left: DataFrame, right: DataFrame, row_id: str, codes: str) -> DataFrame:
    known = exploded_codes(right, [], codes).distinct()
    return (
        exploded_codes(left, [row_id], codes)
        .join(known, "code", "left_semi")
        .select(row_id)
        .distinct()
    )


def code_semi(left: DataFrame, right: DataFrame, row_id: str, codes: str) -> DataFrame:
    """Rows of ``left`` that share at least one code with ``right``."""
    return left.join(_ids_with_shared_code(left, right, row_id, codes), row_id, "left_semi")


def code_anti(left: DataFrame, right: DataFrame, row_id: str, codes: str) -> DataFrame:
    """Rows of ``left`` that share no code with ``right``."""
    return left.join(_ids_with_shared_code(left, right, row_id, codes), row_id, "left_anti")


def update_from(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, codes: str, value: str
) -> DataFrame:
    """Copy ``value`` of the matching right row onto ``left``.

    Of several matches the smallest ``right_id`` wins. Right rows are first
    reduced to the winner per code, so the join adds no rows.
    """
    best = exploded_codes(right, [right_id, value], codes).groupBy("code").agg(
        F.min_by(F.struct(F.col(right_id).alias("i"), F.col(value).alias("v")), F.col(right_id)).alias("m")
    )
    matched = (
        exploded_codes(left, [left_id], codes)
        .join(best, "code")
        .groupBy(left_id)
        .agg(F.min_by("m", F.col("m.i")).alias("_match"))
    )
    return (
        left.join(matched, left_id, "left")
        .withColumn(value, F.when(F.col("_match").isNotNull(), F.col("_match.v")).otherwise(F.col(value)))
        .drop("_match")
        .select(*left.columns)
    )


def shared_code_countries(
    left: DataFrame, right: DataFrame, codes: str, country: str
) -> DataFrame:
    """Per shared code: how many countries carry it on each side, and in total."""

    def per_code(df: DataFrame, name: str) -> DataFrame:
        return exploded_codes(df, [country], codes).groupBy("code").agg(
            F.countDistinct(country).alias(name)
        )

    return (
        per_code(left, "left_countries")
        .join(per_code(right, "right_countries"), "code")
        .withColumn("total_countries", F.col("left_countries") + F.col("right_countries"))
    )


def code_pair_counts(
    left: DataFrame,
    right: DataFrame,
    row_id: str,
    codes: str,
    country: str,
    left_attrs: Sequence[str],
    right_attrs: Sequence[str],
    light: int = 10_000,
) -> DataFrame:
    """Number of same-country row pairs sharing a code, by the sides' attributes.

    A code's weight is the number of row pairs it makes in a country.

    * Codes of at most ``light`` pairs are joined directly. A pair that shares several
      counts at the smallest of them, and not here if it also shares a heavier code.
    * Pairs that share a heavier code are never made. The distinct sets of heavy codes of
      a country are a dictionary; sets of both sides are joined at the smallest heavy
      code they share, so each pair of sets meets once however many codes a set has,
      and what meets is multiplied by the counts of rows per set and attributes.

    Every pair is in exactly one of the two parts. Both tables are read once, as their
    exploded codes are stored. Attribute columns must have different names on the two sides.
    """

    def exploded(df: DataFrame, attrs: Sequence[str], side: str) -> DataFrame:
        return stored(exploded_codes(df, [row_id, country, *attrs], codes), f"codes-{side}")

    le, re = exploded(left, left_attrs, "l"), exploded(right, right_attrs, "r")
    carried = lambda df, name: df.groupBy(country, "code").agg(F.count(F.lit(1)).alias(name))
    weighed = stored(
        carried(le, "wl").join(carried(re, "wr"), [country, "code"]).select(
            country, "code", (F.col("wl") * F.col("wr") > light).alias("heavy")), "weights")

    def profiles(df: DataFrame, attrs: Sequence[str], side: str) -> DataFrame:
        listed = lambda cond: F.sort_array(F.collect_set(F.when(cond, F.col("code"))))
        rows = (
            df.join(weighed, [country, "code"])
            .groupBy(row_id, country, *attrs)
            .agg(listed(F.col("heavy")).alias(f"heavy_{side}"), listed(~F.col("heavy")).alias(f"light_{side}"))
            .groupBy(country, *attrs, f"heavy_{side}", f"light_{side}")
            .agg(F.count(F.lit(1)).alias(f"n_{side}"))
        )
        return stored(rows, f"profiles-{side}")

    lp, rp = profiles(le, left_attrs, "l"), profiles(re, right_attrs, "r")

    def counted(df: DataFrame, attrs: Sequence[str], side: str) -> DataFrame:
        return df.where(F.size(f"heavy_{side}") > 0).groupBy(country, f"heavy_{side}", *attrs).agg(F.sum(f"n_{side}").alias(f"n_{side}"))

    def dictionary(df: DataFrame, side: str) -> DataFrame:
        sets = df.where(F.size(f"heavy_{side}") > 0).select(country, f"heavy_{side}").distinct()
        return sets.withColumn("code", F.explode(f"heavy_{side}"))

    product = F.col("n_l") * F.col("n_r")
    met = (
        dictionary(lp, "l")
        .join(dictionary(rp, "r"), [country, "code"])
        .where(F.col("code") == F.array_min(F.array_intersect("heavy_l", "heavy_r")))
        .select(country, "heavy_l", "heavy_r")
    )
    heavy_pairs = (
        met.join(counted(lp, left_attrs, "l"), [country, "heavy_l"])
        .join(counted(rp, right_attrs, "r"), [country, "heavy_r"])
        .select(country, *left_attrs, *right_attrs, product.alias("n_pairs"))
    )
    light_pairs = (
        lp.withColumn("code", F.explode("light_l"))
        .join(rp.withColumn("code", F.explode("light_r")), [country, "code"])
        .where(
            (F.col("code") == F.array_min(F.array_intersect("light_l", "light_r")))
            & ~F.arrays_overlap("heavy_l", "heavy_r")
        )
        .select(country, *left_attrs, *right_attrs, product.alias("n_pairs"))
    )
    return (
        heavy_pairs.unionByName(light_pairs)
        .groupBy(country, *left_attrs, *right_attrs)
        .agg(F.sum("n_pairs").alias("n_pairs"))
    )


def map_pair(
    df: DataFrame,
    mapping: DataFrame,
    pair: tuple[str, str],
    mapped: tuple[str, str],
    order: str,
    outputs: tuple[str, str],
) -> DataFrame:
    """Translate a (type, subtype) pair; a pair without an entry stays as it is.

    The second key compares null-safe. Of several entries for a pair the last
    (by ``order``) wins. Entries whose both keys are null are ignored.
    """
    a, b = pair
    entries = (
        mapping.where(F.col(a).isNotNull() | F.col(b).isNotNull())
        .groupBy(F.col(a).alias("_ka"), F.col(b).alias("_kb"))
        .agg(F.max_by(F.struct(F.col(mapped[0]).alias("x"), F.col(mapped[1]).alias("y")), order).alias("_to"))
    )
    joined = df.join(
        entries, F.col(a).eqNullSafe(F.col("_ka")) & F.col(b).eqNullSafe(F.col("_kb")), "left"
    )
    hit = F.col("_to").isNotNull()
    return (
        joined.withColumn(outputs[0], F.when(hit, F.col("_to.x")).otherwise(F.col(a)))
        .withColumn(outputs[1], F.when(hit, F.col("_to.y")).otherwise(F.col(b)))
        .drop("_ka", "_kb", "_to")
    )


@dataclass(frozen=True)
class CountryRemap:
    """Rewrite one country code; optionally append a place to a level's list.

    ``append`` is the text to add, or ``None`` for the old country name.
    """

    old: str
    iso3: str
    country: str
    append_level: int | None = None
    append: str | None = None


# --- fixed values: territories that belong to another country's geography -----
REMAPS_WITH_PLACES = [
    CountryRemap("HKG", "CHN", "China", 1),
    CountryRemap("MAC", "CHN", "China", 1),
    CountryRemap("ANT", "NLD", "Netherlands", 1),
    CountryRemap("AB9", "SDN", "Sudan", 2, "Abyei Area"),
    CountryRemap("XKK", "XKO", "Kosovo"),
]
REMAPS_PLAIN = [
    CountryRemap("HKG", "CHN", "China"),
    CountryRemap("MAC", "CHN", "China"),
    CountryRemap("ANT", "NLD", "Netherlands"),
    CountryRemap("SCG", "SCG", "Serbia and Montenegro (flagged for review)"),
    CountryRemap("AB9", "SDN", "Sudan"),
    CountryRemap("XKX", "XKO", "Kosovo"),
]
DISPLACEMENT_CODES = {"XKX": "XKO", "AB9": "SDN", "HKG": "CHN", "MAC": "CHN"}


def remap_countries(
    df: DataFrame,
    remaps: Sequence[CountryRemap],
    iso3: str,
    country: str,
    admin1: str | None = None,
    admin2: str | None = None,
) -> DataFrame:
    """Apply the remaps in one projection (a chain of CASE branches, no join)."""

    def chain(default: Column, choose) -> Column:
        out = default
        for r in reversed(list(remaps)):
            value = choose(r)
            if value is not None:
                out = F.when(F.col(iso3) == r.old, value).otherwise(out)
        return out

    new_iso = chain(F.col(iso3), lambda r: F.lit(r.iso3))
    new_country = chain(F.col(country), lambda r: F.lit(r.country))
    changes = {iso3: new_iso, country: new_country}
    for level, name in ((1, admin1), (2, admin2)):
        if name is None:
            continue

        def appended(r: CountryRemap, level=level, name=name):
            if r.append_level != level:
                return None
            text = F.lit(r.append) if r.append is not None else F.col(country)
            return F.array_append(F.col(name), text)

        changes[name] = chain(F.col(name), appended)
    return df.withColumns(changes)


def remap_codes(col: Column, mapping: dict[str, str]) -> Column:
    """Replace the listed codes, keep the others."""
    out = col
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out
