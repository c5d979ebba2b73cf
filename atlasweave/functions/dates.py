"""Dates from parts, years, paths and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partial_date(year: Column, month: Column, day: Column) -> Column:
    """Date from parts; a missing month or day is 1; an impossible date is null."""
    text = F.format_string(
        "%04d-%02d-%02d",
        year.cast("int"),
        F.coalesce(month.cast("int"), F.lit(1)),
        F.coalesce(day.cast("int"), F.lit(1)),
    )
    return F.when(year.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def clamp_end(start: Column, end: Column) -> Column:
    """An end before its start becomes the start; a null end stays null."""
    return F.when(end < start, start).otherwise(end)


def year_to_date(year: Column) -> Column:
    """January 1 of a year."""
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def date_from_path(path: Column) -> Column:
    """January 1 of the last four-digit folder name in a path, else null."""
    year = F.regexp_extract(path, r"^.*/(\d{4})/", 1)
    return F.when(year != "", F.make_date(year.cast("int"), F.lit(1), F.lit(1)))


def date_from_name(name: Column) -> Column:
    """``AYYYYDDD`` (day of year) or ``YYYYMMDD`` inside a file name, else null."""
    julian = F.regexp_extract(name, r"\.A(\d{7})\.", 1)
    plain = F.regexp_extract(name, r"(?:^|\D)(\d{8})(?:\D|$)", 1)
    from_julian = F.date_add(
        F.make_date(F.substring(julian, 1, 4).cast("int"), F.lit(1), F.lit(1)),
        F.substring(julian, 5, 3).cast("int") - 1,
    )
    return (
        F.when(julian != "", from_julian)
        .when(plain != "", F.try_to_date(plain, "yyyyMMdd"))
    )


def variable_from_name(name: Column) -> Column:
    """Age/sex variable from the ``_`` parts of a raster file name.

    Five parts give the plain form, six or more the dated form, fewer give null.
    """
    parts = F.split(name, "_")
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(
            F.size(parts) == 5,
            F.concat_ws("_", F.lit("population_sex_age"), part(1), part(2), F.lit("count")),
        )
        .when(
            F.size(parts) >= 6,
            F.concat_ws(
                "_", F.lit("2021_2022_population_sex_age"), part(1), part(2), part(3), F.lit("count")
            ),
        )
    )
