"""Text functions: name normalisation, place extraction, typed codes, labels.

Everything is a Column expression, so it runs inside generated code and is
pushed around freely by the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: words and marks that are never a place name ---------------
IGNORED_PLACE_WORDS = [
    "", "incl", "total",
    "north", "south", "east", "west",
    "western", "eastern", "northern", "southern", "central",
    "north-western", "north-eastern", "south-western", "south-eastern",
    "north west", "north east", "south west", "south east",
    "north-west", "north-east", "south-west", "south-east",
    "second 25%", "third 25%", "lowest 25%", "highest 25%",
    "urban", "rural", "poor", "nonpoor",
]
PERCENTAGE_MARKS = ["25%", "50%", "75%", "100%"]
DIRECTION_MARKS = ["north-west", "north-east", "south-west", "south-east"]

# --- fixed values: defaults in an event label ---------------------------------
UNKNOWN_ISO3 = "UNKNOWN-ISO3-CODE"
UNKNOWN_TYPE = "UNKNOWN-DISASTER-TYPE"
UNKNOWN_SUBTYPE = "UNKNOWN-DISASTER-SUBTYPE"
UNKNOWN_START = "UNKNOWN-START-DATE"

# --- fixed values: a code type whose own text may hold the separator ----------
WHOLE_CODE_TYPES = ["IFRC Appeal ID"]

_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyy"


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def normalize_name(col: Column, fold_accents: bool = False) -> Column:
    """Lower-case, drop everything but ``a-z 0-9`` and white space, blank -> ``_``.

    Accented letters are dropped unless ``fold_accents`` maps them first.
    """
    lowered = F.lower(col)
    if fold_accents:
        lowered = F.translate(lowered, _ACCENTED, _PLAIN)
    return F.replace(F.regexp_replace(lowered, r"(?U)[^a-z0-9\s]", ""), F.lit(" "), F.lit("_"))


def _is_place(loc: Column) -> Column:
    low = F.lower(loc)
    keep = ~low.isin(IGNORED_PLACE_WORDS)
    for mark in PERCENTAGE_MARKS + DIRECTION_MARKS:
        keep = keep & ~low.contains(mark)
    return keep


def _tidy_place(loc: Column) -> Column:
    loc = F.regexp_replace(loc, r"(?i)\s*region$", "")
    loc = F.regexp_replace(loc, r"^[IVX]+-\s*", "")
    return F.regexp_replace(loc, r"^incl\.?\s*", "")


def extract_places(region: Column) -> Column:
    """The place names listed in a region label, as an array (never null).

    A bracketed list wins over the text around it; it is split on commas when
    it has one, on white space otherwise. Directions, totals and percentiles
    are not places.
    """
    body = F.replace(F.replace(region, F.lit("County of "), F.lit("")), F.lit(" and "), F.lit(", "))
    inner = F.regexp_extract(body, r"\(([^)]+)\)", 1)
    by_comma = lambda c: F.transform(F.split(c, ","), strip)
    listed = (
        F.when(
            body.contains("(") & body.contains(")"),
            F.when(inner.contains(","), by_comma(inner)).otherwise(F.split(strip(inner), r"(?U)\s+")),
        )
        .otherwise(F.filter(by_comma(body), lambda p: p != ""))
    )
    places = F.filter(F.transform(listed, _tidy_place), _is_place)
    return F.coalesce(places, F.array().cast("array<string>"))


def extraction_note(region: Column, places: Column) -> Column:
    """``Extracted from: <label>`` unless the label held exactly one place."""
    return F.when(F.size(places) != 1, F.concat(F.lit("Extracted from: "), region))


def pipe_to_array(col: Column) -> Column:
    """``a|b`` -> [a, b]; null or empty -> null."""
    return F.when(col != "", F.split(col, r"\|"))


def typed_codes(col: Column) -> Column:
    """``Type:Value|Type:Value`` -> array of (code_type, code_value) in text order."""
    parts = F.transform(F.split(col, r"\|"), lambda p: F.split(p, ":", 2))
    pairs = F.transform(
        F.filter(parts, lambda p: F.size(p) == 2),
        lambda p: F.struct(p[0].alias("code_type"), p[1].alias("code_value")),
    )
    return F.coalesce(pairs, F.array().cast("array<struct<code_type:string,code_value:string>>"))


def valued_codes(col: Column, whole_types: Sequence[str] = tuple(WHOLE_CODE_TYPES)) -> Column:
    """``Value:Type; Value:Type`` -> array of (code_type, code_value) in text order.

    A pair of one of ``whole_types`` is cut at ``:<type>``, so its value may
    hold colons itself.
    """
    pairs = F.split(col, "; ")

    def one(pair: Column) -> Column:
        halves = F.split(pair, ":", 2)
        value = F.when(F.size(halves) == 2, F.get(halves, F.lit(0)))
        kind = F.when(F.size(halves) == 2, F.get(halves, F.lit(1)))
        for whole in whole_types:
            mark = f":{whole}"
            value = F.when(pair.contains(mark), F.substring_index(pair, mark, 1)).otherwise(value)
            kind = F.when(pair.contains(mark), F.lit(whole)).otherwise(kind)
        return F.struct(kind.alias("code_type"), value.alias("code_value"))

    parsed = F.filter(F.transform(pairs, one), lambda s: s["code_type"].isNotNull())
    return F.coalesce(parsed, F.array().cast("array<struct<code_type:string,code_value:string>>"))


def codes_of_type(codes: Column, code_type: str) -> Column:
    """The values of one code type, in order; null when the type does not occur."""
    mine = F.filter(codes, lambda s: s["code_type"] == code_type)
    return F.when(F.size(mine) > 0, F.transform(mine, lambda s: s["code_value"]))


def strip_last_segment(code: Column, only_if_iso3: bool = False) -> Column:
    """Drop the last ``-`` segment; text without a dash is kept."""
    stripped = F.regexp_replace(code, r"-[^-]*$", "")
    if only_if_iso3:
        return F.when(code.rlike(r"-\p{Lu}{3}$"), stripped).otherwise(code)
    return stripped


def has_iso3_suffix(code: Column) -> Column:
    """True when the last segment is three capitals, or there is no segment to check."""
    return F.coalesce(~code.contains("-") | code.rlike(r"-\p{Lu}{3}$"), F.lit(True))


def strip_suffix_array(codes: Column) -> Column:
    return F.transform(codes, lambda c: strip_last_segment(c))


def all_iso3_suffix(codes: Column) -> Column:
    return F.coalesce(F.forall(codes, lambda c: has_iso3_suffix(c)), F.lit(True))


def literal_to_json(col: Column) -> Column:
    """``None``, ``True`` and ``False`` outside quotes as JSON writes them."""
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        # What goes before, quoted text as a whole, is kept.
        before = rf"""(?:[^'"{word[0]}]++|'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|{word[0]}(?!{word[1:]}\b))*+"""
        col = F.regexp_replace(col, rf"\G({before}){word}\b", f"$1{json}")
    return col


def parse_units(col: Column) -> Column:
    """List-of-dicts text -> struct(admin1 array, admin2 array); unreadable -> empty."""
    items = F.from_json(
        literal_to_json(col), "array<struct<adm1_name:string,adm2_name:string>>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    empty = F.array().cast("array<string>")
    first = lambda of: F.transform(
        F.filter(of, lambda i: i["adm1_name"].isNotNull()), lambda i: i["adm1_name"]
    )
    second = lambda of: F.transform(
        F.filter(of, lambda i: i["adm1_name"].isNull() & i["adm2_name"].isNotNull()),
        lambda i: i["adm2_name"],
    )
    # one-element transform: the text is parsed once for both lists
    both = F.transform(
        F.array(items),
        lambda of: F.struct(
            F.coalesce(first(of), empty).alias("admin1"), F.coalesce(second(of), empty).alias("admin2")
        ),
    )
    return both[0]


def event_label(
    iso3: Column, kind: Column, subtype: Column, start: Column, identity: Sequence[Column]
) -> Column:
    """``{iso3}_{type}_{subtype}_{yyyymmdd}_{id8}``; id8 is a hash of ``identity``.

    The hash makes reloading the same event produce the same label.
    """
    digest = F.sha2(F.concat_ws("|", *[c.cast("string") for c in identity]), 256)
    return F.concat_ws(
        "_",
        F.coalesce(iso3, F.lit(UNKNOWN_ISO3)),
        F.coalesce(kind, F.lit(UNKNOWN_TYPE)),
        F.coalesce(subtype, F.lit(UNKNOWN_SUBTYPE)),
        F.coalesce(F.date_format(start, "yyyyMMdd"), F.lit(UNKNOWN_START)),
        F.left(digest, F.lit(8)),
    )


def short_uuid() -> Column:
    """Eight random hex characters (not repeatable; prefer :func:`event_label`)."""
    return F.left(F.expr("uuid()"), F.lit(8))


def pack_json(columns: Sequence[Column], keep_nulls: bool = False) -> Column:
    """One JSON object of the given (aliased) columns; nulls left out by default."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*columns), options)


def clean_label(col: Column, unit: str = "('000 US$)") -> Column:
    """A column label as an identifier: unit dropped, lower case, ``_`` for blanks."""
    bare = F.lower(F.trim(F.replace(col, F.lit(unit), F.lit(""))))
    return F.replace(F.replace(bare, F.lit(", "), F.lit("_")), F.lit(" "), F.lit("_"))


def clean_label_text(name: str, unit: str = "('000 US$)") -> str:
    """The same rule for a Python string, used to rename columns."""
    return name.replace(unit, "").strip().lower().replace(", ", "_").replace(" ", "_")


def escape_regex(col: Column) -> Column:
    """Escape a literal for use inside a regular expression."""
    return F.regexp_replace(col, r"([\\.\[\]{}()*+?^$|-])", r"\\$1")


def replace_word(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def empty_to_null(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def nonempty(arr: Column) -> Column:
    """Null-safe "array has elements"."""
    return F.coalesce(F.size(arr) > 0, F.lit(False))


NameRule = Callable[[Column], Column]
