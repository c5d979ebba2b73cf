from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlasweave.functions import dates, geo, numbers, text


@pytest.mark.parametrize("raw, want", [
    ("California", "california"), ("São Paulo", "so_paulo"), ("Île-de-France", "ledefrance"), ("New York", "new_york"),
])
def test_normalize_name(one, raw, want):
    assert one(text.normalize_name(F.col("s")), s=raw) == want


def test_normalize_name_can_fold_accents(one):
    assert one(text.normalize_name(F.col("s"), fold_accents=True), s="São Paulo") == "sao_paulo"


@pytest.mark.parametrize("raw, want", [
    ("Central (Kabul Wardak Kapisa)", ["Kabul", "Wardak", "Kapisa"]),
    ("Region (A, B, C)", ["A", "B", "C"]),
    ("Texas and Oklahoma", ["Texas", "Oklahoma"]),
    ("County of Los Angeles", ["Los Angeles"]),
    ("California region", ["California"]),
    ("North", []), ("Total", []), ("Lowest 25%", []), (None, []),
    ("IV- Somewhere", ["Somewhere"]), ("X (incl. Oran, North-West Hills)", ["Oran"]), ("Empty ()", []),
    ("Central Anatolia (Kayseri, Kirsehir, Nevsehir, Nig", ["Central Anatolia (Kayseri", "Kirsehir", "Nevsehir", "Nig"]),
])
def test_extract_places(one, raw, want):
    assert one(text.extract_places(F.col("s")), s=raw) == want


def test_extraction_note(one):
    col = text.extraction_note(F.col("s"), text.extract_places(F.col("s")))
    assert one(col, s="A and B") == "Extracted from: A and B"
    assert one(col, s="Alone") is None


def _codes(rows):
    return [(r["code_type"], r["code_value"]) for r in rows]


def test_typed_codes(one):
    assert _codes(one(text.typed_codes(F.col("s")), s="GLIDE:EQ-2007-000033|USGS:us:p1")) == [("GLIDE", "EQ-2007-000033"), ("USGS", "us:p1")]
    assert _codes(one(text.typed_codes(F.col("s")), s="GLIDE:A|GLIDE:B|junk")) == [("GLIDE", "A"), ("GLIDE", "B")]
    assert one(text.typed_codes(F.col("s")), s=None) == []
    assert one(text.codes_of_type(text.typed_codes(F.col("s")), "GLIDE"), s="GLIDE:A|GLIDE:B|junk") == ["A", "B"]
    assert one(text.codes_of_type(text.typed_codes(F.col("s")), "DFO"), s="GLIDE:A") is None


def test_valued_codes(one):
    got = one(text.valued_codes(F.col("s")), s="FL-2023-000079-BIH:Glide Number; X:1:IFRC Appeal ID; nothing")
    assert _codes(got) == [("Glide Number", "FL-2023-000079-BIH"), ("IFRC Appeal ID", "X:1")]


@pytest.mark.parametrize("raw, stripped, valid", [
    ("FL-2020-000012-USA", "FL-2020-000012", True), ("FL-2020-000012", "FL-2020", False), ("plain", "plain", True),
    ("A-usa", "A", False), (None, None, True),
])
def test_strip_suffix(one, raw, stripped, valid):
    assert one(text.strip_last_segment(F.col("s")), s=raw) == stripped
    assert one(text.has_iso3_suffix(F.col("s")), s=raw) is valid


def test_strip_suffix_only_when_country(one):
    assert one(text.strip_last_segment(F.col("s"), only_if_iso3=True), s="FL-2020-000012") == "FL-2020-000012"


@pytest.mark.parametrize("raw, first, second", [
    ("[{'adm1_name':'Arkansas'},{'adm2_name':'Bolivar'}]", ["Arkansas"], ["Bolivar"]),
    ("""[{'adm1_name': "Cote d'Or", 'adm2_name': 'ignored'}]""", ["Cote d'Or"], []),
    ("not a list", [], []), (None, [], []),
])
def test_parse_units(one, raw, first, second):
    got = one(text.parse_units(F.col("s")), s=raw)
    assert (got["admin1"], got["admin2"]) == (first, second)


def test_pipe_to_array(one):
    assert one(text.pipe_to_array(F.col("s")), s="CA|Calif.") == ["CA", "Calif."]
    assert one(text.pipe_to_array(F.col("s")), s="") is None
    assert one(text.pipe_to_array(F.col("s")), s=None) is None


def test_event_label_is_repeatable(one):
    col = text.event_label(F.col("i"), F.col("t"), F.col("u"), F.col("d").cast("date"), [F.col("i"), F.col("d")])
    values = dict(i="USA", t="Flood", u=None, d="2020-03-15")
    first = one(col, **values)
    assert first.startswith("USA_Flood_UNKNOWN-DISASTER-SUBTYPE_20200315_") and len(first.rsplit("_", 1)[1]) == 8
    assert one(col, **values) == first
    assert one(col, i=None, t=None, u=None, d=None).startswith("UNKNOWN-ISO3-CODE_UNKNOWN-DISASTER-TYPE_UNKNOWN-DISASTER-SUBTYPE_UNKNOWN-START-DATE_")


def test_pack_json(one):
    cols = [F.col("a"), F.col("b")]
    assert one(text.pack_json(cols), a="x", b=None) == '{"a":"x"}'
    assert one(text.pack_json(cols, keep_nulls=True), a="x", b=None) == '{"a":"x","b":null}'


def test_clean_label(one):
    raw = "Total Damage, Adjusted ('000 US$)"
    assert one(text.clean_label(F.col("s")), s=raw) == "total_damage_adjusted" == text.clean_label_text(raw)


def test_escape_regex(one):
    assert one(text.escape_regex(F.col("s")), s="St. A+(b)") == r"St\. A\+\(b\)"


@pytest.mark.parametrize("y, m, d, want", [
    ("2020", "3", None, dt.date(2020, 3, 1)), ("2020", "2", "30", None), ("2020", None, None, dt.date(2020, 1, 1)), (None, "1", "1", None),
])
def test_partial_date(one, y, m, d, want):
    assert one(dates.partial_date(F.col("y"), F.col("m"), F.col("d")), y=y, m=m, d=d) == want


def test_clamp_end(one):
    col = dates.clamp_end(F.col("a").cast("date"), F.col("b").cast("date"))
    assert one(col, a="2020-03-15", b="2020-03-01") == dt.date(2020, 3, 15)
    assert one(col, a="2020-03-15", b=None) is None


@pytest.mark.parametrize("name, want", [
    ("MCD43C4.A2020001.x.hdf", dt.date(2020, 1, 1)), ("X.A2020366.hdf", dt.date(2020, 12, 31)),
    ("MERRA2_400.tavg1.20200105.nc4", dt.date(2020, 1, 5)), ("readme.txt", None),
])
def test_date_from_name(one, name, want):
    assert one(dates.date_from_name(F.col("s")), s=name) == want


def test_date_from_path(one):
    assert one(dates.date_from_path(F.col("s")), s="/data/2015/x.tif") == dt.date(2015, 1, 1)
    assert one(dates.date_from_path(F.col("s")), s="/data/misc/x.tif") is None


def test_variable_from_name(one):
    col = dates.variable_from_name(F.col("s"))
    assert one(col, s="global_f_10_2010_1km.tif") == "population_sex_age_f_10_count"
    assert one(col, s="global_t_m_5_2021_1km.tif") == "2021_2022_population_sex_age_t_m_5_count"
    assert one(col, s="a_b.tif") is None


def test_safe_double(one):
    col = numbers.safe_double(F.col("s"))
    assert [one(col, s=v) for v in (" 1.5 ", "", "  ", "n/a", None)] == [1.5, None, None, None, None]


def test_scale_units(one):
    col = numbers.scale_units(F.col("v").cast("double"), F.col("n"), {"regpopm": 1e6, "pop": 1e3})
    assert one(col, v="39.5", n="regpopm") == 39_500_000
    assert one(col, v="2", n="shdi") == 2 and one(col, v=None, n="pop") is None


@pytest.mark.parametrize("red, nir, quality, want", [
    (100, 300, 2, 0.5), (100, 300, 6, None), (32767, 300, 2, None), (0, 0, 0, None), (-300, 100, 0, -1.0), (100, -300, 0, 1.0),
])
def test_normalized_difference(spark, red, nir, quality, want):
    df = spark.createDataFrame([(red, nir, quality)], "r int, n int, q int")
    got = df.select(numbers.normalized_difference(F.col("r"), F.col("n"), F.col("q")).alias("v")).first()["v"]
    assert got is None if want is None else got == pytest.approx(want)


def test_cell_area(spark):
    at = spark.range(1).select(
        geo.cell_area(F.lit(0.0), 0.25, 0.25).alias("a"), geo.cell_area(F.lit(60.0), 0.25, 0.25).alias("b")).first()
    assert at["a"] / 1e6 == pytest.approx(772.77, abs=0.01) and at["b"] == pytest.approx(at["a"] / 2)


def test_safe_double_reads_decimal_numbers_only(one):
    col = numbers.safe_double(F.col("s"))
    for s in ("12d", "1f", "0x1p3", "NaN", "Infinity", "1_000", "1 2", ""):
        assert one(col, s=s) is None
    assert one(col, s="\u00a0-1.5e2\t") == -150.0 and one(col, s=".5") == 0.5


def test_parse_units_reads_python_literals(one):
    got = one(text.parse_units(F.col("s")), s="""[{'adm1_name': 'None of it', 'adm2_name': None, 'ok': True}, {'adm1_name': None, 'adm2_name': "D'Or"}, {'adm1_name': 'L\\'Aquila', 'x': False}]""")
    assert got["admin1"] == ["None of it", "L'Aquila"] and got["admin2"] == ["D'Or"]
