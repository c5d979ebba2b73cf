from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import places
from atlasweave.plans import events as ev
from atlasweave.plans.boundaries import admin_units

MAPPING = "iso3 string, seq int, main0 string, alt0 string, main1 string, alt1 string, local1 string, main2 string, alt2 string, local2 string"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def reference_scan(text, names):
    """The scan's definition: one alternation, longest first, ignoring case."""
    ordered = sorted({n for n, _ in names}, key=len, reverse=True)
    if not ordered:
        return set()
    pattern = r"\b(?:" + "|".join(re.escape(n) for n in ordered) + r")\b"
    found = {m.lower() for m in re.findall(pattern, text, re.IGNORECASE)}
    return {(n, level) for n, level in names if n.lower() in found}


WORDS = ["New", "york", "North", "é", "Île", "São", "Paulo", "St.", "John's", "A", "B-1", "(X)", "東京", "bay", "York", "new"]
SEPARATORS = [" ", ", ", "-", " (", ") ", "/", "  ", "'"]


@pytest.mark.parametrize("seed", range(6))
def test_scan_matches_definition(spark, seed):
    rng = random.Random(seed)

    def phrase(n):
        out = rng.choice(WORDS)
        for _ in range(n):
            out += rng.choice(SEPARATORS) + rng.choice(WORDS)
        return out

    names = {"AAA": {(phrase(rng.randrange(3)).strip(), rng.randrange(3)) for _ in range(14)},
             "BBB": {(rng.choice(["New York", "York", "new", "Bay"]), 1) for _ in range(4)}}
    if seed == 0:
        names["AAA"] |= {("(X)", 1), (" York", 2), ("St.", 1)}  # names that begin or end outside a word
    texts = [(i, rng.choice(["AAA", "BBB", "CCC"]), phrase(rng.randrange(12))) for i in range(60)] + [(98, "AAA", ""), (99, "AAA", None)]
    want = {(i, iso, n, lv) for i, iso, t in texts if t and iso in names for n, lv in reference_scan(t, names[iso])}
    name_df = spark.createDataFrame([(iso, lv, n) for iso, items in names.items() for n, lv in items], "iso3 string, level int, name string")
    text_df = spark.createDataFrame(texts, "id int, iso string, text string")
    for limit in (300_000, 0):  # broadcast gazetteer, shuffled gazetteer
        got = places.scan_names(text_df, name_df, "id", "iso", "text", broadcast_names=limit)
        assert {(r["id"], r["iso3"], r["name"], r["level"]) for r in got.collect()} == want


@pytest.mark.parametrize("limit", [300_000, 0])
def test_texts_are_scanned_in_waves(spark, monkeypatch, limit):
    """Each job shuffles the places of its share of the texts; together they find what one job finds."""
    names = spark.createDataFrame([("A", 1, "x y"), ("A", 2, "X Y"), ("A", 2, "z")], "iso3 string, level int, name string")
    texts = spark.createDataFrame([(i, "A", "x y z, x z") for i in range(40)], "id int, iso string, text string")
    whole = sorted(map(tuple, places.scan_names(texts, names, "id", "iso", "text", broadcast_names=limit).collect()))
    written = []
    monkeypatch.setattr(places, "WAVE_CHARS", 100)
    monkeypatch.setattr(places, "appended", lambda df, path, put=places.appended: written.append(put(df, path)))
    assert sorted(map(tuple, places.scan_names(texts, names, "id", "iso", "text", broadcast_names=limit).collect())) == whole
    assert len(written) == 5 and len(whole) == 120


def test_scan_example(spark):
    names = spark.createDataFrame([("USA", 2, "Los Angeles"), ("USA", 1, "California"), ("USA", 2, "Angeles")], "iso3 string, level int, name string")
    texts = spark.createDataFrame([(1, "USA", "Earthquake - North - Los Angeles 20100101")], "id int, iso string, text string")
    assert rows(places.scan_names(texts, names, "id", "iso", "text"), "name", "level") == [("Los Angeles", 2)]


def test_contains_lookup_matches_brute_force(spark):
    rng = random.Random(5)
    letters = "abA .|é"
    mapping = [("X", i, None, None, "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))), rng.choice([None, "ba|Ab", "a.b"]), None, None, None, None) for i in range(25)]
    names = sorted({"".join(rng.choice("abA.é") for _ in range(rng.randrange(1, 4))) for _ in range(40)})
    want = {}
    for n in names:
        hits = [m for m in mapping if any(n.lower() in (c or "").lower() for c in (m[4], m[5], m[6]))]
        want[n] = min(hits, key=lambda m: m[1])[4] if hits else None
    got = places.contains_lookup(spark.createDataFrame([("X", n) for n in names], "iso3 string, name string"), spark.createDataFrame(mapping, MAPPING), 1)
    assert {r["name"]: r["main"] for r in got.collect()} == want


def test_alias_lookup_keeps_order_and_unknown_names(spark):
    mapping = spark.createDataFrame([
        ("USA", 2, "USA", None, "California", "CA|Calif.", None, "Los Angeles", "LA", None),
        ("USA", 1, "USA", None, "Canal Zone", "CA", None, None, None, None),
    ], MAPPING)
    df = spark.createDataFrame([(1, "USA", ["Calif.", "Mars", "CA"], ["LA"]), (2, "MEX", ["CA"], None), (3, "USA", [], None)], "id int, iso string, a1 array<string>, a2 array<string>")
    out = places.alias_lookup(df, mapping, "id", "iso", {1: "a1", 2: "a2"})
    assert rows(out) == sorted([(1, "USA", ["California", "Mars", "Canal Zone"], ["Los Angeles"]), (2, "MEX", ["CA"], None), (3, "USA", [], None)], key=repr)


LAYER = "gid_0 string, name_0 string, gid_1 string, iso_1 string, name_1 string, varname_1 string, nl_name_1 string, type_1 string, gid_2 string, name_2 string, varname_2 string, nl_name_2 string, type_2 string, rings array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"
SQUARE = [(False, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)])]


def _units(spark):
    layer = [
        ("USA", "United States", "USA.1_1", "US-CA", "California", "CA|Calif.", None, "State", "USA.1.1_1", "Springfield", None, None, None, SQUARE),
        ("USA", "United States", "USA.1_1", "US-CA", "California", "CA|Calif.", None, "State", "USA.1.2_1", "Nevada", None, "São", None, SQUARE),
        ("USA", "United States", "USA.2_1", "US-NV", "Nevada", "", None, None, "USA.2.1_1", "Clark", None, None, None, SQUARE),
        ("MEX", "Mexico", "MEX.1_1", "MX-CA", "California", None, None, None, "MEX.1.1_1", "X", None, None, None, [(False, [(0.0, 0.0)])]),
    ]
    return admin_units(spark.createDataFrame(layer, LAYER))


def test_hierarchy_and_geometry_check(spark):
    got = {r["gid"]: r for r in _units(spark).collect()}
    assert set(got) == {"USA", "USA.1_1", "USA.2_1", "USA.1.1_1", "USA.1.2_1", "USA.2.1_1"}  # the broken ring is left out
    assert got["USA.1_1"]["parent_gid"] == "USA" and got["USA.1.2_1"]["parent_gid"] == "USA.1_1" and got["USA"]["parent_gid"] is None
    assert got["USA.1_1"]["var_names"] == ["CA", "Calif."] and got["USA.2_1"]["var_names"] is None
    assert (got["USA"]["level_type"], got["USA.1_1"]["level_type"], got["USA.2_1"]["level_type"]) == ("Country", "State", "Admin Level 1")


def test_name_match_prefers_level_one_and_checks_country(spark):
    names = places.gazetteer(_units(spark))
    df = spark.createDataFrame([("USA", "Nevada"), ("USA", "calif"), ("USA", "so"), ("MEX", "Nevada"), ("USA", "Springfield")], "iso string, p string")
    got = rows(places.match_names(df, names, "iso", "p"), "iso", "p", "gid", "admin_level")
    assert got == sorted([("USA", "Nevada", "USA.2_1", 1), ("USA", "calif", "USA.1_1", 1), ("USA", "so", "USA.1.2_1", 2), ("MEX", "Nevada", None, None), ("USA", "Springfield", "USA.1.1_1", 2)], key=repr)


def test_units_of_places_without_country(spark):
    u = _units(spark).select("gid", "iso3", "admin_level", "name")
    p = spark.createDataFrame([(1, "USA", 1, "Nevada"), (2, None, 1, "California"), (3, "MEX", 1, "Nevada"), (4, "USA", 2, "Nevada")], "id int, iso string, lv int, n string")
    assert rows(places.attach_units(p, u, "iso", "lv", "n"), "id", "gid") == [(1, "USA.2_1"), (2, "USA.1_1"), (4, "USA.1.2_1")]


def test_evidence_decides_successor(spark):
    names = spark.createDataFrame([("SRB", "Nis"), ("MNE", "Bar"), ("MNE", "Nis")], "iso3 string, name string")
    df = spark.createDataFrame([(1, "SCG", "old", ["Nis"]), (2, "SCG", "old", ["Bar", "x"]), (3, "SCG", "old", ["x"]), (4, "SCG", "old", None), (5, "FRA", "France", ["Bar"])], "id int, iso string, c string, a array<string>")
    out = places.resolve_by_evidence(df, names, "id", "iso", "c", ["a"], "SCG", [("SRB", "Serbia"), ("MNE", "Montenegro")])
    assert rows(out, "id", "iso", "c") == [(1, "SRB", "Serbia"), (2, "MNE", "Montenegro"), (5, "FRA", "France")]


def test_all_place_lookups_at_once_equal_one_after_the_other(spark):
    rng = random.Random(8)
    names = ["Nis", "Bar", "B", "Novi Sad", "x", "Nat 7", None]
    mapping = spark.createDataFrame([
        ("MNE", 3, "M", None, "Bar", "B|Nat 7", None, "Nis", "x", None), ("SRB", 1, "S", None, "Novi Sad", "Nat 7", "Nis", "Bar", None, "B"),
        ("SRB", 2, "S", None, "Other", "Nat 7", None, "x", None, None), ("FRA", 4, "F", None, "Nis", "Bar", None, None, None, None)], MAPPING)
    pick = lambda: rng.choice([None, [], [rng.choice(names) for _ in range(rng.randrange(4))]])
    data = [(i, rng.choice(["SCG", "SCG", "SRB", "FRA", "USA", None]), "old", pick(), pick()) for i in range(80)]
    df = spark.createDataFrame(data, "id int, iso string, c string, a array<string>, b array<string>")
    successors, levels = [("SRB", "Serbia"), ("MNE", "Montenegro")], {1: "a", 2: "b"}
    names_of = places.name_sets(mapping).where("level > 0 AND iso3 IN ('SRB', 'MNE')")
    one = places.alias_lookup(
        places.resolve_by_evidence(df, names_of, "id", "iso", "c", ["a", "b"], "SCG", successors), mapping, "id", "iso", levels)
    both = places.answered_places(df, mapping, "id", "iso", "c", levels, "SCG", successors)
    assert both.columns == df.columns and rows(both) == rows(one)


def test_names_that_texts_of_a_country_use_besides(spark):
    mapping = spark.createDataFrame([("CHN", 1, "China", None, "Xianggang", None, "Hong Kong SAR", None, None, None), ("USA", 2, "USA", None, "Texas", None, None, None, None, None)], MAPPING)
    texts = spark.createDataFrame([(1, "CHN", "Typhoon - Hong Kong - 2020"), (2, "USA", "Fire in Macau, Texas"), (3, "CHN", "MACAU/x")], "id int, iso string, text string")
    got = places.scan_names(texts, places.scanned_names(mapping), "id", "iso", "text")
    assert rows(got, "id", "name", "level") == [(1, "Hong Kong", 1), (2, "Texas", 1), (3, "Macau", 1)]
    assert rows(ev.found_places(texts, mapping, "id", "iso", "text"), "id", "admin_level_1") == [(1, ["Xianggang"]), (2, ["Texas"])]


def test_merge_identity(spark):
    a = spark.createDataFrame([(1, ["x"]), (2, ["y"]), (3, None)], "event_id bigint, glide array<string>").withColumn("source", F.lit("EMDAT"))
    b = spark.createDataFrame([(7, ["x"], 5), (8, ["x"], 6), (9, ["n"], 1), (10, None, 2)], "event_id bigint, glide array<string>, disaster_internal_displacements bigint").withColumn("source", F.lit("IDMC"))
    got = rows(ev.merge_events(a, b), "source", "event_id", "disaster_internal_displacements")
    # all of A, A1 updated from the smaller B id, B without a shared code added
    assert got == sorted([("EMDAT", 1, 5), ("EMDAT", 2, None), ("EMDAT", 3, None), ("IDMC", 9, 1), ("IDMC", 10, 2)], key=repr)


def test_fold_marks_in_gazetteer_are_dropped_when_empty(spark):
    u = spark.createDataFrame([("g", "JPN", 1, "東京", None, None)], "gid string, iso3 string, admin_level int, name string, var_names array<string>, nl_names array<string>")
    assert places.gazetteer(u).count() == 0
