from __future__ import annotations

import itertools
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasweave.operators import codes, keys, resample, reshape, summaries


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- keys ---------------------------------------------------------------------
def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 3, "y"), (None, 4, "z")], "k string, o int, v string")
    assert rows(keys.keep_first(df, ["k"], ["o"])) == sorted([("a", 1, None), ("b", 3, "y"), (None, 4, "z")], key=repr)
    assert rows(keys.keep_last(df, ["k"], ["o"])) == sorted([("a", 2, "x"), ("b", 3, "y"), (None, 4, "z")], key=repr)


def test_upsert_replaces_only_listed_columns_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1.0, "n1"), ("b", 2.0, "n2")], "k string, v double, note string")
    new = spark.createDataFrame([("a", 5.0, "m1", 1), ("a", None, "m2", 2), ("c", 7.0, "m3", 3), ("c", 8.0, "m4", 4)], "k string, v double, note string, seq int")
    once = keys.upsert(old, new, ["k"], ["v"], ["seq"])
    assert rows(once) == sorted([("a", None, "n1"), ("b", 2.0, "n2"), ("c", 8.0, "m3")], key=repr)
    assert rows(keys.upsert(once, new, ["k"], ["v"], ["seq"])) == rows(once)


def test_insert_ignore_keeps_first_and_lets_null_keys_pass(spark):
    old = spark.createDataFrame([("a", 0)], "k string, o int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), (None, 4), (None, 5)], "k string, o int")
    assert rows(keys.insert_ignore(old, new, ["k"], ["o"])) == sorted([("b", 2), (None, 4), (None, 5)], key=repr)


def test_dense_id_has_no_gaps(spark):
    df = keys.dense_id(spark.range(5000).withColumnRenamed("id", "k"), "k", digits=2)
    ids = [r["id"] for r in df.collect()]
    assert sorted(ids) == list(range(1, 5001))


# --- codes --------------------------------------------------------------------
def _random_events(rng, n, n_codes, hot):
    out = []
    for i in range(n):
        picked = {f"c{rng.randrange(n_codes)}" for _ in range(rng.choice([0, 1, 2, 3, 12]))}
        if rng.random() < hot:
            picked.add("hot")
        listed = sorted(picked) or (None if rng.random() < 0.5 else [])
        out.append((i, rng.choice(["USA", "MEX"]), rng.choice(["Flood", "Storm"]), listed))
    return out


@pytest.mark.parametrize("limit", [1, 2, 8, 400, 10**9])
def test_pair_counts_match_brute_force(spark, limit):
    rng = random.Random(limit)
    a, b = _random_events(rng, 120, 25, 0.35), _random_events(rng, 90, 25, 0.35)
    want = {}
    for x, y in itertools.product(a, b):
        if x[1] == y[1] and set(x[3] or []) & set(y[3] or []):
            want[(x[1], x[2], y[2])] = want.get((x[1], x[2], y[2]), 0) + 1
    left = spark.createDataFrame(a, "event_id int, iso string, a_type string, glide array<string>")
    right = spark.createDataFrame(b, "event_id int, iso string, b_type string, glide array<string>")
    got = codes.code_pair_counts(left, right, "event_id", "glide", "iso", ["a_type"], ["b_type"], light=limit)
    assert {(r["iso"], r["a_type"], r["b_type"]): r["n_pairs"] for r in got.collect()} == want


def test_semi_anti_and_update(spark):
    a = spark.createDataFrame([(1, ["x"], None), (2, ["y", "z"], None), (3, None, 9)], "id int, glide array<string>, v int")
    b = spark.createDataFrame([(10, ["z"], 5), (11, ["x", "y"], None), (12, ["q"], 7), (13, None, 8)], "id int, glide array<string>, v int")
    assert rows(codes.code_semi(b, a, "id", "glide"), "id") == [(10,), (11,)]
    assert rows(codes.code_anti(b, a, "id", "glide"), "id") == [(12,), (13,)]
    # 2 shares with 10 and 11: the smaller id wins; 1 takes the null of 11; 3 is left alone
    assert rows(codes.update_from(a, b, "id", "id", "glide", "v"), "id", "v") == [(1, None), (2, 5), (3, 9)]


def test_shared_code_countries(spark):
    a = spark.createDataFrame([("USA", ["x"]), ("MEX", ["x", "y"])], "iso string, glide array<string>")
    b = spark.createDataFrame([("USA", ["x"]), ("USA", ["x"])], "iso string, glide array<string>")
    assert rows(codes.shared_code_countries(a, b, "glide", "iso")) == [("x", 2, 1, 3)]


def test_map_pair(spark):
    df = spark.createDataFrame([(1, "Flood", None), (2, "Wet", None), (3, "Wet", "s")], "id int, t string, s string")
    m = spark.createDataFrame([(1, "Wet", None, "Old", None), (2, "Wet", None, "Flood", "Flash"), (3, None, None, "never", "x")], "seq int, t string, s string, nt string, ns string")
    out = codes.map_pair(df, m, ("t", "s"), ("nt", "ns"), "seq", ("dt", "ds"))
    assert rows(out, "id", "dt", "ds") == [(1, "Flood", None), (2, "Flood", "Flash"), (3, "Wet", "s")]


def test_remap_countries(spark):
    df = spark.createDataFrame([("HKG", "Hong Kong", ["A"], []), ("AB9", "Abyei", [], []), ("FRA", "France", [], [])], "iso string, c string, a1 array<string>, a2 array<string>")
    out = codes.remap_countries(df, codes.REMAPS_WITH_PLACES, "iso", "c", "a1", "a2")
    assert rows(out) == sorted([("CHN", "China", ["A", "Hong Kong"], []), ("SDN", "Sudan", [], ["Abyei Area"]), ("FRA", "France", [], [])], key=repr)


# --- reshaping ----------------------------------------------------------------
def test_union_rewrite_equals_full_outer_chain(spark):
    rng = random.Random(3)
    parts = []
    for i in range(4):
        chosen = rng.sample([(g, d) for g in "abcd" for d in range(5)], 9)
        parts.append(spark.createDataFrame([(g, d, rng.choice([None, rng.random()])) for g, d in chosen], f"gid string, date int, v{i} double"))
    chain = parts[0]
    for p in parts[1:]:
        chain = chain.join(p, ["gid", "date"], "full_outer")
    cols = ["gid", "date", "v0", "v1", "v2", "v3"]
    assert rows(reshape.combine_wide(parts, ["gid", "date"]), *cols) == rows(chain, *cols)


def test_pivot_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("a", "y.z", 3.0), ("b", "other", 4.0)], "k string, variable string, v double")
    labels = {"x": "X", "y.z": "Y Z"}
    one_pass = rows(reshape.pivot_max(df, ["k"], "variable", "v", labels), "k", "X", "Y Z")
    monkeypatch.setattr(reshape, "_ONE_PASS_COLUMNS", 0)
    assert rows(reshape.pivot_max(df, ["k"], "variable", "v", labels), "k", "X", "Y Z") == one_pass == [("a", 2.0, 3.0), ("b", None, None)]


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "id int, a double, b double")
    assert rows(reshape.unpivot(df, ["id"], ["a", "b"])) == sorted([(1, "a", None), (1, "b", 2.0)], key=repr)


def test_flatten_levels(spark):
    df = spark.createDataFrame([(1, "USA", ["California", "Nevada"], []), (2, None, None, ["X"])], "id int, admin_level_0 string, admin_level_1 array<string>, admin_level_2 array<string>")
    got = rows(reshape.flatten_levels(df), "id", "admin_level", "admin_name")
    assert got == sorted([(1, 0, "USA"), (1, 1, "California"), (1, 1, "Nevada"), (2, 0, None), (2, 2, "X")], key=repr)


# --- resampling ---------------------------------------------------------------
def test_daily_rules_nulls_and_gaps(spark):
    data = [
        ("g", 0, 0, "2m_temperature", "2020-01-01 01:00:00", 1.0, "K"), ("g", 0, 0, "2m_temperature", "2020-01-01 02:00:00", 3.0, "K"),
        ("g", 0, 0, "2m_temperature", "2020-01-03 02:00:00", 7.0, "K"),
        ("g", 0, 0, "total_precipitation", "2020-01-01 01:00:00", None, "m"),
        ("g", 0, 0, "maximum_2m_temperature_x", "2020-01-01 01:00:00", 4.0, "K"), ("g", 0, 0, "maximum_2m_temperature_x", "2020-01-01 09:00:00", 6.0, "K"),
    ]
    cells = spark.createDataFrame(data, "grid_id string, lat_idx int, lon_idx int, variable string, time string, value double, unit string").withColumn("time", F.col("time").cast("timestamp"))
    got = {(r["variable"], str(r["date"])): r["value"] for r in resample.daily(cells).collect()}
    assert got == {
        ("2m_temperature", "2020-01-01"): 2.0, ("2m_temperature", "2020-01-02"): None, ("2m_temperature", "2020-01-03"): 7.0,
        ("total_precipitation", "2020-01-01"): 0.0, ("maximum_2m_temperature_x", "2020-01-01"): 6.0,
    }


# --- summaries ----------------------------------------------------------------
@pytest.mark.parametrize("kind", ["uniform", "hot", "few"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(7)
    n = {"uniform": 60_000, "hot": 50_000, "few": 3}[kind]
    values = rng.random(n) * 100
    if kind == "hot":
        values[: n // 3] = 42.0
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["quantile"] for r in summaries.exact_quantiles(df, "g", "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-9)


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0 + 2**-52, 1.0 - 2**-53, 2.0**-537,
         1e300, -1e300, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 3.0, -7.25, 2.0**1023, 8.0 - 2**-50]


def test_order_keys_keep_order_and_every_bit(spark):
    rng = random.Random(3)
    values = EDGES + [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("k", summaries.order_key(F.col("v")))
    got = [(r["v"], r["k"], r["back"]) for r in df.withColumn("back", summaries.of_order_key(F.col("k"))).collect()]
    assert all(v == back for v, _, back in got)
    by_key = sorted(got, key=lambda g: g[1])
    assert [g[0] for g in by_key] == sorted(v for v, _, _ in got)
    assert len({g[1] for g in got}) == len({g[0] for g in got})
    assert spark.range(1).select(summaries.order_key(F.lit(float("nan"))).alias("k")).first()["k"] > max(g[1] for g in got)


def test_a_million_values_close_together_and_half_of_all_rows_equal(spark):
    n = 1_000_000
    close = spark.range(n).select(F.lit("close").alias("g"), (F.lit(50.0) + F.col("id") * 1e-9).alias("v"))
    equal = spark.range(n).select(F.lit("equal").alias("g"), F.when(F.col("id") % 2 == 0, 42.0).otherwise(F.col("id").cast("double")).alias("v"))
    none = spark.createDataFrame([("none", None), (None, 3.0), (None, 4.0)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in summaries.exact_quantiles(close.union(equal).union(none), "g", "v", probs).collect()}
    ids = np.arange(n)
    for g, values in (("close", 50.0 + ids * 1e-9), ("equal", np.where(ids % 2 == 0, 42.0, ids)), (None, np.array([3.0, 4.0]))):
        for p in probs:
            assert got.pop((g, p)) == pytest.approx(np.quantile(values, p), rel=1e-15, abs=0)
    assert not got


def test_quantiles_rank_no_rows(spark):
    """No window, and what is shuffled are counts per bin."""
    rows = summaries.key_rows(spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v")), "g", "v")
    plan = summaries._bins(rows, 48, "group")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.index("Exchange hashpartitioning(group") > plan.index("HashAggregate")
    final = summaries.key_quantiles(rows, [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in final and "selection-" in final


def test_completeness(spark):
    df = spark.createDataFrame([("A", None, ["x"]), ("A", 1, []), ("B", 2, None)], "source string, n int, l array<string>")
    got = {(r["subset"], r["column_name"]): (r["total"], r["non_null"], r["pct"]) for r in summaries.completeness(df, ["n", "l"], "source").collect()}
    assert got[("ALL", "n")] == (3, 2, 66.7) and got[("A", "l")] == (2, 1, 50.0) and got[("B", "l")] == (1, 0, 0.0)


def test_hot_code_is_counted_without_pairs(spark):
    """A third of both sides shares one code: 10^10 pairs, counted from profiles."""
    def side(type_name):
        n = F.col("id")
        listed = F.when(n % 3 == 0, F.array(F.lit("hot"), F.concat(F.lit("c"), (n % 7).cast("string")))).otherwise(F.array(n.cast("string")))
        return spark.range(300_000).select(n.alias("event_id"), F.lit("USA").alias("iso"), F.lit("x").alias(type_name), listed.alias("glide"))

    got = codes.code_pair_counts(side("a_type"), side("b_type"), "event_id", "glide", "iso", ["a_type"], ["b_type"])
    # every hot row pairs with every hot row once, whatever else they share; the rest pair with themselves
    assert got.first()["n_pairs"] == 100_000**2 + 200_000


def test_pairs_of_rows_with_forty_heavy_codes(spark):
    rng = random.Random(1)
    side = lambda n: [(i, "USA", rng.choice(["x", "y"]), rng.sample([f"c{k}" for k in range(60)], 40) + [f"own{i % 7}"]) for i in range(n)]
    a, b = side(60), side(50)
    b += [(99, "USA", "x", [f"d{k}" for k in range(45)]), (100, "USA", "y", None)]
    want = {}
    for x, y in itertools.product(a, b):
        if set(x[3]) & set(y[3] or []):
            want[(x[2], y[2])] = want.get((x[2], y[2]), 0) + 1
    left = spark.createDataFrame(a, "event_id int, iso string, a_type string, glide array<string>")
    right = spark.createDataFrame(b, "event_id int, iso string, b_type string, glide array<string>")
    got = codes.code_pair_counts(left, right, "event_id", "glide", "iso", ["a_type"], ["b_type"], light=100)
    assert {(r["a_type"], r["b_type"]): r["n_pairs"] for r in got.collect()} == want
