from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import keys
from atlasweave.operators.grids import Grid, coverage
from atlasweave.operators.keys import keep_last
from atlasweave.plans import indicators as ind
from atlasweave.plans import materialised, reports, views, zonal
from atlasweave.session import at_most, scratch_path, scratch_root
from atlasweave.sources import committed, scans, sinks, upsert_log
from atlasweave.streaming import incremental as inc


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- sources and sinks ----------------------------------------------------------
def test_csv_scan_by_name_in_any_case(spark, tmp_path):
    (tmp_path / "GDL_Shdi_2020.csv").write_text("a,b\n1, \n")
    (tmp_path / "other.csv").write_text("a,b\n2,x\n")
    (tmp_path / "shdi.txt").write_text("a,b\n3,y\n")
    assert rows(scans.read_tables(spark, str(tmp_path), "SHDI", schema="a string, b string")) == [("1", " ", "GDL_Shdi_2020.csv")]


def test_sheet_tag(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "s"))
    assert rows(scans.read_sheet(spark, str(tmp_path / "s"), "Book", "Sheet1")) == [(1, "Book_Sheet1")]


def test_feature_collections(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(
        '{"type":"FeatureCollection","features":[\n'
        '{"type":"Feature","properties":{"year":2020,"GID_1":"USA.1_1"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]],[[0.1,0.1],[0.2,0.1],[0.2,0.2],[0.1,0.1]]]}},\n'
        '{"type":"Feature","properties":{"year":2021,"GID_1":"X"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}},\n'
        '{"type":"Feature","properties":{"year":2022,"GID_1":"P"},"geometry":{"type":"Point","coordinates":[0,0]}}]}')
    got = {r["GID_1"]: r for r in scans.read_features(spark, str(tmp_path), "year int, GID_1 string").collect()}
    assert [r["hole"] for r in got["USA.1_1"]["rings"]] == [False, True]
    assert [(r["hole"], r["points"][0]["x"]) for r in got["X"]["rings"]] == [(False, 0.0), (False, 5.0)]
    assert got["P"]["rings"] is None and got["P"]["year"] == 2022


def test_monthly_write_is_one_folder_per_month(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-05", 1), ("2020-01-25", 2), ("2020-02-01", 3)], "d string, v int").withColumn("d", F.col("d").cast("date"))
    sinks.write_monthly(df, "d", str(tmp_path / "m"))
    assert rows(spark.read.parquet(str(tmp_path / "m")), "year", "month", "v") == [(2020, 1, 1), (2020, 1, 2), (2020, 2, 3)]


def test_observation_table_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([("climate", "USA", 0, "t", 1.0), ("climate", "USA.1_1", 1, "t", 2.0), ("aerosol", "USA", 0, "b", 3.0)], "dataset string, gid string, admin_level int, variable string, mean double").withColumn("date", F.lit("2020-01-01").cast("date"))
    sinks.write_observations(df, str(tmp_path / "obs"))
    one = spark.read.parquet(str(tmp_path / "obs")).where("dataset = 'climate' AND admin_level = 0")
    assert len(one.inputFiles()) >= 1 and rows(one, "gid", "mean") == [("USA", 1.0)]
    assert "PartitionFilters: [isnotnull(dataset" in one._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_upsert_log_reads_as_the_batches_loaded_one_by_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    target, kind = str(tmp_path / "log"), "k string, seq int, a int, b int, note string"
    table = spark.createDataFrame([], kind)
    for batch in range(5):
        data = [(rng.choice("pqrstu"), i, rng.choice([None, rng.randrange(9)]), rng.randrange(9), f"{batch}-{i}") for i in range(rng.randrange(1, 9))]
        df = spark.createDataFrame(data, kind)
        listed = rng.choice([["a"], ["b"], ["a", "b"]])
        table = spark.createDataFrame(keys.upsert(table, df, ["k"], listed, ["seq"]).collect(), kind)
        assert upsert_log.append(df, target, ["k"], listed, ["seq"]) == batch
        if batch in (1, 3):
            upsert_log.compact(spark, target, ["k"])
        assert rows(upsert_log.current(spark, target, ["k"]), "k", "a", "b", "note") == rows(table, "k", "a", "b", "note")


def test_parts_without_a_commit_are_not_read(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 10)], "k string, seq int, v int")
    upsert_log.append(df, target, ["k"], ["v"], ["seq"])
    broken = committed.write_part(upsert_log.reduced_batch(df.withColumn("v", F.lit(99)), ["k"], ["v"], ["seq"]), target, 1)
    assert rows(upsert_log.current(spark, target, ["k"]), "k", "v") == [("a", 10)]
    plan = upsert_log.current(spark, target, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # parts that are not committed are not opened
    files = spark.createDataFrame([("f", 0, 1)], committed.MANIFEST)
    committed.commit(files, target, 1, broken)
    assert rows(upsert_log.current(spark, target, ["k"]), "k", "v") == [("a", 99)]
    upsert_log.append(df.withColumn("v", F.lit(5)), target, ["k"], ["v"], ["seq"])
    assert rows(upsert_log.current(spark, target, ["k"]), "k", "v") == [("a", 5)]
    assert rows(committed.manifest(spark, target), "path") == [("batch 0",), ("batch 2",), ("f",)]


def test_scratch_follows_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root) and first != second


def test_at_most(spark):
    assert at_most(spark.range(10), 10) and not at_most(spark.range(11), 10)


# --- streaming --------------------------------------------------------------------
def test_stream_upsert_resumes_and_marks_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put = lambda name, data: spark.createDataFrame(data, "k string, seq int, v int").coalesce(1).write.parquet(f"{source}/{name}")
    put("f1", [("a", 1, 1), ("b", 2, 2)])
    schema = spark.read.parquet(f"{source}/f1").schema

    def run():
        stream = inc.stream_files(spark, source, schema, pattern="*.parquet")
        inc.upsert_stream(stream, target, state, ["k"], ["seq"])
        return rows(upsert_log.current(spark, target, ["k"]), "k", "v")

    assert run() == [("a", 1), ("b", 2)]
    assert run() == [("a", 1), ("b", 2)]  # nothing new: nothing loaded again
    put("f2", [("a", 3, 9), ("c", 4, 4)])
    assert run() == [("a", 9), ("b", 2), ("c", 4)]
    state = str(tmp_path / "new-state")
    assert run() == [("a", 9), ("b", 2), ("c", 4)]  # without its checkpoint: the manifest knows both files
    manifest = committed.manifest(spark, target)
    assert manifest.count() == 2 and manifest.agg(F.sum("loaded_rows")).first()[0] == 4
    files = manifest.select("path").unionByName(spark.createDataFrame([("new",)], "path string"))
    assert rows(inc.pending(files, manifest, 0)) == [("new",)]
    assert inc.pending(files, manifest, 1).count() == 3


# --- indicator jobs -----------------------------------------------------------------
def test_indicators_last_row_wins_and_unmatched_are_listed(spark):
    names = spark.createDataFrame([("USA", 1, "texas", "USA.1_1"), ("USA", 2, "oklahoma", "USA.9.1_1")], "iso3 string, admin_level int, norm_name string, gid string")
    raw = spark.createDataFrame([
        (1, "USA", "United States", None, "Subnat", "USAr1", "Texas and Oklahoma", 2019, "f.csv", "0.5", "2"),
        (2, "USA", "United States", None, "Subnat", "USAr2", "Texas", 2019, "f.csv", " ", "3"),
        (3, "USA", "United States", None, "National", "USAt", "Total", 2019, "f.csv", "0.7", None),
        (4, "USA", "United States", None, "Subnat", "USAr3", "Atlantis", 2019, "f.csv", "0.1", "1"),
    ], "seq int, iso_code string, country string, continent string, level string, GDLCODE string, region string, year int, source_file string, shdi string, pop string")
    obs, unmatched = ind.load_indicators(raw, names, ["shdi", "pop"], {"pop": 1000.0})
    assert rows(obs, "gid", "admin_level", "variable", "raw_value", "note") == sorted([
        ("USA.1_1", 1, "shdi", None, None), ("USA.1_1", 1, "pop", 3000.0, None),
        ("USA.9.1_1", 2, "shdi", 0.5, "Extracted from: Texas and Oklahoma"), ("USA.9.1_1", 2, "pop", 2000.0, "Extracted from: Texas and Oklahoma"),
        ("USA", 0, "shdi", 0.7, None), ("USA", 0, "pop", None, None)], key=repr)
    assert rows(unmatched) == [("USA", "Atlantis", "Atlantis")]
    assert obs.first()["date"] == dt.date(2019, 1, 1)


def test_displacement(spark):
    data = [(1, "CHN", "China", 2020, "s", 1.0, None), (2, "HKG", "Hong Kong", 2020, "s", 10.0, None), (3, "CHN", "China", 2020, "s", 99.0, 5.0), (4, "CHN", "China", None, "s", 7.0, 7.0)]
    raw = spark.createDataFrame(data, "seq int, ISO3 string, Name string, Year int, source_file string, `Conflict Stock Displacement` double, `Disaster Internal Displacements` double")
    variables = ["Conflict Stock Displacement", "Disaster Internal Displacements"]
    both = rows(ind.displacement(raw, variables), "gid", "variable", "raw_value")
    assert both == [("CHN", "Conflict Total Displacement", 11.0), ("CHN", "Disaster Internal Displacements", 0.0)]
    last = rows(ind.displacement(raw, variables, on_collision="last"), "variable", "raw_value")
    assert last == [("Conflict Total Displacement", 10.0), ("Disaster Internal Displacements", 0.0)]


# --- views and reports ----------------------------------------------------------------
def test_country_event_view_keeps_both_sides(spark):
    wide = spark.createDataFrame([("USA", 0, "2020-01-01", 1.0), ("USA", 0, "2020-01-02", 2.0)], "gid string, admin_level int, date string, t double")
    events = spark.createDataFrame([(1, "USA", "2020-01-01"), (2, "USA", "2020-01-01"), (3, None, "2020-01-01"), (4, "MEX", None)], "event_id int, iso3_code string, start_date string")
    got = rows(views.country_event_view(wide, events), "gid", "admin_level", "date", "t", "event_id")
    assert got == sorted([("USA", 0, "2020-01-01", 1.0, 1), ("USA", 0, "2020-01-01", 1.0, 2), (None, None, "2020-01-01", None, 3), ("MEX", None, None, None, 4), ("USA", 0, "2020-01-02", 2.0, None)], key=repr)


def test_labels_fall_back_to_name_only_entries(spark):
    obs = spark.createDataFrame([("climate", "t"), ("aerosol", "t"), ("aerosol", "x")], "dataset string, variable string")
    catalog = spark.createDataFrame([("climate", "t", "Temp", "C"), (None, "t", "Any", "N")], "dataset string, variable string, label string, data_source string")
    assert rows(views.label_variables(obs, catalog), "dataset", "variable", "label") == sorted([("climate", "t", "Temp"), ("aerosol", "t", "Any"), ("aerosol", "x", None)], key=repr)


def test_failing_section_becomes_a_row(spark):
    out = reports.run_sections(spark, {"good": lambda: spark.range(2), "bad": lambda: spark.range(1).select("nope")})
    assert rows(out) == sorted([("good", '{"id":0}', None), ("good", '{"id":1}', None), ("bad", None, "AnalysisException")], key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 20000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("o"))
    last = keep_last(df, ["k"], ["o"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert last.where("k = 'hot'").first()["o"] == 19998


def test_wide_view_with_many_columns_uses_the_selected_statistic(spark):
    obs = spark.createDataFrame([
        ("population_age_sex", "USA", 0, "population_sex_age_f_0_count", 5.0, 1.0, None),
        ("population_age_sex", "USA", 0, "2021_2022_population_sex_age_m_0_4_count", 9.0, None, 7.0),
        ("climate", "USA", 0, "t2m", 9.0, 1.0, 7.0),
    ], "dataset string, gid string, admin_level int, variable string, sum double, mean double, raw_value double").withColumn("date", F.lit("2020-01-01").cast("date"))
    entries = [("population_age_sex", f"population_sex_age_f_{i}_count", f"Women of {i}") for i in range(77)]
    entries += [("population_age_sex", "2021_2022_population_sex_age_m_0_4_count", "Boys"), (None, "t2m", "T"), ("climate", "t2m", "C")]
    catalog = spark.createDataFrame(entries, "dataset string, variable string, label string")
    labels = views.catalog_labels(catalog, "population_age_sex")
    row = views.wide_view(obs, "population_age_sex", labels).collect()
    assert len(row) == 1 and len(row[0]) == 3 + 78
    assert row[0]["Women of 0"] == 5.0 and row[0]["Women of 1"] is None and row[0]["Boys"] == 7.0
    every = views.all_labels(catalog, {"climate": {"x": "X"}, "aerosol": {"b": "B"}})
    assert len(every) == 80 and every["aerosol", "b"] == "B" and ("climate", "x") not in every


def test_late_rows_make_a_day_be_aggregated_again(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put = lambda name, data: spark.createDataFrame(data, "k string, time string, value double").withColumn("time", F.col("time").cast("timestamp")).coalesce(1).write.parquet(f"{source}/{name}")
    put("f1", [("a", "2020-01-01 01:00:00", 1.0), ("a", "2020-01-05 01:00:00", 5.0)])
    schema = spark.read.parquet(f"{source}/f1").schema

    def run():
        stream = inc.stream_files(spark, source, schema, pattern="*.parquet")
        inc.append_stream(inc.daily_stream(stream.drop("file_path"), ["k"]), target, state)
        emitted, everything = spark.read.parquet(target), spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        return {str(r["date"]): (r["sum"], r["n_values"]) for r in inc.completed_days(everything, emitted, ["k"]).collect()}

    assert run() == {"2020-01-01": (1.0, 1), "2020-01-05": (5.0, 1)}
    put("f2", [("a", "2020-01-01 02:00:00", 10.0), ("a", "2020-01-09 01:00:00", 9.0)])
    assert run() == {"2020-01-01": (11.0, 2), "2020-01-05": (5.0, 1), "2020-01-09": (9.0, 1)}


def test_a_late_file_adds_to_its_own_days(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put = lambda name, data: spark.createDataFrame(data, "k string, time string, value double").withColumn("time", F.col("time").cast("timestamp")).coalesce(1).write.parquet(f"{source}/{name}")
    put("f1", [("a", "2020-01-01 01:00:00", 1.0), ("a", "2020-01-05 01:00:00", 5.0), ("b", "2020-01-05 01:00:00", None)])
    schema = spark.read.parquet(f"{source}/f1").schema

    def run():
        inc.load_daily(inc.stream_files(spark, source, schema, pattern="*.parquet"), target, state, ["k"])
        return {(r["k"], str(r["date"])): (r["sum"], r["mean"], r["n_values"]) for r in inc.daily_table(spark, target, ["k"]).collect()}

    assert run() == {("a", "2020-01-01"): (1.0, 1.0, 1), ("a", "2020-01-05"): (5.0, 5.0, 1), ("b", "2020-01-05"): (None, None, 1)}
    put("f2", [("a", "2020-01-01 02:00:00", 10.0)])
    assert run()[("a", "2020-01-01")] == (11.0, 5.5, 2)
    parts = committed.committed_rows(spark, target)
    assert parts.where("batch = 1").count() == 1  # the late file's own day, nothing else


def test_refreshed_view_equals_the_view_built_anew(spark, tmp_path):
    table, view = str(tmp_path / "obs"), str(tmp_path / "view")
    kind = "dataset string, gid string, admin_level int, variable string, mean double, note string"
    day = lambda data: spark.createDataFrame(data, kind).withColumn("date", F.lit("2020-01-01").cast("date"))
    sinks.write_observations(day([("climate", "USA", 0, "t", 1.0, "n1"), ("climate", "USA.1", 1, "t", 2.0, "n2"), ("aerosol", "USA", 0, "b", 3.0, "n3")]), table)
    build = lambda obs: obs.groupBy("dataset", "admin_level").agg(F.sum("mean").alias("total"), F.count("note").alias("notes"))
    sinks.write_view(build(spark.read.parquet(table)), view, materialised.PARTITIONS)
    untouched = lambda: {f for f in spark.read.parquet(view).inputFiles() if "dataset=aerosol" in f or "admin_level=1" in f}
    before = untouched()
    batch = day([("climate", "USA", 0, "t", 5.0, "m1"), ("climate", "MEX", 0, "t", 7.0, "m2"), ("climate", "MEX", 0, "t", 8.0, "m3")])
    batch = batch.withColumn("seq", F.col("mean"))
    touched = materialised.load_observations(spark, table, batch, ["seq"], ["mean"])
    assert touched == [("climate", 0)]
    plan = materialised.only(spark.read.parquet(table), touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((dataset" in plan or "PartitionFilters: [isnotnull(dataset" in plan
    materialised.refresh_view(spark, view, table, build, touched)
    assert rows(spark.read.parquet(view), "dataset", "admin_level", "total", "notes") == rows(build(spark.read.parquet(table)), "dataset", "admin_level", "total", "notes")
    assert rows(spark.read.parquet(view).where("dataset = 'climate'"), "admin_level", "total") == [(0, 13.0), (1, 2.0)]
    assert len(before) >= 2 and untouched() == before
    # the row that created a key keeps its note
    assert rows(spark.read.parquet(table).where("admin_level = 0 and dataset = 'climate'"), "gid", "note") == [("MEX", "m2"), ("USA", "n1")]


def test_coverage_store_computes_new_outlines_only(spark, tmp_path):
    grid, path = Grid("g", 0.0, 0.0, 1.0, 1.0, 10, 10), str(tmp_path / "store")
    box = lambda x, w: [(False, [(x, 0.2), (x + w, 0.2), (x + w, 1.5), (x, 1.5), (x, 0.2)])]
    kind = "gid string, admin_level int, rings array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"
    make = lambda *units: spark.createDataFrame([(g, 1, box(x, w)) for g, x, w in units], kind)
    first = make(("a", 0.5, 2.0), ("b", 3.25, 1.0), ("far", 50.0, 1.0), ("twin", 0.5, 2.0))
    second = make(("a", 0.5, 2.0), ("b", 3.5, 1.0), ("far", 50.0, 1.0))
    for units, new in ((first, 3), (first, 0), (second, 1)):
        known = committed.manifest(spark, path).count()
        got = zonal.stored_coverage(spark, units, grid, path)
        assert rows(got) == rows(coverage(units, grid).select(*got.columns))
        assert committed.manifest(spark, path).count() - known == new
    other = Grid("h", 0.0, 0.0, 2.0, 1.0, 5, 10)
    assert rows(zonal.stored_coverage(spark, second, other, path)) == rows(coverage(second, other).select(*got.columns))
