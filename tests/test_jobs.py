import pytest
from pyspark.sql import functions as F

from tractline.operators import exposure, hospitals, tracts
from tractline.plans import jobs
from tractline.schemas import ADDRESS_POINTS, LOCATION_COLUMNS, TRACTS, ContractError
from tractline.sinks import files
from tractline.sources import tables
from tractline.streaming import incremental

SQUARE = [(-82.0, 25.0, -80.0, 25.0), (-80.0, 25.0, -80.0, 31.0), (-80.0, 31.0, -82.0, 31.0), (-82.0, 31.0, -82.0, 25.0)]


@pytest.fixture
def polygons(spark):
    return spark.createDataFrame([("12031000101", "x", v, SQUARE) for v in (2010, 2020)], TRACTS)


@pytest.fixture
def points(spark):
    return spark.createDataFrame([(1, "240 NW 25th St", "Miami", "FL", "33127", 25.8, -80.2)], ADDRESS_POINTS)


def test_a_source_file_gets_few_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 20_000, numPartitions=40).select(
        "id", F.concat(F.lit("f"), F.col("id") % 50, F.lit(".csv")).alias("source_file")
    )
    files.write_with_fips(rows, str(tmp_path / "out"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = list((tmp_path / "out").glob("source_file=*/*.csv"))
    assert 50 <= len(written) <= 60
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 20_000


def test_clinical_tables_from_csv_to_all_outputs(spark, tmp_path, polygons, points):
    inbox, out = tmp_path / "cdm", tmp_path / "out"
    inbox.mkdir()
    header = ",".join(LOCATION_COLUMNS)
    lines = [
        "10,240 NW 25th St,Apt 4,Miami,FL,33127,,,,USA,,",
        "2,1 Any St,,Town,FL,33101,,,,USA,30.5,-81.5",
        "1,,,,,,,,,,,",
    ]
    (inbox / "LOCATION.csv").write_text("﻿" + "\n".join([header, *lines]) + "\n", encoding="utf-8")
    (inbox / "Person.csv").write_text("PERSON_ID,x\n1,\n2,\n3,\n")
    history = ["location_id,relationship_type_concept_id,domain_id,entity_id,start_date,end_date"]
    history += [f"{place},32848,1147314,{person},1998-01-01,2020-01-01" for person, place in ((1, 10), (2, 2), (3, 1))]
    (inbox / "LOCATION_HISTORY.csv").write_text("\n".join(history) + "\n")
    visits = ["visit_end_date,visit_start_date,person_id,visit_occurrence_id"]
    visits += [f"12/16/2013,12/16/2013,{p},{100 + p}" for p in (1, 2, 3)] + ["01/02/2011,01/01/2011,1,200", "bad,12/16/2013,1,201"]
    (inbox / "VISIT_OCCURRENCE.csv").write_text("\n".join(visits) + "\n")

    cdm = tables.read_csv_tables(spark, str(inbox))
    assert dict(cdm.visit.dtypes)["visit_start_date"] == "date" and dict(cdm.location.dtypes)["location_id"] == "bigint"
    jobs.run_cdm(cdm, str(out), polygons, points)
    rows = {r.person_id: r for r in spark.read.csv(str(out / "with_fips"), header=True).collect()}
    assert {k: (r.category, r.FIPS) for k, r in rows.items()} == {
        "1": ("Address", "12031000101"), "2": ("Latlong", "12031000101"), "3": ("Invalid", None),
    }
    (place,) = (out / "LOCATION").glob("*.csv")
    assert [line.split(",")[0] for line in place.read_text().splitlines()] == ["location_id", "1", "2", "10"]
    assert spark.read.csv(str(out / "categories"), header=True).count() == 3
    assert spark.read.csv(str(out / "invalid"), header=True).count() == 1
    (inbox / "Person.csv").unlink()
    with pytest.raises(ContractError, match="person"):
        tables.read_csv_tables(spark, str(inbox))


def test_folder_job_reports_rejects_and_takes_new_files_only(spark, tmp_path, polygons, points):
    inbox, out, progress = tmp_path / "in put", tmp_path / "out", str(tmp_path / "progress")
    inbox.mkdir()
    (inbox / "a b.csv").write_text("entity_id,year,latitude,longitude\n1,2012,30.5,-81.5\n")
    (inbox / "m.csv").write_text("entity_id,street,city,state,zip\n2,240 NW 25th St #3,Miami,FL,33127.0\n")
    (inbox / "bad.csv").write_text("a,b\n1,2\n")
    (inbox / "empty.csv").write_text("")
    jobs.run_folder(spark, str(inbox), str(out), points, polygons)
    coordinates = spark.read.csv(str(out / "with_fips/coordinates"), header=True).first()
    assert (coordinates.FIPS, coordinates.source_file) == ("12031000101", "a b.csv") or coordinates.source_file == "a%20b.csv"
    assert spark.read.csv(str(out / "with_coordinates/multi"), header=True).first().geocode_result == "Geocoded"
    rejected = {r.path.rsplit("/", 1)[-1] for r in spark.read.csv(str(out / "rejected"), header=True).collect()}
    assert rejected == {"bad.csv", "empty.csv"}
    with pytest.raises(ValueError):
        jobs.run_folder(spark, str(inbox), str(inbox / "out"), points, polygons)

    steps = str(tmp_path / "steps")
    for _ in range(2):
        jobs.run_folder(spark, str(inbox), steps, points, polygons, progress=progress)
    (inbox / "late.csv").write_text("entity_id,year,latitude,longitude\n9,2012,30.5,-81.5\n")
    jobs.run_folder(spark, str(inbox), steps, points, polygons, progress=progress)
    batches = sorted(p.name for p in (tmp_path / "steps").iterdir() if p.name.startswith("batch"))
    assert batches == ["batch_id=0", "batch_id=1"]
    assert spark.read.csv(f"{steps}/batch_id=1/with_fips/coordinates", header=True).count() == 1


def test_a_recorded_manifest_notices_replaced_files(spark, tmp_path):
    inbox, manifest = tmp_path / "in", str(tmp_path / "manifest")
    inbox.mkdir()
    (inbox / "a.csv").write_text("address\nx\n")
    (inbox / "b.csv").write_text("address\nx\n")
    todo = incremental.files_to_do(spark, str(inbox), spark.createDataFrame([], "file_name string"))
    incremental.record_files(todo, manifest)
    assert incremental.files_to_do(spark, str(inbox), spark.read.parquet(manifest)).count() == 0
    (inbox / "b.csv").write_text("address\nlonger\n")
    left = incremental.files_to_do(spark, str(inbox), spark.read.parquet(manifest)).collect()
    assert [r.file_name for r in left] == ["b.csv"]


def full_partitions(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_rows_that_match_nothing_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(400).select("id", F.lit(None).cast("string").alias("FIPS"), F.lit(2012).alias("year"))
        values = spark.createDataFrame([(1, "12031000101", 2012, 2.0)], "variable_id int, geocode string, year int, value double")
        joined = exposure.join_by_geocode(rows, values, {1: "v"}, broadcast_bytes=0)
        assert joined.count() == 400 and joined.columns == ["id", "FIPS", "year", "v"]
        crosswalk = spark.createDataFrame([("12031000101", "32202", 1)], "FIPS string, zcta string, weight int")
        rolled = exposure.roll_up(rows, "zcta", crosswalk=crosswalk, broadcast_bytes=0)
        flagged = hospitals.flag_hospitals(rows, F.lit(""), spark.createDataFrame([("a",), ("",)], "address string"), broadcast_bytes=0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (joined, rolled, flagged):
            assert full_partitions(df) > 4
        assert flagged.where("at_hospital").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_point_or_an_address_are_spread(spark, polygons, points):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = tracts.build_tract_index(polygons, broadcast_bytes=0)
        # Read from a table: the optimizer knows of literals that they are null.
        none = F.when(F.col("id") < 0, F.lit(1.0))
        rows = spark.range(400).select("id", none.alias("latitude"), none.alias("longitude"), F.lit(2020).alias("year_for_fips"))
        places = rows.select("id", none.cast("string").alias("FIPS"), F.lit(2012).alias("year"))
        values = spark.createDataFrame([(1, "12031000101", 2012, 2.0)], "variable_id int, geocode string, year int, value double")
        found = [
            tracts.assign_tracts(rows, index),
            tracts.assign_codes(rows, index),
            exposure.join_by_geocode(places, values, {1: "v"}, broadcast_bytes=0),
            exposure.join_by_geocode(places, values, {1: "v"}, year_rule="latest", broadcast_bytes=0),
        ]
        for df in found:
            assert df.count() == 400 and full_partitions(df) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_lists_of_variables_are_joined(spark):
    values = spark.range(2000).select(F.col("id").alias("variable_id"), F.lit("x").alias("geocode"))
    got = exposure.select_variables(values, variable_ids=range(500, 1100))
    assert got.count() == 600 and got.columns == values.columns


def test_index_is_kept_and_codes_come_together(spark, tmp_path, polygons):
    rows = spark.createDataFrame([(1, 30.5, -81.5), (2, None, -81.0), (3, 10.0, 10.0), (4, 30.5, -81.5)], "id int, latitude double, longitude double")
    index = tracts.build_tract_index(polygons).save(str(tmp_path / "index"))
    shuffled = tracts.build_tract_index(polygons, broadcast_bytes=0).save(str(tmp_path / "other"))
    assert index.broadcastable and not shuffled.broadcastable and index.levels == shuffled.levels
    for one in (index, shuffled):
        got = {r.id: (r.FIPS_2010, r.FIPS_2020) for r in tracts.assign_codes(rows, one).collect()}
        assert got == {1: ("12031000101",) * 2, 2: (None, None), 3: (None, None), 4: ("12031000101",) * 2}


def test_parts_on_both_sides_of_the_antimeridian(spark):
    def square(x):
        return [(x, 51.0, x + 1, 51.0), (x + 1, 51.0, x + 1, 52.0), (x + 1, 52.0, x, 52.0), (x, 52.0, x, 51.0)]

    df = spark.createDataFrame([("02016000100", "x", 2020, square(178.0) + square(-179.5))], TRACTS)
    index = tracts.build_tract_index(df, level=4)
    assert index.cells.count() < 2000
    rows = spark.createDataFrame([(1, 51.5, 178.5), (2, 51.5, -179.0), (3, 51.5, 0.0)], "id int, latitude double, longitude double")
    got = {r.id: r.FIPS_2020 for r in tracts.assign_codes(rows, index).collect()}
    assert got == {1: "02016000100", 2: "02016000100", 3: None}


def test_runs_add_to_one_location_table(spark, tmp_path, polygons, points):
    out = tmp_path / "out"
    header = ",".join(LOCATION_COLUMNS)
    line = lambda i, lat: f"{i},{i} Main St,,Town,FL,33127,,,,USA,{lat},-81.5"
    table = lambda: [(r.location_id, float(r.latitude)) for r in spark.read.csv(str(out / "LOCATION"), header=True).collect()]

    def run(name, *rows):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "LOCATION.csv").write_text("\n".join([header, *rows]) + "\n")
        for _ in range(2):
            jobs.run_folder(spark, str(folder), str(out), points, polygons, progress=str(tmp_path / f"progress-{name}"))

    run("first", line(10, 30.5), line(9, 30.6))
    assert table() == [("9", 30.6), ("10", 30.5)]
    # Another folder with a checkpoint of its own has the same batch numbers.
    run("second", line(2, 30.7), line(10, 30.5), line(10, 31.0))
    assert table() == [("2", 30.7), ("9", 30.6), ("10", 30.5), ("10", 31.0)]
