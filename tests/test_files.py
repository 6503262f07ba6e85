import pytest
from pyspark.sql import functions as F

from tractline.plans import linkage
from tractline.schemas import LOCATION_COLUMNS, LOCATION_HISTORY_COLUMNS, TRACTS, ContractError
from tractline.session import broadcast_within, scratch_folder
from tractline.sinks import files
from tractline.sources import csv_folder as C
from tractline.sources import tables
from tractline.streaming import incremental

LOCATION_HEADER = ",".join(LOCATION_COLUMNS)
LOCATION_LINE = "1,1248 N Any Ave,,FRESNO,CA,93703,,,,USA,36.7,-119.7"


@pytest.fixture
def folder(tmp_path):
    inbox = tmp_path / "input"
    inbox.mkdir()
    (inbox / "multi.csv").write_text('street,city,state,zip,year,entity_id\n"1 A St, #2",Town,FL,02139,2019,1\n,NA,,,,2\n')
    (inbox / "single.csv").write_text("year,entity_id,address\n2019,1,1 A St Town FL 02139\n")
    (inbox / "coords_a.csv").write_text("entity_id,year,latitude,longitude\n1,2012,29.6,-82.4\n")
    (inbox / "coords_b.csv").write_text(" Longitude ,LATITUDE,entity_id,year\n-82.5,29.7,2,2023\n")
    (inbox / "both.csv").write_text("latitude,longitude,address,entity_id\n1,2,x,3\n")
    (inbox / "LOCATION.csv").write_text("\ufeff" + LOCATION_HEADER + "\n" + LOCATION_LINE + "\n", encoding="utf-8")
    (inbox / "location_history.csv").write_text("location_id,entity_id\n1,1\n")
    (inbox / "other.csv").write_text("a,b\n1,2\n")
    (inbox / "twice.csv").write_text("address,Address \nx,y\n")
    (inbox / "notes.txt").write_text("x")
    (inbox / "UPPER.CSV").write_text("address\nx\n")
    (inbox / "sub").mkdir()
    (inbox / "sub" / "deep.csv").write_text("address\nx\n")
    return str(inbox)


def names(paths):
    return sorted(p.rsplit("/", 1)[-1] for p in paths)


def test_folder_is_read_by_header_name(spark, folder):
    scan = C.scan_folder(spark, folder)
    assert set(scan.frames) == {C.MULTI, C.SINGLE, C.COORDINATES, C.LOCATION}
    assert names(scan.rejected) == ["location_history.csv", "other.csv", "twice.csv"]
    coords = {r.entity_id: (r.latitude, r.longitude, r.source_file) for r in scan.frames[C.COORDINATES].collect()}
    assert coords == {
        "1": ("29.6", "-82.4", "coords_a.csv"), "2": ("29.7", "-82.5", "coords_b.csv"), "3": ("1", "2", "both.csv"),
    }
    first, second = scan.frames[C.MULTI].orderBy("entity_id").collect()
    assert (first.street, first.zip) == ("1 A St, #2", "02139")
    assert (second.street, second.city, second.zip) == (None, None, None)
    assert scan.frames[C.LOCATION].first().location_id == "1"


def test_detect_shape_by_name_and_columns():
    parts = ["street", "city", "state", "zip"]
    assert C.detect_shape("x/Location.csv", []) == C.LOCATION
    assert C.detect_shape("LOCATION_HISTORY.csv", []) == C.LOCATION_HISTORY
    assert C.detect_shape("a.csv", ["latitude", "longitude", "address", *parts]) == C.COORDINATES
    assert C.detect_shape("a.csv", ["address", *parts]) == C.SINGLE
    assert C.detect_shape("a.csv", parts) == C.MULTI
    assert C.detect_shape("a.csv", parts[:3] + ["latitude"]) is None


def test_contracts_name_what_is_missing():
    with pytest.raises(ContractError, match="address_2.*county"):
        C.require_location([c for c in LOCATION_COLUMNS if c not in ("address_2", "county")])
    with pytest.raises(ContractError, match="end_date"):
        C.require_location_history(LOCATION_HISTORY_COLUMNS[:-1])


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        C.list_csv_files(spark, str(tmp_path / "absent"))


def test_incremental_run_takes_each_file_once(spark, folder, tmp_path):
    target, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    seen = []

    def handle(scan, batch_id):
        seen.append((batch_id, sorted(scan.frames), names(scan.rejected)))

    incremental.run_new_files(spark, folder, progress, handle)
    incremental.run_new_files(spark, folder, progress, handle)
    assert len(seen) == 1 and seen[0][1] == sorted([C.COORDINATES, C.LOCATION, C.MULTI, C.SINGLE])
    (tmp_path / "input" / "late.csv").write_text("address,entity_id\nx,9\n")
    incremental.run_new_files(spark, folder, progress, handle)
    assert len(seen) == 2 and seen[1][1] == [C.SINGLE]

    other = str(tmp_path / "progress2")
    for _ in range(2):
        incremental.append_new_files(spark, folder, target, other, C.COORDINATES, files_per_batch=2)
    assert spark.read.parquet(target).count() == 3


def test_manifest(spark, folder):
    todo = incremental.files_to_do(spark, folder, spark.createDataFrame([("multi.csv",), (None,)], "file_name string"))
    assert "multi.csv" not in names(r.path for r in todo.collect()) and todo.count() == 8


def test_writers_refuse_the_input_folder(spark, folder):
    df = spark.createDataFrame([(1,)], "a int")
    for target in (folder, folder + "/output", folder + "/x/../output"):
        with pytest.raises(ValueError):
            files.write_location_history(df, target, input_path=folder + "/")
    files.check_target(folder + "-output", folder)


def test_category_batches_are_paged_and_ordered(spark, tmp_path):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("person_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("visit_start_date"),
        F.col("id").alias("visit_occurrence_id"),
        F.when(F.col("id") % 2 == 0, "Latlong").otherwise("Address").alias("category"),
    )
    target = tmp_path / "batches"
    files.write_category_batches(rows, str(target), batch_rows=40)
    total = 0
    for part in target.glob("category=*/page=*/*.csv"):
        lines = part.read_text().splitlines()[1:]
        assert len(lines) <= 40
        keys = [(int(p), d, int(v)) for p, d, v in (line.split(",") for line in lines)]
        assert keys == sorted(keys)
        total += len(lines)
    assert total == 1000


def test_results_are_written_per_source_file(spark, folder, tmp_path):
    square = [(-90.0, 20.0, -70.0, 20.0), (-70.0, 20.0, -70.0, 40.0), (-70.0, 40.0, -90.0, 40.0), (-90.0, 40.0, -90.0, 20.0)]
    tracts = spark.createDataFrame([("1001020100", "x", v, square) for v in (2010, 2020)], TRACTS)
    rows = C.scan_folder(spark, folder).frames[C.COORDINATES]
    files.write_with_fips(linkage.link_coordinates(rows, tracts), str(tmp_path / "fips"), folder)
    back = spark.read.csv(str(tmp_path / "fips"), header=True)
    assert {(r.source_file, r.FIPS) for r in back.collect()} == {
        ("coords_a.csv", "01001020100"), ("coords_b.csv", "01001020100"), ("both.csv", None),
    }
    with pytest.raises(ContractError):
        linkage.link_coordinates(rows.drop("year"), tracts)
    given = rows.withColumn("year_for_fips", F.when(F.col("entity_id") == "1", "2010").otherwise("2000"))
    assert linkage.link_coordinates(given, tracts).count() == 1


def test_history_is_written_as_read(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None, 'say "x", y')], "p string, q string, r string")
    files.write_location_history(df, str(tmp_path / "h"))
    back = spark.read.csv(str(tmp_path / "h"), header=True, escape='"').first()
    assert tuple(back) == (" a ", None, 'say "x", y')


def test_tables_from_parquet(spark, tmp_path):
    spark.range(1).select(F.col("id").alias("PERSON_ID")).write.parquet(str(tmp_path / "person.parquet"))
    with pytest.raises(Exception):
        tables.read_parquet_tables(spark, str(tmp_path))


def test_database_source_refuses_secrets_in_the_url(spark):
    with pytest.raises(ValueError):
        tables.read_database_tables(spark, "jdbc:x:y;password=z", {})


@pytest.mark.parametrize(
    "ids",
    [
        [1] * 500 + list(range(2, 400)),
        [None] * 50 + list(range(0, 10**9, 10**6)),
        [7] * 30,
        [None],
        [],
        [2**62, -5, 3],
    ],
)
def test_id_ranges_hold_every_row_once(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "k bigint")
    cuts = [r.low for r in spark.sql(tables.cuts_query("{df}", "k", 8), df=df).collect()]
    ranges = tables.range_predicates("k", cuts)
    counts = [df.where(p).count() for p in ranges]
    assert sum(counts) == len(ids) and len(ranges) <= 8
    known = [i for i in ids if i is not None]
    most = max((known.count(i) for i in set(known)), default=0)
    # No range is larger than two shares and the most frequent id, which no condition on ids can split.
    assert max(counts) <= 2 * (len(known) / 8 + 1) + most + ids.count(None)


def test_id_cuts_are_those_of_equal_shares_without_a_sort_of_the_table(spark):
    ids = [i * i * i - 10**6 for i in range(-300, 300)] + [5] * 100 + [-(2**63), 2**63 - 1, None]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint")
    found = spark.sql(tables.cuts_query("{df}", "k", 16), df=df)
    known = sorted(i for i in ids if i is not None)
    more, size = len(known) % 16, len(known) // 16
    assert sorted(r.low for r in found.collect()) == sorted({known[i * size + min(i, more)] for i in range(16)})
    assert "ntile" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_scratch_and_broadcast_limits(spark):
    assert scratch_folder(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))

    def hinted(df, limit):
        return "hint" in broadcast_within(df, limit)._jdf.queryExecution().logical().toString().lower()

    assert hinted(spark.range(10), 480) and not hinted(spark.range(11), 480)
    long_text = spark.range(1).select(F.repeat(F.lit("x"), 5000).alias("t"))
    assert hinted(long_text, 5048) and not hinted(long_text, 5047)
    assert not hinted(spark.range(1).select(F.array("id")), 10**9)


def test_malformed_rows_reject_their_file(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put("good.csv", 'street,city,state,zip,year,entity_id\n"1 A St, ""x"", #2",Town,FL,02139,2019,1\n2 B St,Town,FL,,,2\n')
    put("shifted.csv", "street,city,state,zip,year,entity_id\n1 A St, Unit 3,Town,FL,02139,2019,1\n2 B St,Town,FL,33127,2019,2\n")
    put("trailing.csv", "address,year,entity_id\n1 A St,2019,1,\n1 B St,2019,2,,\n")
    put("short.csv", "address,year,entity_id\n1 A St,2019\n")
    put("header_only.csv", "address,year,entity_id\n")
    scan = C.scan_folder(spark, str(tmp_path))
    reasons = {p.rsplit("/", 1)[-1]: why for p, why in scan.rejected.items()}
    assert reasons == {
        "shifted.csv": "rows with more fields than the header: 1",
        "trailing.csv": "rows with more fields than the header: 2",
    }
    multi = {r.entity_id: (r.street, r.city, r.source_file) for r in scan.frames[C.MULTI].collect()}
    assert multi == {"1": ('1 A St, "x", #2', "Town", "good.csv"), "2": ("2 B St", "Town", "good.csv")}
    assert [(r.address, r.year, r.entity_id) for r in scan.frames[C.SINGLE].collect()] == [("1 A St", "2019", None)]


def test_only_the_beginnings_are_read_for_headers(spark, tmp_path):
    for name in ("a b.csv", "c.csv"):
        with open(tmp_path / name, "w") as file:
            file.write("address,year,entity_id\n")
            file.writelines(f"{i} Long Street Name Town FL 02139,2019,{i}\n" for i in range(200_000))
    (tmp_path / "empty.csv").write_text("")
    files_there = C.list_csv_files(spark, str(tmp_path))
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    total = lambda: sum(x.getBytesRead() for x in statistics())
    before = total()
    headers = C.read_headers(spark, files_there)
    read = total() - before
    assert {p.rsplit("/", 1)[-1]: h for p, h in headers.items()} == {
        "a%20b.csv": ["address", "year", "entity_id"], "c.csv": ["address", "year", "entity_id"], "empty.csv": [],
    } or names(headers) == ["a b.csv", "c.csv", "empty.csv"]
    assert sorted(map(len, headers.values())) == [0, 3, 3]
    assert 0 < read < 2 * 64 * 1024, read
