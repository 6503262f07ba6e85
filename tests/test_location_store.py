import glob
import os

import pytest

from tractline.operators.locations import build_location
from tractline.schemas import LOCATION_COLUMNS, ContractError
from tractline.sinks.location_store import LocationStore

SCHEMA = ", ".join(f"{c} {'bigint' if c == 'location_id' else 'string'}" for c in LOCATION_COLUMNS)


def rows_of(spark, pairs, extra=False):
    rows = [(i, street, None, "Town", "FL", None, None, None, None, None, "1.5", None) for i, street in pairs]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'f.csv' AS source_file") if extra else df


def held(df):
    return sorted(map(tuple, df.collect()), key=repr)


def data_files(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/version=*/**/*.parquet", recursive=True)}


def test_deliveries_add_up_to_the_one_shot_table(spark, tmp_path):
    store = LocationStore(spark, str(tmp_path), buckets=4)
    assert store.version() == 0 and store.read() is None
    first = rows_of(spark, [(i, f"{i} Oak St") for i in range(40)] + [(1, "1 Oak St "), (None, "nowhere")], extra=True)
    second = rows_of(spark, [(i, f"{i} Oak St") for i in range(20, 60)] + [(5, "moved"), (None, "nowhere")])
    store.merge("a", first)
    before = held(store.read())
    store.merge("b", second, second.select("city"))
    assert held(store.read()) == held(build_location(first, second)) and len(before) == 41
    # A delivery that is in already, under its name or as rows, changes no bucket.
    files = data_files(tmp_path)
    assert store.merge("b", second) == [] and store.version() == 2
    assert store.merge("c", second) == [] and store.version() == 3
    assert data_files(tmp_path) == files and held(store.read()) == held(build_location(first, second))
    # The number of buckets stays what it was when the table began.
    assert LocationStore(spark, str(tmp_path), buckets=99).buckets == 4
    store.drop_old()
    assert held(LocationStore(spark, str(tmp_path)).read()) == held(build_location(first, second))


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    store = LocationStore(spark, str(tmp_path), buckets=8)
    store.merge("a", rows_of(spark, [(i, "x") for i in range(200)]))
    assert store.merge("b", rows_of(spark, [(3, "y")])) == store.merge("c", rows_of(spark, [(3, "z")]))
    written = {f.split("/version=")[1].split("/")[0] for f in data_files(tmp_path)}
    assert written == {"1", "2", "3"} and store.read().count() == 202
    assert len(glob.glob(f"{tmp_path}/version=2/_bucket=*")) == len(glob.glob(f"{tmp_path}/version=3/_bucket=*")) == 1


def test_a_merge_that_stopped_before_its_manifest_can_run_again(spark, tmp_path, monkeypatch):
    store = LocationStore(spark, str(tmp_path), buckets=2)
    store.merge("a", rows_of(spark, [(1, "x")]))

    def stops(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(LocationStore, "_commit", stops)
        with pytest.raises(RuntimeError):
            store.merge("b", rows_of(spark, [(2, "y")]))
    assert store.version() == 1 and store.read().count() == 1
    store.merge("b", rows_of(spark, [(2, "y")]))
    assert store.version() == 2 and sorted(r.location_id for r in store.read().collect()) == [1, 2]


def test_empty_and_incomplete_deliveries(spark, tmp_path):
    store = LocationStore(spark, str(tmp_path))
    store.merge("empty", rows_of(spark, [(1, "x")]).limit(0))
    assert store.version() == 1 and store.read() is None
    with pytest.raises(ContractError):
        store.merge("wrong", spark.range(3))
    store.merge("some", rows_of(spark, [(1, "x")]))
    assert store.read().count() == 1
