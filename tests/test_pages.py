import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tractline.operators.locations import page
from tractline.operators.ranks import paged, ranked_in_order
from tractline.sinks import files

SCHEMA = "person_id bigint, visit_start_date date, visit_occurrence_id bigint, category string, page_note string"


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(1)
    rows = []
    for i in range(5000):
        # One person has most of the rows, and one category nearly all.
        person = 7 if rng.random() < 0.6 else rng.choice([None, *range(40)])
        day = rng.choice([None, dt.date(2012, 1, 1) + dt.timedelta(rng.randrange(300))])
        rows.append((person, day, i, rng.choices(["Latlong", "Address", "Invalid", None], [90, 5, 4, 1])[0], "x"))
    return spark.createDataFrame(rows, SCHEMA).repartition(7), rows


def key(r):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in (r[0], r[1].toordinal() if r[1] else None, r[2]))


ORDER = ("person_id", "visit_start_date", "visit_occurrence_id")


def test_ranks_are_places_in_the_order(spark, visits):
    df, rows = visits
    got = ranked_in_order(df, ORDER, "rank", ["category"], 9).collect()
    for category in {r[3] for r in rows}:
        want = [r[2] for r in sorted((r for r in rows if r[3] == category), key=key)]
        mine = sorted((r for r in got if r.category == category), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(len(want))) and [r.visit_occurrence_id for r in mine] == want


def test_every_page_but_the_last_is_full(spark, visits):
    df, rows = visits
    counts = paged(df, ORDER, 300, ["category"], 11).groupBy("category", "page").count().collect()
    for category in {r[3] for r in rows}:
        sizes = [r["count"] for r in sorted((r for r in counts if r.category == category), key=lambda r: r.page)]
        assert set(sizes[:-1]) <= {300} and 0 < sizes[-1] <= 300 and sum(sizes) == sum(r[3] == category for r in rows)
    with pytest.raises(ValueError):
        paged(df, ORDER, 0)


def test_one_page_anywhere(spark, visits):
    df, rows = visits
    want = [r[2] for r in sorted(rows, key=key)]
    for offset, n in ((0, 10), (4321, 200), (4990, 100), (6000, 10)):
        assert [r.visit_occurrence_id for r in page(df, ORDER, offset, n).collect()] == want[offset : offset + n]
    assert page(df.limit(0), ORDER, 0, 10).collect() == []


def test_pages_as_files(spark, visits, tmp_path):
    df, rows = visits
    target = str(tmp_path / "pages")
    files.write_category_batches(df.where("category IS NOT NULL"), target, batch_rows=400, partitions=6)
    back = spark.read.csv(target, header=True).withColumn("file", F.input_file_name())
    per_page = back.groupBy("category", "page").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files")).collect()
    assert all(r.files == 1 for r in per_page)
    for category in ("Latlong", "Address", "Invalid"):
        sizes = [r.n for r in sorted((r for r in per_page if r.category == category), key=lambda r: r.page)]
        assert set(sizes[:-1]) <= {400} and sum(sizes) == sum(r[3] == category for r in rows)
