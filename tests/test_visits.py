import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tractline.operators import locations, summaries, visits
from tractline.schemas import LOCATION_COLUMNS, ContractError
from tractline.session import stored

LOCATION = ", ".join(f"{c} {'bigint' if c == 'location_id' else 'string'}" for c in LOCATION_COLUMNS)
HISTORY = (
    "location_id bigint, relationship_type_concept_id bigint, domain_id bigint, entity_id bigint, "
    "start_date date, end_date date"
)
VISIT = "visit_occurrence_id bigint, person_id bigint, visit_start_date date, visit_end_date date"


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def location(spark, rows):
    full = [(i, a, None, "City", "FL", "32209", None, None, None, None, lat, lon) for i, a, lat, lon in rows]
    return spark.createDataFrame(full, LOCATION)


def history(spark, rows):
    return spark.createDataFrame([(i, 1, 1, p, day(s), day(e)) for i, p, s, e in rows], HISTORY)


def visit(spark, rows):
    return spark.createDataFrame([(v, p, day(s), day(e)) for v, p, s, e in rows], VISIT)


def persons(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "person_id bigint")


def pairs(df):
    return sorted((r.visit_occurrence_id, r.location_id) for r in df.collect())


@pytest.fixture
def small(spark):
    return {
        "person": persons(spark, [1, 2, 3]),
        "location": location(spark, [(10, "1 A St", "30", "-80"), (11, "2 B St", "", ""), (12, "x", "30", "0")]),
        "history": history(
            spark,
            [
                (10, 1, "2012-01-01", "2015-06-30"),
                (11, 1, "2015-01-01", None),
                (11, 2, "2010-01-01", "9999-12-31"),
                (12, 9, "2010-01-01", "2020-01-01"),
            ],
        ),
        "visit": visit(
            spark,
            [
                (100, 1, "2012-01-01", "2012-01-01"),
                (101, 1, "2015-06-30", "2015-07-01"),
                (102, 1, "2015-06-30", "2015-06-30"),
                (103, 1, "2014-01-01", None),
                (104, 2, "2011-12-31", "2011-12-31"),
                (105, 2, "2031-05-05", "2031-05-06"),
                (106, 9, "2013-01-01", "2013-01-01"),
                (107, 1, None, "2014-01-01"),
                (108, 1, "2030-01-01", "2030-02-01"),
            ],
        ),
    }


@pytest.mark.parametrize("bin_days", [1, 30, 365, 10_000])
def test_containment_is_inclusive_and_drops_missing_dates(small, bin_days):
    assert pairs(visits.visits_in_residence(**small, bin_days=bin_days)) == [(100, 10), (102, 10), (105, 11)]
    open_ended = visits.visits_in_residence(**small, open_ended=True, bin_days=bin_days)
    assert pairs(open_ended) == [(100, 10), (101, 11), (102, 10), (102, 11), (105, 11), (108, 11)]


def test_no_cutoff_keeps_early_visits(small):
    assert (104, 11) in pairs(visits.visits_in_residence(**small, cutoff=None))


def test_left_joins_keep_unmatched_rows(small):
    assert visits.person_visits(small["person"], small["visit"]).where("visit_occurrence_id is null").count() == 1
    assert visits.located_history(small["location"], small["history"]).count() == 4


@pytest.mark.parametrize("last_bin_from", [dt.date(2012, 6, 1), dt.date(2016, 1, 1), None])
def test_against_brute_force_with_one_dominant_person(spark, last_bin_from):
    rng = random.Random(7)
    base = dt.date(2011, 1, 1)

    def span(longest):
        start = base + dt.timedelta(rng.randrange(3000))
        return start, start + dt.timedelta(rng.randrange(longest))

    def person():
        return 1 if rng.random() < 0.4 else rng.randrange(2, 40)

    stays = [(i, person(), *span(900)) for i in range(300)]
    trips = [(i, person(), *span(20)) for i in range(600)]
    want = sorted(
        (v, i)
        for v, p, s, e in trips
        for i, q, a, b in stays
        if p == q and s >= dt.date(2012, 1, 1) and a <= s <= b and a <= e <= b
    )
    got = visits.visits_in_residence(
        persons(spark, range(1, 40)),
        spark.createDataFrame(trips, VISIT),
        location(spark, [(i, "a", "1", "1") for i in range(300)]),
        spark.createDataFrame([(i, 1, 1, p, s, e) for i, p, s, e in stays], HISTORY),
        last_bin_from=last_bin_from,
    )
    assert pairs(got) == want and len(want) > 500


def test_categories_add_up(spark):
    rows = [(1, "a", "30", "-80"), (2, "a", "", "NA"), (3, "n/a", "0", None), (4, "a", "30", ""), (5, None, "0.0", "x")]
    df = location(spark, rows)
    got = {r.location_id: r.category for r in visits.classify(df).collect()}
    assert got == {1: "Latlong", 2: "Address", 3: "Invalid", 4: "Unclassified", 5: "Latlong"}
    parts = [visits.with_coordinates_given(df), visits.with_address_only(df), visits.without_location(df)]
    assert [sorted(r.location_id for r in p.collect()) for p in parts] == [[1, 5], [2], [3]]
    counts = summaries.row_counts(visits.classify(df), "category")
    assert sum(r.n_rows for r in counts.collect()) == len(rows)


def test_visits_are_shuffled_once(small):
    df = visits.visits_in_residence(**{k: v.hint("merge") for k, v in small.items()})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line and "visit" in line for line in plan.splitlines()) <= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_location_build_merges_and_sorts(spark):
    a = location(spark, [(2, "B St ", "1", "1"), (2, "B St", "1", "1"), (1, None, None, None)])
    b = location(spark, [(1, None, None, None), (3, "C", "1", "1")]).withColumn("FIPS", F.lit("x"))
    got = locations.build_location(a, b, a.select("location_id")).collect()
    assert [(r.location_id, r.address_1) for r in got] == [(1, None), (2, "B St"), (3, "C")]
    with pytest.raises(ContractError):
        locations.build_location(a.select("location_id"))


def test_union_pages_and_reductions(spark):
    older = spark.createDataFrame([(1, 2010)], "id int, year_for_fips int")
    newer = spark.createDataFrame([(2, 2020, "n"), (3, 2015, "o")], "id int, year_for_fips int, note string")
    both = locations.union_vintages(older, newer)
    assert sorted((r.id, r.note) for r in both.collect()) == [(1, None), (2, "n"), (3, "o")]
    assert sorted(r.id for r in summaries.supported_vintages(both).collect()) == [1, 2]
    assert sorted(r.year_for_fips for r in summaries.vintages_present(both).collect()) == [2010, 2020]
    assert summaries.all_null(both, "note", "id").first().asDict() == {"note": False, "id": False}
    assert summaries.all_null(older.withColumn("note", F.lit(None)), "note").first().note
    assert [r.id for r in locations.page(both, ("id",), offset=1, rows=1).collect()] == [2]
    assert [r.id for r in locations.in_row_order(both, "id").collect()] == [1, 2, 3]


def test_link_visits_uses_only_usable_places(spark):
    from tractline.plans.linkage import link_visits
    from tractline.schemas import ADDRESS_POINTS, TRACTS

    square = [(-85.0, -5.0, 5.0, -5.0), (5.0, -5.0, 5.0, 35.0), (5.0, 35.0, -85.0, 35.0), (-85.0, 35.0, -85.0, -5.0)]
    tracts = spark.createDataFrame([(f"100102010{v % 7}", "x", v, square) for v in (2010, 2020)], TRACTS)
    points = spark.createDataFrame([(1, "7 Oak St", "City", "FL", "32209", 30.5, -80.5)], ADDRESS_POINTS)
    rows = [(1, "7 Oak St", "0", "0"), (2, "7 Oak St", "30", "-80"), (3, "", "0", "0"), (4, "7 Oak St", "30", "0")]
    stays = [(i, 5, "2013-01-01", "2023-12-31") for i, *_ in rows]
    trips = [(100, 5, "2013-05-05", "2013-05-06"), (101, 5, "2021-05-05", "2021-05-06")]
    old, new = (f"0100102010{v % 7}" for v in (2010, 2020))

    def linked(address_points):
        df = link_visits(persons(spark, [5]), visit(spark, trips), location(spark, rows), history(spark, stays), tracts, address_points)
        return {
            (r.location_id, r.year): (r.category, r.latitude, r.geocode_result, r.reason, r.FIPS) for r in df.collect()
        }

    imprecise = "Imprecise Geocode"
    got = linked(points)
    assert len(got) == 8
    assert got[1, 2013] == ("Address", 30.5, "Geocoded", "", old) and got[1, 2021][-1] == new
    assert got[2, 2013] == ("Latlong", 30.0, "Geocoded", "", old) and got[2, 2021][-1] == new
    assert got[3, 2013] == ("Invalid", None, imprecise, "Street missing", None)
    assert got[4, 2021] == ("Unclassified", None, imprecise, "", None)
    assert linked(None)[1, 2013] == ("Address", None, imprecise, "", None)


def test_no_side_is_sent_around_by_a_guess(small):
    """Persons, stays and visits can be far larger than their files; here all are small enough for Spark to send."""
    tables = {k: stored(v, "small") for k, v in small.items()}
    plan = visits.visits_in_residence(**tables)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3
