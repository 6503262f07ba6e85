"""A worked example with known results: fourteen persons, twenty places, two address tables."""

import pytest
from pyspark.sql import functions as F

from tractline.functions import status, values
from tractline.operators import hospitals, locations, visits
from tractline.plans import linkage
from tractline.schemas import ADDRESS_PARTS, ADDRESS_POINTS, LOCATION_COLUMNS, TRACTS

# Place and person of each residence (1998 to 2020), and the start days of each person's visits.
RESIDENTS = (
    (1, 3763), (2, 5587), (3, 1011), (4, 5950), (5, 8780), (6, 7595), (7, 9103), (8, 789), (9, 9664), (10, 8237),
    (11, 696), (12, 3153), (13, 5413), (14, 5792), (15, 5744), (16, 8751), (17, 832), (18, 9531), (19, 3938), (20, 7309),
)
VISITS = {
    696: ("12/16/2013", "12/16/2013", "12/16/2013"), 1011: ("07/11/2001", "06/28/2014", "06/28/2014"),
    3763: ("04/23/2004", "08/27/2004", "04/15/2005"), 3938: ("04/02/2007", "01/06/2014", "01/07/2014"),
    5413: ("01/06/1992", "08/10/1992", "10/08/1992"), 5744: ("11/03/2008", "06/18/2009", "06/18/2009"),
    5792: ("08/07/2012", "09/18/2014", "09/18/2014"), 7309: ("04/13/2013", "04/13/2013", "04/13/2013"),
    7595: ("04/11/2014", "04/27/2014", "05/03/2016"), 8237: ("06/22/2009", "08/07/2009", "02/12/2010"),
    8751: ("02/08/2010", "02/08/2010", "02/08/2010"), 8780: ("12/06/2005", "12/06/2005", "12/20/2005"),
    9103: ("05/15/2003", "05/15/2003", "05/15/2003"), 9664: ("10/19/2002", "10/20/2002", "10/20/2002"),
}
# Street, city, state, ZIP as a reader of numbers leaves it, year.
ADDRESSES = (
    ("1000 Peachtree Park Dr NE", "Atlanta", "GA", "30309.0", "2019"),
    ("240 NW 25th St", "Miami", "FL", "33127.0", "2019"),
    ("1400 Briarcliff Rd NE", "Atlanta", "GA", "30306.0", "2020"),
    ("1510 6th Ave", "Columbus", "GA", "31901.0", "2019"),
    (None, None, "FL", "33414.0", "2021"),
    (None, None, None, None, "2021"),
    ("3415 sw 39th blvd", None, "FL", "32608.0", None),
)


@pytest.fixture(scope="module")
def tables(spark):
    person = spark.createDataFrame([(p,) for p in VISITS], "person_id bigint")
    rows = [(100 * p + i, p, d, "04/24/2013" if (p, i) == (7309, 0) else d) for p, days in VISITS.items() for i, d in enumerate(days)]
    visit = spark.createDataFrame(rows, "visit_occurrence_id bigint, person_id bigint, a string, b string").select(
        "visit_occurrence_id", "person_id", values.parse_date(F.col("a")).alias("visit_start_date"), values.parse_date(F.col("b")).alias("visit_end_date")
    )
    schema = ", ".join(f"{c} {'bigint' if c == 'location_id' else 'string'}" for c in LOCATION_COLUMNS)
    places = [(i, f"{i} Any St", "#1A" if i == 20 else None, "TOWN", "CA", "93703", None, None, None, "USA", f"36.{700 + i}", f"-119.{700 + i}") for i, _ in RESIDENTS]
    history = spark.createDataFrame(
        [(i, 32848, 1147314, p, "1998-01-01", "2020-01-01") for i, p in RESIDENTS],
        "location_id bigint, relationship_type_concept_id bigint, domain_id bigint, entity_id bigint, start_date string, end_date string",
    )
    history = history.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})
    return person, visit, spark.createDataFrame(places, schema), history


def test_visits_in_residences(tables):
    assert sum(map(len, VISITS.values())) == 42
    assert visits.visits_in_residence(*tables, cutoff=None).count() == 39
    rows = visits.visits_in_residence(*tables).collect()
    assert len(rows) == 16
    years = [r.year for r in rows]
    assert {y: years.count(y) for y in years} == {2012: 1, 2013: 6, 2014: 8, 2016: 1}
    assert {(r.person_id, r.location_id) for r in rows} == {(696, 11), (1011, 3), (3938, 19), (5792, 14), (7309, 20), (7595, 6)}


def test_category_vintage_and_rebuilt_places(tables):
    rows = visits.classify(visits.visits_in_residence(*tables)).withColumn("v", values.vintage_of(F.col("year")))
    assert {(r.category, r.v) for r in rows.collect()} == {("Latlong", 2010)}
    assert [r.location_id for r in locations.build_location(rows).collect()] == [3, 6, 11, 14, 19, 20]


@pytest.mark.parametrize(
    ("years", "older", "newer"),
    [
        ([*["2012"] * 2, "2010", "2013", *["2015"] * 2, *["2016"] * 2, *["2017"] * 3, *["2018"] * 3, *["2019"] * 3,
          *["2020"] * 4, *["2021"] * 7, *["2022"] * 2, *["2023"] * 2, ""], 17, 16),
        (["2019"] * 20, 20, 0),
        (["2012"] * 71 + ["2023"] * 29, 71, 29),
    ],
)
def test_vintages(column, years, older, newer):
    got = column(years, values.vintage_of(values.year_of(F.col("a"))))
    assert (got.count(2010), got.count(2020)) == (older, newer)


def test_hospitals_and_reasons(spark):
    schema = ", ".join(f"{c} string" for c in (*ADDRESS_PARTS, "year"))
    rows = spark.createDataFrame(ADDRESSES, schema)
    form = status.hospital_form_multi(*[F.col(c) for c in ADDRESS_PARTS])
    flagged = hospitals.flag_hospitals(rows, form)
    assert [r.at_hospital for r in flagged.collect()] == [True, True, True, False, False, False, False]

    points = spark.createDataFrame([(i, *a[:3], a[3] and a[3][:5], 30.0 + i, -81.0) for i, a in enumerate(ADDRESSES[:4])], ADDRESS_POINTS)
    ring = [(-90.0, 20.0, -70.0, 20.0), (-70.0, 20.0, -70.0, 40.0), (-70.0, 40.0, -90.0, 40.0), (-90.0, 40.0, -90.0, 20.0)]
    tracts = spark.createDataFrame([("12031000101", "x", v, ring) for v in (2010, 2020)], TRACTS)
    linked = linkage.link_addresses(rows, points, tracts, drop_address_parts=False)
    reasons = {(r.street, r.state): r.reason for r in linked.collect()}
    assert [reasons[a[0], a[2]] for a in ADDRESSES] == [
        *["Hospital address given"] * 3, "", "Street missing", "Blank/Incomplete address", "",
    ]
    single = spark.createDataFrame([("1 Nowhere Rd Town FL 99999",), (None,)], "address string")
    assert {r.reason for r in linkage.link_addresses(single, points, tracts).collect()} == {"Blank/Incomplete address"}
