import random
import re

import pytest
from pyspark.sql import functions as F

from tractline.operators import geocode as module
from tractline.operators import near_streets
from tractline.operators.geocode import _point_keys, gazetteer, geocode, places_at_end, query_keys
from tractline.plans import linkage
from tractline.schemas import ADDRESS_POINTS, LOCATION_COLUMNS, TRACTS
from tractline.session import stored

POINTS = [
    (1, "1250 W 16th St", "Jacksonville", "FL", "32209", 30.35, -81.67),
    (2, "1250 W 18th St", "Jacksonville", "FL", "32209", 30.36, -81.68),
    (3, "7000 University Blvd", "Winter Park", "FL", "32792", 28.6, -81.3),
    (4, "1250 W 16th St", "Jacksonville", "FL", "32209", 0.0, 0.0),
    (5, "240 NW 25th St", "Miami", "FL", "33127", 25.8, -80.2),
    (6, "99 Null Island", "Nowhere", "FL", "32209", None, -81.0),
]
ASKED = "id int, street string, city string, state string, zip string"


@pytest.fixture
def points(spark):
    return spark.createDataFrame(POINTS, ADDRESS_POINTS)


def matched(df):
    return {r.id: (r.latitude, r.matched_street, r.precision if r.score is not None else None) for r in df.collect()}


def test_region_number_and_score_decide(spark, points):
    rows = [
        (1, "1250 W 16th St", "Jacksonville", "FL", "32209.0"),
        (2, "1250 w. 16TH street", "", None, "32209"),
        (3, "1251 W 16th St", "Jacksonville", "FL", "32209"),
        (4, "7000 Universty Blvd", "winter park", "fl", None),
        (5, "7000 University Blvd", "Winter Park", "FL", "99999"),
        (6, "1250 Elm Avenue", "Jacksonville", "FL", "32209"),
        (7, None, "Jacksonville", "FL", "32209"),
        (8, None, None, None, None),
        (9, "99 Null Island", "Nowhere", "FL", "32209"),
        (10, "7000 University Blvd", "Winter Park", "FL", "n/a"),
        (11, "7000 Umiversity Blvd", "Winter Park", "FL", "32792"),
        (12, "1250 W 17th St", "Jacksonville", "FL", "32209"),
    ]
    got = matched(geocode(spark.createDataFrame(rows, ASKED), points))
    assert got[1] == (30.35, "1250 W 16th St", "exact")
    assert got[2] == (30.35, "1250 W 16th St", "close")
    assert got[4] == (28.6, "7000 University Blvd", "close")
    assert got[10] == (28.6, "7000 University Blvd", "exact")
    assert got[11] == (28.6, "7000 University Blvd", "close")
    # One digit off scores high, but another numbered street is no misspelling.
    assert all(got[i] == (None, None, None) for i in (3, 5, 6, 7, 8, 9, 12))


def test_single_column(spark, points):
    rows = [
        (1, "1250 W 16th St Jacksonville FL 32209"),
        (2, "7000 University Blvd, Winter Park, FL"),
        (3, "7000 University Blvd Winter Prk FL 32792-1234"),
        (4, "Jacksonville FL 32209"),
        (5, None),
    ]
    got = matched(geocode(spark.createDataFrame(rows, "id int, address string"), points, ("address",)))
    assert got[1] == (30.35, "1250 W 16th St", "exact")
    assert got[2] == (28.6, "7000 University Blvd", "exact")
    assert got[3] == (28.6, "7000 University Blvd", "close")
    assert got[4] == got[5] == (None, None, None)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def test_against_brute_force_with_one_dominant_block(spark):
    rng = random.Random(11)
    words = ["oak", "elm", "maple", "market", "main", "river", "hill", "lake"]

    def street():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 3)))

    def block():
        return ("100", "11111") if rng.random() < 0.4 else (str(rng.randrange(100, 103)), rng.choice(["11111", "22222"]))

    base = []
    for i in range(150):
        number, code = block()
        base.append((i, f"{number} {street()}", "Town", "FL", code, float(i % 90), -80.0))
    asked = []
    for i in range(300):
        number, code = block()
        text = list(f"{number} {street()}")
        if rng.random() < 0.5:
            text[rng.randrange(4, len(text))] = rng.choice("abc")
        asked.append((i, "".join(text), "Town", "FL", code))

    def best(row):
        _, a, _, _, code = row
        scored = [
            (1 - distance(a, p[1]) / max(len(a), len(p[1])), -p[0])
            for p in base
            if p[4] == code and re.findall(r"\d+", a) == re.findall(r"\d+", p[1])
        ]
        scored = [s for s in scored if s[0] >= 0.7]
        return max(scored) if scored else None

    got = geocode(spark.createDataFrame(asked, ASKED), spark.createDataFrame(base, ADDRESS_POINTS)).collect()
    lat = {p[0]: p[5] for p in base}
    assert len(got) == len(asked)
    hits = 0
    for r in got:
        want = best(next(a for a in asked if a[0] == r.id))
        assert (r.latitude, r.score) == ((lat[-want[1]], pytest.approx(want[0])) if want else (None, None))
        hits += want is not None
    assert hits > 100


@pytest.mark.parametrize(
    ("street", "city", "state", "code", "found"),
    [
        ("200 Oal Ave", "Miami", "FL", "33101", 1),
        ("400 Lale Rd", "Miami", "FL", "33101", 2),
        ("100 Eln St", "Miami", "FL", "33101", 3),
        ("1 Main St", "Boston", "MA", "2139", 4),
        ("1 Main St", "Boston", "MA", "2139.0", 4),
        ("1 Main St", "Boston", "MA", "02139-1234", 4),
        ("100 Elm St Apt 204", "Miami", "FL", "33101", 3),
        ("100 Elm St, Unit B", "Miami", "FL", "33101", 3),
        ("100 Elm St #1A", "Miami", "FL", "33101", 3),
        ("9 Broad St", "New York", "New York", None, 5),
        ("9 Broad St", "Albany", "New York", None, None),
        ("100 Magnolia Ave", "Miami", "FL", "33101", None),
    ],
)
def test_only_the_threshold_decides(spark, street, city, state, code, found):
    base = [
        (1, "200 Oak Ave", "Miami", "FL", "33101", 1.0, 0.0),
        (2, "400 Lake Rd", "Miami", "FL", "33101", 2.0, 0.0),
        (3, "100 Elm St Suite 7", "Miami", "FL", "33101", 3.0, 0.0),
        (4, "1 Main St", "Boston", "MA", "02139", 4.0, 0.0),
        (5, "9 Broad St", "New York", "New York", "10004", 5.0, 0.0),
    ]
    points = spark.createDataFrame(base, ADDRESS_POINTS)
    row = spark.createDataFrame([(0, street, city, state, code)], ASKED)
    assert geocode(row, points).first().latitude == found
    if city != "Albany":
        whole = " ".join(p for p in (street, city, state, code and code.removesuffix(".0")) if p)
        single = spark.createDataFrame([(0, whole)], "id int, address string")
        assert geocode(single, points, ("address",)).first().latitude == found


def test_every_pair_is_scored_once(spark, points):
    rows = spark.createDataFrame([(f"1250 W 16th {w}", "Jacksonville", "FL", "32209") for w in ("St", "Ave", "Rd")], "_k0 string, _k1 string, _k2 string, _k3 string")
    pairs = query_keys(rows, 4).join(_point_keys(points, 4), ["_region", "_numbers"])
    assert pairs.count() == pairs.select("_k0", "_p_street").distinct().count() == 3


def test_both_routes_leave_the_unit_out(spark, points):
    schema = ", ".join(f"{c} {'bigint' if c == 'location_id' else 'string'}" for c in LOCATION_COLUMNS)
    row = (1, "240 NW 25th St", "Apt 204", "Miami", "FL", "33127", None, None, None, None, None, None)
    location = spark.createDataFrame([row], schema)
    square = [(-82.0, 25.0, -80.0, 25.0), (-80.0, 25.0, -80.0, 31.0), (-80.0, 31.0, -82.0, 31.0), (-82.0, 31.0, -82.0, 25.0)]
    tracts = spark.createDataFrame([("1001020100", "x", 2010, square)], TRACTS)
    assert linkage.refresh_location(location, points).first().latitude == 25.8
    assert linkage.link_locations(location, points, tracts).first().latitude == 25.8


def test_copies_are_looked_up_once(spark, points):
    rows = spark.range(3000).select(
        F.col("id").cast("int"), F.when(F.col("id") >= 0, "1250 W 16th St").alias("street"), F.lit("Jacksonville").alias("city"),
        F.lit("FL").alias("state"), F.when(F.col("id") % 3 == 0, "32209").otherwise(None).alias("zip"),
    )
    df = geocode(rows, points)
    assert df.where("latitude = 30.35").count() == 3000
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_k0" in plan and "Join Cross" not in plan


def test_rows_not_needed_are_left_alone(spark, points):
    rows = [(i, "1250 W 16th St", "Jacksonville", "FL", "32209") for i in range(4)]
    got = matched(geocode(spark.createDataFrame(rows, ASKED), points, needed=F.col("id") >= 2))
    assert [got[i][0] for i in range(4)] == [None, None, 30.35, 30.35]


def test_link_addresses_and_hospital(spark, points):
    square = [(-82.0, 25.0, -80.0, 25.0), (-80.0, 25.0, -80.0, 31.0), (-80.0, 31.0, -82.0, 31.0), (-82.0, 31.0, -82.0, 25.0)]
    tracts = spark.createDataFrame([("1001020100", "x", 2010, square), ("12031000101", "y", 2020, square)], TRACTS)
    rows = [
        ("a", "1250 W 16th St", "Jacksonville", "FL", "32209", "2012"),
        ("b", "240 NW 25th St", "Miami", "FL", "33127.0", "2021.0"),
        ("c", "1 Nowhere Rd", "Miami", "FL", None, None),
    ]
    df = spark.createDataFrame(rows, "entity_id string, street string, city string, state string, zip string, year string")
    got = linkage.link_addresses(df, points, tracts)
    assert got.columns == ["entity_id", "year", "latitude", "longitude", "geocode_result", "reason", "FIPS"]
    assert {tuple(r)[:2] + tuple(r)[4:] for r in got.collect()} == {
        ("a", 2012, "Geocoded", "", "01001020100"),
        ("b", 2021, "Geocoded", "Hospital address given", "12031000101"),
        ("c", None, "Imprecise Geocode", "Zip missing", None),
    }
    kept = linkage.link_addresses(df, points, tracts, drop_address_parts=False)
    assert set(df.columns) < set(kept.columns)
    single = df.select("entity_id", "year", F.concat_ws(" ", "street", "city", "state", F.substring("zip", 1, 5)).alias("address"))
    got = {r.entity_id: (r.geocode_result, r.reason) for r in linkage.link_addresses(single, points, tracts).collect()}
    assert got == {
        "a": ("Geocoded", ""),
        "b": ("Geocoded", "Hospital address given"),
        "c": ("Imprecise Geocode", "Blank/Incomplete address"),
    }


def test_refresh_location_fills_only_what_is_missing(spark, points):
    schema = ", ".join(f"{c} {'bigint' if c == 'location_id' else 'string'}" for c in LOCATION_COLUMNS)
    rows = [
        (1, "1250 W 16th St", "#1", "Jacksonville", "FL", "32209", None, None, None, None, "1.5", "2.5"),
        (2, "1250 W 16th St ", None, "Jacksonville", "FL", "32209", None, None, None, None, None, "2.5"),
        (3, "7000 University Blvd", "#A", "Winter Park", "FL", "32792.0", None, None, None, None, "abc", ""),
        (4, None, None, None, None, None, None, None, None, None, None, None),
    ]
    got = linkage.refresh_location(spark.createDataFrame(rows, schema), points)
    assert got.columns == list(LOCATION_COLUMNS)
    assert {r.location_id: (r.latitude, r.longitude) for r in got.collect()} == {
        1: (1.5, 2.5), 2: (30.35, -81.67), 3: (28.6, -81.3), 4: (None, None),
    }


CITIES = [
    (1, "100 Oak St", "Tarpon Springs", "FL", None, 1.0, 0.0),
    (2, "100 Oak St", "Coral Springs", "FL", "33065", 2.0, 0.0),
    (3, "100 Oak St", "Springs", "FL", None, 3.0, 0.0),
    (4, "7 Palm Way", "West Palm Beach", "FL", None, 4.0, 0.0),
    (5, "7 Palm Way", "Palm Beach", "FL", None, 5.0, 0.0),
    (6, "9 Elm St", "Village of the Branch on Sea", "New York", None, 6.0, 0.0),
    (7, "100 Oak St", None, "FL", "33065", 7.0, 0.0),
]


@pytest.mark.parametrize(
    ("street", "city", "state", "found"),
    [
        ("100 Oak St", "Coral Springs", "FL", 2),
        ("100 Oka St", "coral  springs", "fl.", 2),
        ("100 Oak St", "Tarpon Springs", "FL", 1),
        ("100 Oak St", "Springs", "FL", 3),
        ("100 Oak St", "Silver Springs", "FL", None),
        ("100 Oak St", "Coral Springs", "GA", None),
        ("7 Palm Way", "Palm Beach", "FL", 5),
        ("7 Palm Way", "West Palm Beach", "FL", 4),
        ("9 Elm St", "Village of the Branch on Sea", "New York", 6),
        ("9 Elm St", "Branch on Sea", "New York", None),
        ("100 Oak St", None, None, None),
    ],
)
def test_the_whole_city_decides_without_a_zip(spark, street, city, state, found):
    points = spark.createDataFrame(CITIES, ADDRESS_POINTS)
    row = spark.createDataFrame([(0, street, city, state, None)], ASKED)
    assert geocode(row, points).first().latitude == found
    single = spark.createDataFrame([(0, " ".join(p for p in (street, city, state) if p))], "id int, address string")
    # In one column "Silver Springs FL" ends with the known place "Springs FL"; "Silver" is then part of the street.
    got = geocode(single, points, ("address",)).first().latitude
    assert got == found


def test_places_are_the_longest_known_ones(spark):
    points = spark.createDataFrame(CITIES, ADDRESS_POINTS)
    places = gazetteer(points)
    assert places.count() == 6
    texts = ["100 oak st coral springs fl", "coral springs fl", "1 x springs fl", "7 west palm beach fl", "9 elm st nowhere ny", "", "fl"]
    texts += ["9 elm st village of the branch on sea new york"]
    got = {r._text: r._place for r in places_at_end(spark.createDataFrame([(t,) for t in texts], "_text string"), places).collect()}
    assert got == {
        "100 oak st coral springs fl": "coral springs fl",
        "coral springs fl": "springs fl",
        "1 x springs fl": "springs fl",
        "7 west palm beach fl": "west palm beach fl",
        texts[-1]: "village of the branch on sea new york",
    }
    assert places_at_end(spark.createDataFrame([("x y z",)], "_text string"), gazetteer(points.limit(0))).collect() == []


def near(a, b, threshold):
    longest = max(len(a), len(b))
    edits = distance(a, b)
    return 1 - edits / longest if edits <= int(longest * (1 - threshold) + 1e-9) else None


@pytest.mark.parametrize("threshold", [0.7, 0.5, 0.85])
def test_segments_lose_no_pair(spark, threshold):
    """Short, long and repetitive texts; each pair within the budget must be met, and once."""
    rng = random.Random(int(threshold * 100))
    def text():
        return "7" + rng.choice(["", " "]) + "".join(rng.choices("ab c", weights=[4, 3, 2, 1], k=rng.choice([0, 1, 3, 7, 12, 22])))
    texts = sorted({text() for _ in range(60)})
    asked = [(t, "z:1", "7", "", t, t) for t in texts]
    held = [("z:1", "7", t, "", t) for t in texts]
    asked = spark.createDataFrame(asked, "_k0 string, _region string, _numbers string, _text string, _street string, _asked string")
    held = spark.createDataFrame(held, "_region string, _numbers string, _p_street string, _p_tail string, _whole string")
    for edits in (None, *near_streets.FEW_EDITS):
        rows = near_streets.pairs_within(asked, held, threshold, edits).select("_k0", "_p_street").collect()
        found = {tuple(r) for r in rows}
        assert len(rows) == len(found)
        for a in texts:
            for b in texts:
                d = distance(a, b)
                if d <= (int(max(len(a), len(b)) * (1 - threshold) + 1e-9) if edits is None else edits):
                    assert (a, b) in found, (a, b, edits)


@pytest.mark.parametrize("columns", [4, 1])
def test_a_crowded_block_against_all_pairs(spark, columns, monkeypatch):
    monkeypatch.setattr(module, "CROWDED", 20)
    rng = random.Random(4)
    parts = ["ma", "no", "li", "sha", "ker", "ton", "vi", "del"]
    kinds = ["St", "Ave", "Rd", "Way"]
    streets = sorted({f"100 {''.join(rng.choices(parts, k=rng.randint(1, 4)))} {rng.choice(kinds)}" for _ in range(250)})
    base = [(i, s, "Big Town", "FL", "11111" if i % 3 else None, float(i), 0.0) for i, s in enumerate(streets)]
    base += [(1000 + i, f"{200 + i} Quiet St", "Big Town", "FL", "11111", 500.0 + i, 0.0) for i in range(10)]
    asked = []
    for i in range(160):
        letters = list(rng.choice(streets))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            at = rng.randrange(4, len(letters))
            letters[at : at + rng.choice([0, 1])] = rng.choice(["q", "a", ""])
        asked.append((i, "".join(letters), "Big Town", "FL", rng.choice(["11111", None])))
    asked += [(900, "205 Quiet St", "Big Town", "FL", "11111"), (901, "100 zzzz", "Big Town", "FL", "11111")]

    def forms(row):
        return " ".join(re.sub("[^a-z0-9]+", " ", row.lower()).split())

    def best(row):
        _, street, city, state, code = row
        scored = []
        for p in base:
            a, b = forms(street), forms(p[1])
            if (p[4] == code if code else True) and re.findall(r"\d+", a) == re.findall(r"\d+", b):
                score = near(a, b, 0.7)
                if score is not None:
                    scored.append((score, -p[0]))
        return max(scored) if scored else None

    points = spark.createDataFrame(base, ADDRESS_POINTS)
    if columns == 4:
        got = geocode(spark.createDataFrame(asked, ASKED), points)
    else:
        rows = [(r[0], " ".join(p for p in r[1:] if p)) for r in asked]
        got = geocode(spark.createDataFrame(rows, "id int, address string"), points, ("address",))
    lat = {p[0]: p[5] for p in base}
    want = {r[0]: best(r) for r in asked}
    for r in got.collect():
        w = want[r.id]
        assert (r.latitude, r.score) == ((lat[-w[1]], pytest.approx(w[0])) if w else (None, None)), r
    assert sum(w is not None and w[0] < 1 for w in want.values()) > 50


def test_scored_pairs_stay_near_the_matches(spark, monkeypatch):
    """A block of 10,000 streets: of 10 million pairs, only a few for each address are ever scored."""
    rng = random.Random(9)
    parts = ["ma", "no", "li", "sha", "ker", "ton", "vi", "del", "bru", "wick", "eas", "pol"]
    streets = set()
    while len(streets) < 10_000:
        streets.add(f"100 {''.join(rng.choices(parts, k=4))} {rng.choice(['st', 'ave', 'rd'])}")
    streets = sorted(streets)
    base = [(i, s, "Town", "FL", "11111", float(i), 0.0) for i, s in enumerate(streets)]
    asked = []
    for i in range(1000):
        letters = list(rng.choice(streets))
        if i % 2:
            letters[rng.randrange(4, len(letters) - 4)] = "q"
        asked.append((i, "".join(letters), "Town", "FL", "11111"))
    counts = []
    scored = module.score_pairs

    def counting(pairs, threshold):
        counts.append(pairs.count())
        return scored(pairs, threshold)

    monkeypatch.setattr(module, "score_pairs", counting)
    got = geocode(spark.createDataFrame(asked, ASKED), spark.createDataFrame(base, ADDRESS_POINTS))
    found = {r.id: r.score for r in got.collect()}
    assert all(found[i] == 1.0 for i in range(0, 1000, 2)) and all(found[i] is not None for i in range(1000))
    assert sum(counts) < 100 * len(asked), counts


def test_blocks_and_segments_are_not_sent_around_by_a_guess(spark, points):
    rows = spark.createDataFrame([(1, "240 NW 25th St", "Miami", "FL", "33127")], "id int, street string, city string, state string, zip string")
    plan = geocode(stored(rows, "rows"), stored(points, "points"))._jdf.queryExecution().executedPlan().toString()
    blocks = [line for line in plan.splitlines() if "Join" in line and "_numbers" in line]
    assert blocks and all("SortMergeJoin" in line for line in blocks)
    near = "_k0 string, _region string, _numbers string, _asked string"
    asked = stored(spark.createDataFrame([("240 NW 25TH ST", "z:33127", "240 25", "240 nw 25th st")], near), "asked")
    known = spark.createDataFrame([("z:33127", "240 25", "240 nw 25th st", "", "240 nw 25th st")], "_region string, _numbers string, _p_street string, _p_tail string, _whole string")
    pairs = near_streets.pairs_within(asked, stored(known, "known"), 0.7)
    assert pairs.count() == 1 and "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
