import contextlib
import io
import math
import random

import pytest
from pyspark.sql import functions as F

from tractline.operators import tracts as T
from tractline.schemas import TRACTS, ContractError
from tractline.session import stored

POINT = "id bigint, latitude double, longitude double, year_for_fips int"


def edges(*rings):
    return [(a[0], a[1], b[0], b[1]) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]


def odd_crossings(ring, x, y):
    inside = False
    for x1, y1, x2, y2 in ring:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def brute(polygons, points):
    answers = {}
    for i, lat, lon, vintage in points:
        usable = lat is not None and lon is not None and -90 <= lat <= 90 and -180 <= lon <= 180
        hits = [t for t, _, v, ring in polygons if usable and v == vintage and odd_crossings(ring, lon, lat)]
        answers[i] = min(hits) if hits else None
    return answers


def star(rng, cx, cy, radius, corners):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [
        (cx + radius * rng.uniform(0.2, 1) * math.cos(t), cy + radius * rng.uniform(0.2, 1) * math.sin(t)) for t in turns
    ]


def found(df, index):
    rows = T.assign_tracts(df, index).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.tract_id for r in rows}


@pytest.mark.parametrize("level", [None, 0, 3, 6])
@pytest.mark.parametrize("broadcast_bytes", [0, T.BROADCAST_BYTES])
def test_overlapping_concave_polygons_with_holes(spark, level, broadcast_bytes):
    rng = random.Random(5)
    polygons = []
    for i in range(30):
        cx, cy, radius = rng.uniform(-3, 3), rng.uniform(-2, 2), rng.choice([0.05, 0.4, 2.0])
        rings = [star(rng, cx, cy, radius, rng.randrange(3, 40))]
        if i % 3 == 0:
            rings.append(star(rng, cx, cy, radius / 4, 5))
        polygons.append((f"{i:05d}", f"{i:05d}1", rng.choice([2010, 2020]), edges(*rings)))
    points = [(i, rng.uniform(-3, 3), rng.uniform(-4, 4), rng.choice([2010, 2020])) for i in range(1500)]
    corners = [(x, y, v) for _, _, v, ring in polygons for x, y, _, _ in ring]
    points += [(2000 + i, y, x, v) for i, (x, y, v) in enumerate(corners)]
    index = T.build_tract_index(spark.createDataFrame(polygons, TRACTS), level, broadcast_bytes)
    assert index.broadcastable == (broadcast_bytes > 0)
    assert found(spark.createDataFrame(points, POINT), index) == brute(polygons, points)


@pytest.mark.parametrize("broadcast_bytes", [0, T.BROADCAST_BYTES])
def test_tiling_gives_every_point_one_owner(spark, broadcast_bytes):
    polygons = []
    for i in range(4):
        for j in range(4):
            x, y = i * 0.3 - 0.6, j * 0.3 - 0.6
            ring = [(x, y), (x + 0.3, y), (x + 0.3, y + 0.3), (x, y + 0.3)]
            polygons.append((f"{i}{j}", f"{i}{j}1", 2010, edges(ring)))
    exact = sorted({x for _, _, _, ring in polygons for x, *_ in ring})
    grid = exact[:-1] + [-0.45, 0.0, 0.123]
    points = [(n, y, x, 2010) for n, (x, y) in enumerate((x, y) for x in grid for y in grid)]
    index = T.build_tract_index(spark.createDataFrame(polygons, TRACTS), None, broadcast_bytes)
    got = found(spark.createDataFrame(points, POINT), index)
    assert got == brute(polygons, points)
    inner = [i for i, y, x, _ in points if y not in exact and x not in exact]
    assert all(got[i] for i in inner)


@pytest.mark.parametrize("broadcast_bytes", [0, T.BROADCAST_BYTES])
def test_unusable_rows_and_copies_stay(spark, broadcast_bytes):
    square = edges([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])
    index = T.build_tract_index(
        spark.createDataFrame([("1001020100", "x", 2010, square)], TRACTS), None, broadcast_bytes
    )
    points = [(i, 0.5, 0.5, 2010) for i in range(500)]
    points += [(1000, None, 0.5, 2010), (1001, 91.0, 0.5, 2010), (1002, 0.5, 0.5, 2020), (1003, 5.0, 5.0, 2010)]
    points += [(1004, 0.5, 0.5, None), (1005, float("nan"), 0.5, 2010)]
    df = spark.createDataFrame(points, POINT)
    rows = T.with_fips(T.assign_tracts(df, index)).collect()
    assert len(rows) == len(points)
    assert {r.FIPS for r in rows if r.id < 500} == {"01001020100"}
    assert {r.FIPS for r in rows if r.id >= 1000} == {None}


def test_shuffled_form_looks_each_distinct_point_up_once(spark):
    square = edges([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])
    index = T.build_tract_index(spark.createDataFrame([("1", "x", 2010, square)], TRACTS), None, 0)
    df = spark.createDataFrame([(1, 0.5, 0.5, 2010)], POINT)
    plan = T.assign_tracts(df, index)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_v" in plan and "Join Cross" not in plan


def test_size_bound_covers_the_measured_size(spark):
    rng = random.Random(3)
    polygons = [
        (str(i), "x", 2010, edges(star(rng, rng.uniform(-9, 9), rng.uniform(-9, 9), rng.choice([0.1, 1, 6]), 30)))
        for i in range(20)
    ]
    df = spark.createDataFrame(polygons, TRACTS)
    for level in (0, 2, 5):
        cells = T.tract_cells(df, level).agg(F.count(F.lit(1)), F.sum(F.coalesce(F.size("ring"), F.lit(0)))).first()
        measured = cells[0] * T._BYTES_PER_CELL + (cells[1] or 0) * T._BYTES_PER_EDGE
        assert T.build_tract_index(df, level, measured - 1).broadcastable is False


def test_rings_become_edges(spark):
    df = spark.createDataFrame(
        [([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)], []],)], "rings array<array<struct<x double, y double>>>"
    )
    got = df.select(T.edges_of_rings(F.col("rings")).alias("e")).first().e
    assert [tuple(e) for e in got] == [(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 0)]


def test_missing_columns_and_no_tracts(spark):
    empty = spark.createDataFrame([], TRACTS)
    df = spark.createDataFrame([(1, 0.5, 0.5, 2010)], POINT)
    assert found(df, T.build_tract_index(empty)) == {1: None}
    with pytest.raises(ContractError):
        T.build_tract_index(empty.drop("ring"))


def square(x, y, width):
    return edges([(x, y), (x + width, y), (x + width, y + width), (x, y + width)])


def tiny_and_huge():
    tiny = [(f"t{i:03d}", "x", 2010, square(-80 + (i % 20) * 0.01, 25 + i // 20 * 0.01, 0.01)) for i in range(400)]
    huge = [(f"h{i:02d}", "x", 2010, square(-120 + (i % 5) * 5.0, 30 + i // 5 * 5.0, 5.0)) for i in range(20)]
    return tiny, huge


@pytest.mark.parametrize("broadcast_bytes", [0, T.BROADCAST_BYTES])
def test_every_polygon_is_cut_at_its_own_level(spark, broadcast_bytes):
    tiny, huge = tiny_and_huge()
    frame = lambda rows: spark.createDataFrame(rows, TRACTS)
    index = T.build_tract_index(frame(tiny + huge), None, broadcast_bytes)
    assert len(index.levels) == 2
    total = lambda df: T._levelled(df.select("ring"), None).agg(F.sum(T._size_bound())).first()[0]
    assert total(frame(tiny + huge)) <= 2 * (total(frame(tiny)) + total(frame(huge)))
    rng = random.Random(8)
    points = [(i, rng.uniform(24.9, 25.3), rng.uniform(-80.1, -79.7), 2010) for i in range(400)]
    points += [(500 + i, rng.uniform(29, 51), rng.uniform(-121, -94), 2010) for i in range(400)]
    assert found(spark.createDataFrame(points, POINT), index) == brute(tiny + huge, points)
    codes = T.assign_codes(spark.createDataFrame(points, POINT), index).collect()
    want = brute(tiny + huge, points)
    assert all((r.FIPS_2010 is not None) == (want[r.id] is not None) and r.FIPS_2020 is None for r in codes)


def test_overlapping_levels_give_the_smaller_code(spark):
    polygons = [("5", "x", 2010, square(0.0, 0.0, 8.0)), ("7", "x", 2010, square(1.0, 1.0, 0.01)), ("3", "x", 2010, square(2.0, 2.0, 0.01))]
    points = [(1, 1.005, 1.005, 2010), (2, 2.005, 2.005, 2010), (3, 4.0, 4.0, 2010)]
    for limit in (0, T.BROADCAST_BYTES):
        index = T.build_tract_index(spark.createDataFrame(polygons, TRACTS), None, limit)
        assert found(spark.createDataFrame(points, POINT), index) == {1: "5", 2: "3", 3: "5"}


def test_parts_on_both_sides_of_the_180th_meridian(spark):
    ring = square(178.0, 50.0, 1.5) + square(-179.5, 50.0, 1.0)
    index = T.build_tract_index(spark.createDataFrame([("9", "x", 2010, ring)], TRACTS))
    points = [(1, 50.5, 179.0, 2010), (2, 50.5, -179.0, 2010), (3, 50.5, 0.0, 2010)]
    assert found(spark.createDataFrame(points, POINT), index) == {1: "9", 2: "9", 3: None}
    assert index.cells.count() < 2000


def test_a_saved_index_is_read_where_the_points_are(spark, tmp_path):
    """Sixteen states of small tracts; the points lie in one."""
    polygons = [
        (f"{state:02d}{i:03d}", "x", 2010, square(-120 + state % 4 * 10 + i % 5 * 0.02, 25 + state // 4 * 5 + i // 5 * 0.02, 0.02))
        for state in range(16)
        for i in range(25)
    ]
    folder = str(tmp_path / "index")
    index = T.build_tract_index(spark.createDataFrame(polygons, TRACTS)).save(folder, files=16)
    points = [(i, 30.0 + i * 0.0005, -110.0 + i * 0.0005, 2010) for i in range(190)] + [(999, None, None, 2010)]
    df = spark.createDataFrame(points, POINT)
    near = T.TractIndex.load(spark, folder, T.points_box(df))
    assert len(index.cells.inputFiles()) == 16 and 0 < len(near.cells.inputFiles()) <= 3
    with contextlib.redirect_stdout(io.StringIO()) as text:
        near.cells.explain("formatted")
    scan = text.getvalue()
    assert "PushedFilters" in scan and "GreaterThanOrEqual(east" in scan
    assert near.cells.count() < index.cells.count() / 8
    assert found(df, near) == found(df, index) == brute(polygons, points)
    nowhere = T.TractIndex.load(spark, folder, T.points_box(df.where("latitude is null")))
    assert nowhere.cells.count() == 0 and set(found(df, nowhere).values()) == {None}


def test_morton_codes_interleave_bits(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 3), (2**26 - 1, 0), (12345678, 7654321)]
    df = spark.createDataFrame(pairs, "x bigint, y bigint").select("x", "y", T._interleaved(F.col("x"), F.col("y")).alias("m"))
    for r in df.collect():
        assert r.m == sum((r.x >> i & 1) << 2 * i | (r.y >> i & 1) << 2 * i + 1 for i in range(26))


def cell_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Join" in line and "_cx" in line]


def test_cells_over_the_limit_are_not_sent_around_with_codes(spark):
    """Spark sees the size of the polygons' files, of which cells are many times the rows."""
    polygons = spark.createDataFrame([("1001020100", "x", v, edges([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])) for v in (2010, 2020)], TRACTS)
    index = T.build_tract_index(stored(polygons, "polygons"), broadcast_bytes=0)
    (join,) = cell_joins(T.assign_codes(spark.createDataFrame([(1, 0.2, 0.5, 2010)], POINT), index))
    assert "SortMergeJoin" in join


def test_cells_over_the_limit_are_not_sent_around(spark):
    polygons = spark.createDataFrame([("1001020100", "x", 2010, edges([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]))], TRACTS)
    index = T.build_tract_index(stored(polygons, "polygons"), broadcast_bytes=0)
    df = T.assign_tracts(spark.createDataFrame([(1, 0.2, 0.5, 2010)], POINT), index)
    (join,) = cell_joins(df)
    assert "SortMergeJoin" in join and df.first().tract_id == "1001020100"
