"""Points to census tracts: grid cells narrow the candidates, an exact ring test decides.

The boundary rule is ours: a polygon owns its left and lower edges (even-odd rule, half-open), so
tracts that tile an area give every point exactly one owner. Holes and separate parts are further
edges of the same ring column. Where tracts overlap the smallest tract code wins.

Every polygon is cut at a level of its own, so that tiny and huge ones in one table each make few cells; a
point looks once into each level that occurs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.functions.values import format_fips, in_range, number_in
from tractline.schemas import TRACTS, VINTAGES, require
from tractline.session import computed_once, no_spread, shuffled, spread_unless

CODES = tuple(f"FIPS_{vintage}" for vintage in VINTAGES)

# A cell is 2**-level degrees wide. A power of two makes "which cell" and "where does the cell
# start" exact in floating point, so no point near a cell border can look in the wrong cell.
LEVELS = range(0, 13)
# Polygons choose among every other level, so that points have at most seven to look into.
LEVEL_STEP = 2
MAX_CELLS_ACROSS = 16
# Limit on the bound of the cell table's size, below which it is sent to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024
_BYTES_PER_CELL, _BYTES_PER_EDGE = 160, 48


def edges_of_rings(rings: Column) -> Column:
    """``ARRAY<ARRAY<STRUCT<x,y>>>`` of closed rings to the flat edge array the ring test uses."""

    def edges(ring: Column) -> Column:
        return F.zip_with(
            F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))),
            F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
            lambda a, b: F.struct(
                a["x"].cast("double").alias("x1"),
                a["y"].cast("double").alias("y1"),
                b["x"].cast("double").alias("x2"),
                b["y"].cast("double").alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, edges))


def inside_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test: an odd number of edges is crossed by the ray from (x, y) towards +x.

    ``nullif`` keeps horizontal edges from dividing by zero; they never straddle ``y`` anyway.
    """

    def crosses(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return F.when(((e["y1"] > y) != (e["y2"] > y)) & (x < at), 1).otherwise(0)

    return F.aggregate(ring, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1


def _bounds(ring: Column) -> Column:
    low = lambda a, b: F.least(F.array_min(ring[a]), F.array_min(ring[b]))
    high = lambda a, b: F.greatest(F.array_max(ring[a]), F.array_max(ring[b]))
    return F.struct(
        low("x1", "x2").alias("x0"),
        high("x1", "x2").alias("x1"),
        low("y1", "y2").alias("y0"),
        high("y1", "y2").alias("y1"),
    )


def _parts(tracts: DataFrame) -> DataFrame:
    """Polygons with their box ``_b``; those with parts on both sides of the 180th meridian as a row per side.

    Their common box would be as wide as the earth, so it does not hold for them (``_wide``). No edge may
    cross from one side to the other.
    """
    boxed = computed_once(tracts, {"_b": _bounds(F.col("ring"))})
    west = F.filter("ring", lambda e: F.greatest(e["x1"], e["x2"]) <= 0)
    east = F.filter("ring", lambda e: F.least(e["x1"], e["x2"]) > 0)
    wide = F.col("_b.x1") - F.col("_b.x0") > 180
    halves = F.when(wide, F.array(west, east))
    split = F.size(halves[0]) + F.size(halves[1]) == F.size("ring")
    rings = F.when(wide & split, halves).otherwise(F.array("ring"))
    return boxed.select(*[c for c in tracts.columns if c != "ring"], "_b", wide.alias("_wide"), F.explode(rings).alias("ring"))


def _size(level: Column) -> Column:
    """Cells per degree at a level, an exact power of two."""
    return F.call_function("shiftleft", F.lit(1), level).cast("double")


def _cell(coordinate: Column, level: Column) -> Column:
    return F.floor(coordinate * _size(level)).cast("int")


def _own_level(ring: Column, box: Column, step: int = LEVEL_STEP) -> Column:
    """The level of a polygon: about as many cells across as the root of its edges.

    So simple shapes make few cells and detailed ones leave few edges in each.
    """
    extent = F.sqrt((box["x1"] - box["x0"]) * (box["y1"] - box["y0"]))
    across = F.least(F.lit(float(MAX_CELLS_ACROSS)), F.sqrt(F.size(ring).cast("double")))
    wanted = F.round(F.log2(across / F.nullif(extent, F.lit(0.0))) / step) * step
    top = LEVELS[-1] - LEVELS[-1] % step
    return F.least(F.lit(top), F.greatest(F.lit(LEVELS[0]), F.coalesce(wanted, F.lit(float(top))).cast("int"))).cast("int")


def _levelled(tracts: DataFrame, level: int | None) -> DataFrame:
    """The parts of polygons with their box ``_b`` and their ``level``."""
    ring = F.col("ring")
    box = F.when(F.col("_wide"), _bounds(ring)).otherwise(F.col("_b"))
    own = _own_level(ring, box) if level is None else F.lit(level)
    return computed_once(_parts(tracts), {"_b": box, "level": own}).drop("_wide")


def tract_cells(tracts: DataFrame, level: int | None = None) -> DataFrame:
    """One row per polygon and grid cell it may cover, carrying only the edges that matter there.

    Each polygon is cut at its own level unless one ``level`` is given for all. It is cut into horizontal
    strips first and each strip into cells, so a large polygon's edge list is scanned once per strip, not
    once per cell, and its strips spread over tasks. In a cell, edges above, below or to the left can never be
    crossed and are left out. Where no edge comes near the cell the whole cell is inside or outside: ``whole``
    is set and no edges are kept, or the row is dropped.
    """
    require(tracts.columns, TRACTS.names, "tracts")
    return _cut(_levelled(tracts.select(*TRACTS.names), level))


def _cut(parts: DataFrame) -> DataFrame:
    lv = F.col("level")
    size = 1.0 / _size(lv)
    bottom, left = F.col("cell_y") * size, F.col("cell_x") * size
    margin = size / 1024
    kept = ["tract_id", "block_group_id", "vintage", "level"]
    rows = F.explode(F.sequence(_cell(F.col("_b.y0"), lv), _cell(F.col("_b.y1"), lv))).alias("cell_y")
    across = F.sequence(_cell(F.col("_b.x0"), lv), _cell(F.col("_b.x1"), lv)).alias("_across")
    touching = F.filter("ring", lambda e: (F.greatest(e["y1"], e["y2"]) >= bottom) & (F.least(e["y1"], e["y2"]) <= bottom + size))
    strips = parts.select(*kept, "ring", across, rows).select(*kept, "cell_y", "_across", touching.alias("ring"))
    strips = strips.repartition("tract_id", "vintage", "level", "cell_y")
    cells = strips.select(*kept, "cell_y", "ring", F.explode("_across").alias("cell_x"))
    cells = computed_once(cells, {"ring": F.filter("ring", lambda e: F.greatest(e["x1"], e["x2"]) >= left - margin)})
    right = left + size + margin
    cells = computed_once(
        cells,
        {
            "_near": F.exists("ring", lambda e: F.least(e["x1"], e["x2"]) <= right),
            "_centre_in": inside_ring(F.col("ring"), left + size / 2, bottom + size / 2),
        },
    ).where(F.col("_near") | F.col("_centre_in"))
    return cells.select(
        "vintage",
        "level",
        "cell_x",
        "cell_y",
        "tract_id",
        "block_group_id",
        (~F.col("_near")).alias("whole"),
        F.when(F.col("_near"), F.col("ring")).alias("ring"),
    )


def _interleaved(x: Column, y: Column) -> Column:
    """The Morton code of two numbers of 26 bits: their bits in turn."""

    def spread(n: Column) -> Column:
        # Each step moves half of the bits that are still together.
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask))
        return n

    return spread(x.cast("bigint")).bitwiseOR(F.shiftleft(spread(y.cast("bigint")), 1))


def _boxed(cells: DataFrame) -> DataFrame:
    """Cells with their borders in degrees and their place on the curve."""
    size = 1.0 / _size(F.col("level"))
    west, south = F.col("cell_x") * size, F.col("cell_y") * size
    finest = float(2 ** LEVELS[-1])
    curve = _interleaved(F.floor((west + 512) * finest), F.floor((south + 512) * finest))
    return cells.withColumns({"west": west, "south": south, "east": west + size, "north": south + size, "_curve": curve})


@dataclass(frozen=True)
class TractIndex:
    """A cell table with the levels that occur in it. Build once, use for many inputs.

    ``broadcastable`` comes from an upper bound of the table's size that was computed from the polygons,
    not from an estimate. :meth:`save` and :meth:`load` keep an index for later jobs, so that polygons
    are cut once.
    """

    cells: DataFrame
    levels: tuple[int, ...]
    broadcastable: bool

    def save(self, folder: str, files: int = 64) -> TractIndex:
        """Write the index; the result reads it from there.

        Cells are dealt to about ``files`` files along a space-filling curve and sorted by it, so that
        each file and row group covers a small area; the area of each file is written beside them.
        """
        spark = self.cells.sparkSession
        laid = _boxed(self.cells).repartitionByRange(files, "_curve").sortWithinPartitions("_curve").drop("_curve")
        laid.write.parquet(f"{folder}/cells")
        areas = spark.read.parquet(f"{folder}/cells").groupBy(F.input_file_name().alias("path"))
        areas.agg(
            *[F.min(c).alias(c) for c in ("west", "south")], *[F.max(c).alias(c) for c in ("east", "north")]
        ).coalesce(1).write.parquet(f"{folder}/areas")
        spark.createDataFrame(
            [(list(self.levels), self.broadcastable)], "levels array<int>, broadcastable boolean"
        ).write.parquet(f"{folder}/facts")
        return TractIndex.load(spark, folder)

    @staticmethod
    def load(spark: SparkSession, folder: str, box: tuple[float, float, float, float] | None = None) -> TractIndex:
        """The index in ``folder``, or the part of it for points in ``box`` (west, south, east, north).

        Only files whose area meets the box are opened, and in them only row groups that do; see
        :func:`points_box`. Without points (a box of None values) nothing is read.
        """
        facts = spark.read.parquet(f"{folder}/facts").first()
        cells = spark.read.parquet(f"{folder}/cells")
        if box is not None:
            if None in box:
                meets = F.lit(False)
            else:
                west, south, east, north = box
                meets = (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south)
            paths = [row.path for row in spark.read.parquet(f"{folder}/areas").where(meets).select("path").collect()]
            cells = spark.read.schema(cells.schema).parquet(*paths).where(meets) if paths else cells.where(F.lit(False))
        return TractIndex(cells.drop("west", "south", "east", "north"), tuple(facts.levels), facts.broadcastable)


def points_box(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> tuple[float | None, ...]:
    """West, south, east and north of the usable points of ``df``; None each if there are none."""
    points = df.select(number_in(df, latitude).alias("y"), number_in(df, longitude).alias("x"))
    points = points.where(in_range(F.col("y"), F.col("x")))
    return tuple(points.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first())


def build_tract_index(
    tracts: DataFrame, level: int | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> TractIndex:
    """Find the levels the polygons ask for and bound the cell table's size, in one pass over them."""
    require(tracts.columns, TRACTS.names, "tracts")
    polygons = _levelled(tracts.select(*TRACTS.names), level)
    sized = polygons.groupBy("level").agg(F.sum(_size_bound()).alias("bound")).collect()
    levels = tuple(sorted(row.level for row in sized))
    return TractIndex(_cut(polygons), levels, sum(row.bound or 0.0 for row in sized) <= broadcast_bytes)


def _size_bound() -> Column:
    """Bytes a polygon's cells can take at most: every edge in every cell of the strips it touches."""
    scale = _size(F.col("level"))

    def spans(low: Column, high: Column) -> Column:
        return F.floor(high * scale) - F.floor(low * scale) + 1

    across = spans(F.col("_b.x0"), F.col("_b.x1"))
    strips = F.aggregate(
        "ring",
        F.lit(0).cast("bigint"),
        lambda n, e: n + spans(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])) + 1,
    )
    cells = across * spans(F.col("_b.y0"), F.col("_b.y1"))
    return (cells * _BYTES_PER_CELL + strips * across * _BYTES_PER_EDGE).cast("double")


def _cells_of_points(points: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Points (``_x``, ``_y``) with the cell of each level that holds them."""
    asked = points.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels])) if levels else F.lit(0))
    return asked.withColumns({"_cx": _cell(F.col("_x"), F.col("_level")), "_cy": _cell(F.col("_y"), F.col("_level"))})


def assign_tracts(
    df: DataFrame,
    tracts: DataFrame | TractIndex,
    latitude: str = "latitude",
    longitude: str = "longitude",
    vintage: str = "year_for_fips",
) -> DataFrame:
    """Add ``tract_id`` and ``block_group_id`` of the polygon of the row's vintage that holds it.

    Every input row is kept once; a row without usable coordinates or outside all polygons gets
    NULLs. When the measured cell table is small it is broadcast and the rows are not shuffled at
    all. Otherwise each distinct point is looked up once, so a coordinate shared by very many rows
    collapses before the join, and the answers are joined back.
    """
    index = tracts if isinstance(tracts, TractIndex) else build_tract_index(tracts)
    usable = in_range(F.col("_lat"), F.col("_lon"))
    parsed = df.withColumns({"_lat": number_in(df, latitude), "_lon": number_in(df, longitude)})
    rows = computed_once(
        parsed,
        {
            "_x": F.when(usable, F.col("_lon")),
            "_y": F.when(usable, F.col("_lat")),
            "_v": F.when(usable, F.col(vintage).cast("int")),
        },
    ).drop("_lat", "_lon")
    found = _by_broadcast(rows, index) if index.broadcastable else _by_shuffle(rows, index)
    return found.drop("_x", "_y", "_v")


def _by_broadcast(rows: DataFrame, index: TractIndex) -> DataFrame:
    candidates = F.array_sort(F.collect_list(F.struct("tract_id", "block_group_id", "whole", "ring")))

    def first(held: Column) -> Column:
        inside = F.filter(held, lambda c: c["whole"] | inside_ring(c["ring"], F.col("_x"), F.col("_y")))
        return F.get(inside, F.lit(0))

    joined, found = rows, []
    for level in index.levels:
        per_cell = index.cells.where(F.col("level") == level).groupBy(
            F.col("vintage").alias("_v"), F.col("cell_x").alias("_cx"), F.col("cell_y").alias("_cy")
        ).agg(candidates.alias(f"_at{level}"))
        cell = {"_cx": _cell(F.col("_x"), F.lit(level)), "_cy": _cell(F.col("_y"), F.lit(level))}
        joined = joined.withColumns(cell).join(F.broadcast(per_cell), ["_v", "_cx", "_cy"], "left")
        hit = first(F.col(f"_at{level}"))
        found.append(F.when(hit.isNotNull(), F.struct(hit["tract_id"].alias("tract_id"), hit["block_group_id"].alias("block_group_id"))))
    if not found:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("tract_id", "block_group_id")})
    best = F.least(*found) if len(found) > 1 else found[0]
    return joined.withColumn("_hit", best).select(*rows.columns, "_hit.tract_id", "_hit.block_group_id")


def _by_shuffle(rows: DataFrame, index: TractIndex) -> DataFrame:
    points = rows.select("_v", "_x", "_y").where("_x is not null and _v is not null").distinct()
    cells = index.cells.withColumnsRenamed({"vintage": "_v", "level": "_level", "cell_x": "_cx", "cell_y": "_cy"})
    answers = (
        _cells_of_points(points, index.levels)
        .join(shuffled(cells), ["_v", "_level", "_cx", "_cy"])
        .where(F.col("whole") | inside_ring(F.col("ring"), F.col("_x"), F.col("_y")))
        .groupBy("_v", "_x", "_y")
        .agg(F.min(F.struct("tract_id", "block_group_id")).alias("_hit"))
        .withColumn("_spread", no_spread("_x", "_y"))
    )
    # Rows without a point match nothing; spreading them keeps them out of one partition.
    return (
        rows.withColumn("_spread", spread_unless(F.col("_x").isNotNull(), rows))
        .join(answers, ["_v", "_x", "_y", "_spread"], "left")
        .select(*rows.columns, "_hit.tract_id", "_hit.block_group_id")
    )


def assign_codes(
    df: DataFrame, tracts: DataFrame | TractIndex, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Add the tract code of each vintage, ``FIPS_2010`` and ``FIPS_2020``, to rows with coordinates.

    Both vintages come from one pass over the cells, and each distinct point is looked up once.
    """
    index = tracts if isinstance(tracts, TractIndex) else build_tract_index(tracts)
    usable = in_range(F.col("_lat"), F.col("_lon"))
    parsed = df.withColumns({"_lat": number_in(df, latitude), "_lon": number_in(df, longitude)})
    point = {"_x": F.when(usable, F.col("_lon")), "_y": F.when(usable, F.col("_lat"))}
    rows = computed_once(parsed, point).drop("_lat", "_lon")
    kept = [c for c in df.columns if c not in CODES]
    if index.broadcastable:
        held = F.array_sort(F.collect_list(F.struct("tract_id", "vintage", "whole", "ring")))

        def first(level: int, vintage: int) -> Column:
            def holds(c: Column) -> Column:
                return (c["vintage"] == vintage) & (c["whole"] | inside_ring(c["ring"], F.col("_x"), F.col("_y")))

            return F.get(F.filter(f"_at{level}", holds), F.lit(0))["tract_id"]

        joined = rows
        for level in index.levels:
            per_cell = index.cells.where(F.col("level") == level).groupBy(
                F.col("cell_x").alias("_cx"), F.col("cell_y").alias("_cy")
            ).agg(held.alias(f"_at{level}"))
            cell = {"_cx": _cell(F.col("_x"), F.lit(level)), "_cy": _cell(F.col("_y"), F.lit(level))}
            joined = joined.withColumns(cell).join(F.broadcast(per_cell), ["_cx", "_cy"], "left")
        none = F.lit(None).cast("string")
        codes = [reduce(lambda a, b: F.least(a, b), [first(n, v) for n in index.levels] or [none]) for v in VINTAGES]
        return joined.select(*kept, *[format_fips(code).alias(c) for code, c in zip(codes, CODES)])
    points = _cells_of_points(rows.select("_x", "_y").where("_x is not null").distinct(), index.levels)
    cells = index.cells.withColumnsRenamed({"level": "_level", "cell_x": "_cx", "cell_y": "_cy"})
    hits = points.join(shuffled(cells), ["_level", "_cx", "_cy"]).where(F.col("whole") | inside_ring(F.col("ring"), F.col("_x"), F.col("_y")))
    least = [F.min(F.when(F.col("vintage") == v, F.col("tract_id"))) for v in VINTAGES]
    answers = hits.groupBy("_x", "_y").agg(*[format_fips(m).alias(c) for m, c in zip(least, CODES)])
    spread = rows.select(*kept, "_x", "_y").withColumn("_spread", spread_unless(F.col("_x").isNotNull(), rows))
    found = spread.join(answers.withColumn("_spread", no_spread("_x", "_y")), ["_x", "_y", "_spread"], "left")
    return found.select(*kept, *CODES)


def with_fips(df: DataFrame) -> DataFrame:
    """``FIPS`` from ``tract_id``; the tract and block-group columns are dropped."""
    return df.withColumn("FIPS", format_fips(F.col("tract_id"))).drop("tract_id", "block_group_id")
