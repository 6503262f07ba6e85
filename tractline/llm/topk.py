"""Exact largest inner products through an index of vectors by nearest pivot and distance.

Every vector is keyed by its nearest pivot and its distance from it. The keys of a pivot in order of
distance are cut into annuli, an annulus into blocks of bounded size. What a query can score inside an
annulus is bounded through the triangle inequality, so a query opens the annuli by falling bound, first
those that give it enough vectors, then only those whose bound reaches the lowest score it has kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import stored

TOP = 20
SCALE = 64.0
#: At most so many pivots, drawn from so many vectors, the ones of least hash; every vector is then indexed.
PIVOTS, PIVOT_SAMPLE = 64, 2048
#: A pivot's distances fall into at most so many annuli; all annuli are known to the driver.
ANNULI = 16
#: Vectors of a block on average, and queries that are compared with a block at once.
BLOCK, QUERY_BLOCK = 512, 128
#: In the first round a query opens annuli until they hold so many times the wanted vectors.
_FIRST = 4
_SUMMARY = ("pivot", "ring", "near", "far", "most", "n")


def usable(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id`` and ``x`` (each component times ``scale``, rounded down) of the vectors that take part."""
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return vectors.filter(F.col("embedding").isNotNull() & whole).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(row.values, dtype=np.float64) for row in column]) if len(column) else np.empty((0, 0))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Pivots far apart from each other, from a sample of bounded size."""
    drawn = vectors.select("x", F.xxhash64("x").alias("h")).distinct().orderBy("h", "x").limit(sample).select("x").toPandas()
    points = np.array(drawn["x"].tolist(), dtype=np.float64)
    if not len(points):
        return points
    chosen, gap = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def keyed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``pivot``, ``distance`` and ``norm``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                apart = _distances(x, pivots)
                pivot = apart.argmin(1)
                more = [pivot.astype(np.int32), apart[np.arange(len(x)), pivot], np.sqrt((x**2).sum(1))]
                yield pa.record_batch([*batch.columns, *map(pa.array, more)], names=["vec_id", "x", "pivot", "distance", "norm"])

    return vectors.mapInArrow(scan, "vec_id bigint, x array<double>, pivot int, distance double, norm double")


def _annuli(index: DataFrame, rings: int) -> DataFrame:
    """``index`` with ``ring``: each pivot's distances cut into ``rings`` equal widths."""
    widest = index.groupBy("pivot").agg(F.max("distance").alias("widest"))
    ring = F.least(F.floor(F.col("distance") / F.greatest("widest", F.lit(1e-9)) * rings), F.lit(rings - 1))
    return index.join(F.broadcast(widest), "pivot").withColumn("ring", ring.cast("int")).drop("widest")


def _packed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per ``keys`` with ``ids``, ``floors`` and ``matrix``; keys hold a bounded number of vectors."""
    held = F.sort_array(F.collect_list(F.struct("vec_id", "floor", "x"))).alias("held")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices = [_matrix(row.values.field("x")).tobytes() for row in batch.column(len(keys))]
            lists = [[row.values.field(f).to_pylist() for row in batch.column(len(keys))] for f in ("vec_id", "floor")]
            columns = [*batch.columns[:-1], *[pa.array(v, pa.list_(pa.int64())) for v in lists], pa.array(matrices, pa.binary())]
            yield pa.record_batch(columns, names=[*keys, "ids", "floors", "matrix"])

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    grouped = rows.groupBy(*keys).agg(held)
    return grouped.mapInArrow(pack, f"{kinds}, ids array<bigint>, floors array<bigint>, matrix binary")


def _bounds(queries: np.ndarray, pivots: np.ndarray, annuli: pd.DataFrame) -> np.ndarray:
    """The highest inner product that each query can have with a vector of each annulus.

    With d = |q - p| and near <= |x - p| <= far, the triangle inequality gives |q - x| >= gap, the distance of d
    from that range, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2. Also q.x = q.p + q.(x - p) <= q.p + |q| far, and
    q.x <= |q| |x|. The least of the three holds.
    """
    pivot = annuli["pivot"].to_numpy()
    near, far, most = (annuli[c].to_numpy() for c in ("near", "far", "most"))
    norms = np.sqrt((queries**2).sum(1))[:, None]
    apart = _distances(queries, pivots)[:, pivot]
    gap = np.maximum(np.maximum(near - apart, apart - far), 0)
    through = (norms**2 + most**2 - gap**2) / 2
    across = (queries @ pivots.T)[:, pivot] + norms * far
    # Rounding of the square roots must not hide a vector.
    return np.minimum(np.minimum(through, across), norms * most) * (1 + 1e-9) + 1e-3


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores, smaller ids first among equals."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:top]]


def _products(pairs: DataFrame, top: int) -> DataFrame:
    """``query_id``, ``vec_id``, ``score``: the best of each block for each query that opens it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, floors, q, ids, x = (batch.column(i)[row] for i in range(5))  # one block of each
                q_ids, ids = np.asarray(q_ids.values), np.asarray(ids.values)
                floors = np.asarray(floors.values)
                q = np.frombuffer(q.as_buffer(), dtype=np.float64).reshape(len(q_ids), -1)
                x = np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(len(ids), -1)
                scores = _exact(q, x)
                scores = np.where(q_ids[:, None] == ids[None, :], _NONE, scores)
                out = [(i, _best(scores[i], ids, top)) for i in range(len(q_ids))]
                out = [(i, at[(scores[i, at] >= floors[i]) & (scores[i, at] != _NONE)]) for i, at in out]
                sizes = [len(at) for _, at in out]
                places = np.concatenate([at for _, at in out])
                lines = np.repeat(np.arange(len(q_ids)), sizes)
                yield pa.record_batch(
                    [pa.array(v) for v in (q_ids[lines], ids[places], scores[lines, places])],
                    names=["query_id", "vec_id", "score"],
                )

    return pairs.select("query_ids", "floors", "queries", "ids", "matrix").mapInArrow(
        run, "query_id bigint, vec_id bigint, score bigint"
    )


_NONE = np.iinfo(np.int64).min


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point only where it is exact."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) < 2**53:
        return np.rint(q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best per query by rank; few rows of each query come here."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, top)
    rows = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("rank", "b"))
    return rows.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def top_products(vectors: DataFrame, queries: DataFrame, top: int = TOP, scale: float = SCALE) -> DataFrame:
    """Each query's ``top`` highest integer inner products: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; components are multiplied by ``scale`` and
    rounded down. Candidates are all vectors but those with the query's own id; ties go to the smaller id; fewer
    candidates give fewer rows. Vectors that are null, or hold a null or a number that is not finite, take no
    part, neither do rows with a null ``vec_id``. Of usable rows that repeat an id one counts. All vectors have one
    length. Other columns are not read.
    """
    spark = vectors.sparkSession
    columns = ["vec_id", "embedding"]
    data = usable(vectors.select(columns).filter("vec_id IS NOT NULL"), scale).dropDuplicates(["vec_id"])
    asked = usable(queries.select(columns).filter("vec_id IS NOT NULL"), scale).dropDuplicates(["vec_id"])
    data = stored(data, "topk-vectors")
    cells = min(max(1, data.count() // BLOCK), PIVOTS * ANNULI)
    count = min(PIVOTS, math.ceil(math.sqrt(cells)))
    pivots = choose_pivots(data, count)
    if not len(pivots):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    index = _annuli(stored(keyed(data, pivots), "topk-keyed"), min(ANNULI, math.ceil(cells / count)))
    index = stored(index, "topk-annuli")
    annuli = index.groupBy("pivot", "ring").agg(
        F.min("distance").alias("near"), F.max("distance").alias("far"), F.max("norm").alias("most"), F.count(F.lit(1)).alias("n")
    )
    annuli = annuli.select(*_SUMMARY).orderBy("pivot", "ring").toPandas()
    # A frequent annulus has many blocks, dealt by a hash, so no task gets it whole.
    parts = [(int(p), int(r), max(1, -(-int(n) // BLOCK))) for p, r, n in zip(annuli["pivot"], annuli["ring"], annuli["n"], strict=True)]
    parts = F.broadcast(spark.createDataFrame(parts, "pivot int, ring int, parts int"))
    blocked = index.join(parts, ["pivot", "ring"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    blocks = _packed(blocked.withColumn("floor", F.lit(0).cast("bigint")), ("pivot", "ring", "part"))

    lots = keyed(asked, pivots).orderBy("pivot", "distance", "vec_id").select("vec_id", "x")
    row = F.col("row")
    number = F.shiftright(row, 33) * (1 << 25) + F.floor(row.bitwiseAND(F.lit((1 << 33) - 1)) / QUERY_BLOCK)
    lots = stored(lots.withColumn("row", F.monotonically_increasing_id()).withColumn("lot", number), "topk-queries")

    def searched(rows: DataFrame, first: bool) -> DataFrame:
        """Scores of this round; ``rows`` has ``lot``, ``vec_id``, ``x`` and ``floor``."""
        packed = _packed(rows, ("lot",))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = annuli["n"].to_numpy()
            for batch in batches:
                for lot, _, floors, matrix in zip(*batch.columns, strict=True):
                    floors = floors.values.to_numpy()
                    bounds = _bounds(np.frombuffer(matrix.as_buffer()).reshape(len(floors), -1), pivots, annuli)
                    order = np.argsort(-bounds, axis=1, kind="stable")
                    before = np.cumsum(n[order], axis=1) - n[order]
                    early = np.zeros(bounds.shape, dtype=bool)
                    np.put_along_axis(early, order, before < _FIRST * top + 1, axis=1)
                    # The first round compares all queries of a lot with what any of them opens.
                    early = early.any(0)
                    at = np.flatnonzero(early if first else ~early & (bounds >= floors[:, None]).any(0))
                    opened = [pa.array(annuli[c].to_numpy()[at].astype(np.int32)) for c in ("pivot", "ring")]
                    yield pa.record_batch([pa.array([lot.as_py()] * len(at), pa.int64()), *opened], names=["lot", "pivot", "ring"])

        opened = stored(packed.mapInArrow(run, "lot bigint, pivot int, ring int"), "topk-open")
        pairs = opened.join(parts, ["pivot", "ring"])
        pairs = pairs.select("lot", "pivot", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        renamed = packed.withColumnsRenamed({"ids": "query_ids", "matrix": "queries"})
        return _products(pairs.join(renamed, "lot").join(blocks.drop("floors"), ["pivot", "ring", "part"]), top)

    lowest = F.lit(int(_NONE) + 1).cast("bigint")
    early = stored(_ranked(searched(lots.withColumn("floor", lowest), True), top), "topk-first")
    low = early.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= top)
    floors = lots.join(low, F.col("vec_id") == F.col("query_id"), "left").withColumn("floor", F.coalesce("low", lowest))
    late = searched(stored(floors.select("lot", "vec_id", "x", "floor"), "topk-floors"), False)
    return _ranked(early.select("query_id", "vec_id", "score").unionByName(late), top)


SQL = """
WITH v AS (
    SELECT vec_id, [floor(CAST(c AS DOUBLE) * 64) FOR c IN embedding] AS x FROM embeddings WHERE embedding IS NOT NULL),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 20
"""
