import random

import pytest

from tractline.llm import topk
from tractline.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, query_id string"


def plain(rows, queries, top, scale=64):
    def whole(v):
        return v is not None and all(c is not None and c == c and abs(c) != float("inf") for c in v)

    vectors = {i: [int(c * scale // 1) for c in v] for i, v in rows if i is not None and whole(v)}
    out = set()
    for q in queries:
        if q in vectors:
            scored = [(-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:top], 1)}
    return out


def run(spark, rows, queries, top):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = topk.top_products(df, df.filter(df.vec_id.isin(list(queries)) if queries else "false"), top).collect()
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in got}, len(got)


@pytest.mark.parametrize("hot", [0, 60])
def test_against_every_product(spark, monkeypatch, hot):
    for name, value in (("BLOCK", 8), ("QUERY_BLOCK", 4), ("_FIRST", 1)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(hot)
    centres = [[rng.uniform(-4, 4) for _ in range(6)] for _ in range(5)]
    # Halves and quarters are the same in single precision.
    rows = [(i, [round(c + rng.gauss(0, 0.4), 1) // 0.125 * 0.125 for c in rng.choice(centres)]) for i in range(220)]
    rows += [(1000 + i, [1.0] * 6) for i in range(hot)]
    queries = range(0, 1100, 7)
    want = plain(rows, queries, 5)
    assert run(spark, rows, queries, 5) == (want, len(want))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.5, -0.5]), (None, [9.0, 9.0]), (0, [1.0, 2.0])]
    want = {(0, 1, 5, 32 * 64 - 32 * 128), (5, 1, 0, 32 * 64 - 32 * 128)}
    assert run(spark, rows, range(8), 20) == (want, 2)
    assert run(spark, rows[:1], [0], 20) == (set(), 0)
    assert run(spark, rows[1:3], [1], 20) == (set(), 0)
    assert run(spark, [], [], 20) == (set(), 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 - i), 2.0**22, -(2.0**20)]) for i in range(4)]
    want = plain(rows, range(4), 3)
    assert run(spark, rows, range(4), 3) == (want, 12)


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op6_topk"](spark, folder).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == plain(rows, [i for i, _ in rows if i % 20 == 0], 20)


def test_an_unusable_row_displaces_no_other_of_its_id(spark):
    for bad in (None, [None, 1.0], [float("nan"), 1.0]):
        rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0])] + [(3, bad)] * 20 + [(3, [3.0, 0.0])] + [(3, bad)] * 20
        df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(4)
        got = topk.top_products(df, df.filter("vec_id IN (1, 3)"), 5).collect()
        assert {(r.query_id, r.vec_id) for r in got} == {(1, 2), (1, 3), (3, 1), (3, 2)}
