import zlib

from pyspark.sql import functions as F

from tractline.llm import sharding
from tractline.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, shard int, slot string"


def check(rows, texts, shards):
    """Counts at most one apart, slots gapless, sizes and checksums right."""
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r.slot)
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 16 and r.text_crc32 == (None if r.text is None else zlib.crc32(data))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    counts = [len(held.get(s, ())) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())


def run(spark, texts, shards):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in texts], SCHEMA)
    got = sharding.shard_documents(df, shards).join(df.select("doc_id", "text").distinct(), "doc_id", "left").collect()
    check(got, texts, shards)
    return got


def test_copies_stay_together_and_counts_stay_even(spark):
    texts = [(i, f"copy {i % 60}" if i < 240 else f"single {i}") for i in range(400)]
    got = run(spark, texts, 8)
    groups = {}
    for r in got:
        if r.text.startswith("copy"):
            groups.setdefault(r.text, set()).add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 3


def test_without_single_rows_moves_are_swaps(spark):
    texts = [(i, f"pair {i // 2}") for i in range(400)]
    got = run(spark, texts, 4)
    apart = {}
    for r in got:
        apart.setdefault(r.text, set()).add(r.shard)
    assert sum(len(a) > 1 for a in apart.values()) < 80


def test_a_group_no_shard_can_hold(spark):
    got = run(spark, [(i, "hot" if i < 300 else f"t{i}") for i in range(600)], 10)
    assert len({r.shard for r in got if r.text == "hot"}) <= 10


def test_nulls_repeats_and_small_tables(spark):
    run(spark, [(1, None), (2, None), (3, ""), (4, ""), (5, "x" * 100_000)], 3)
    assert run(spark, [], 3) == []
    repeated = spark.createDataFrame([(None, "a", 1, "x")] * 5 + [(9, None, 1, "x")], SCHEMA)
    got = sharding.shard_documents(repeated, 4).collect()
    assert len(got) == 6 and max(sum(r.shard == s for r in got) for s in range(4)) == 2


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op1_sharding"](spark, folder).join(docs.select("doc_id", "text"), "doc_id").collect()
    check(got, docs.select("doc_id", F.lit(0)).collect(), 40)


def test_groups_that_a_shard_can_hold_are_not_cut(spark):
    sizes = {"a": 150, "b": 140, "c": 120}
    texts = [(k, t) for k, t in enumerate([g for g, n in sizes.items() for _ in range(n)] + [f"single {i}" for i in range(1590)])]
    got = run(spark, texts, 10)
    assert [len({r.shard for r in got if r.text == g}) for g in sizes] == [1, 1, 1]


def test_a_group_no_shard_can_hold_takes_as_few_as_it_needs(spark):
    got = run(spark, [(i, "hot" if i < 300 else f"t{i}") for i in range(600)], 10)
    assert len({r.shard for r in got if r.text == "hot"}) == 5
