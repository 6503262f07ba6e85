import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from check import rows_of
from tractline.llm import prefix_trie
from tractline.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn int, role string, text string, path string, depth int, node string"


def plain_rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    for own in turns.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
    plain = {c: [t[1:] for t in own] for c, own in turns.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = plain.get(first, [])[:h] + own[h:]
    return out


def plain_nodes(paths):
    """Every prefix of every path in a dictionary, without a compacted trie."""
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q != p and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(prefix), parent, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


def tuples(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def turns_of(paths):
    return [(c, i, role, text) for c, path in paths.items() for i, (role, text) in enumerate(path)]


def of_paths(spark, paths):
    rows = [(c, i + 1, role, hashlib.sha256(t.encode()).hexdigest(), len(t.encode())) for c, i, role, t in turns_of(paths)]
    rows += [(c, None, None, None, None) for c, path in paths.items() if not path]
    turns = spark.createDataFrame(rows, "conv_id bigint, at int, role string, digest string, bytes bigint")
    return prefix_trie.trie_nodes(prefix_trie.with_paths(turns))


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f"))
    for r in df.collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: (x & -x, -x))


@pytest.mark.parametrize("kind", ["alike", "comb", "random"])
def test_tries_against_a_dictionary_of_prefixes(spark, kind):
    rng = random.Random(3)
    if kind == "alike":
        paths = {i: [("u", "same")] * (i % 4) for i in range(60)}
    elif kind == "comb":
        # Each conversation is a prefix of the next, or leaves the spine by a turn of its own.
        spine = [("u", f"t{i}") for i in range(24)]
        paths = {i: spine[:i] + ([("x", str(i))] if i % 3 == 0 else []) for i in range(25)}
    else:
        paths = {i * 7 - 100: [("ua"[rng.random() < 0.5], "é"[: rng.randint(0, 1)]) for _ in range(rng.randint(0, 9))] for i in range(120)}
    assert tuples(of_paths(spark, paths)) == plain_nodes(paths)


def test_edge_cases_of_the_table(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(-12, 40), 10**15, 10**15 + 3]:
        for _ in range(rng.randint(1, 11)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "", "user", "bot"]), rng.choice([None, "", "hi", "long " * 3])))
    rows += rows[:5] + [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(7, 50, "user", "very long " * 20000)]
    df = spark.createDataFrame([(*r, "p", 4, "n") for r in rows], SCHEMA)
    assert tuples(prefix_trie.conversation_trie(df)) == plain_nodes(plain_rebuilt(rows))


def test_conversations_without_turns_and_empty_tables(spark):
    lost = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(lost, 1, "user", "gone")]
    assert plain_rebuilt(rows) == {lost: []}
    df = spark.createDataFrame([(*r, "p", 4, "n") for r in rows], SCHEMA)
    assert tuples(prefix_trie.conversation_trie(df)) == plain_nodes({lost: []})
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op13_prefix_trie"](spark, folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    cursor = db.execute(prefix_trie.SQL)
    want = cursor.fetchall()
    assert rows_of(got.columns, got.collect()) == rows_of([c[0] for c in cursor.description], want)
    rows = db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert tuples(got) == plain_nodes(plain_rebuilt(rows))
