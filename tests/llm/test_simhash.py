import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tractline.llm import simhash
from tractline.llm.graph import components
from tractline.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, fingerprint int, key string"


def plain_fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = [t for t in "".join(" " if c in "\t\n\x0b\f\r " else c for c in lowered).split(" ") if t]
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=3):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def run(spark, rows, **more):
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), **more).collect()
    return {(r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in got}, len(got)


def test_rows_against_brute_force(spark):
    rng = random.Random(5)
    words = ["alpha", "Beta", "ÄRGER", "the", "of", "x", "日本", "o'clock"]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "Two words", "two  WORDS", "a b c d"] + base
    texts += [b + " tail" for b in base] + base[:4] + [base[0] * 40]
    rows = [(i, t, i, "k") for i, t in enumerate(texts)]
    prints = [plain_fingerprint(t) for t in texts]
    want = {(i, p, g) for (i, p, g) in zip(range(len(texts)), prints, plain_groups(prints), strict=True)}
    assert run(spark, rows) == (want, len(rows))


def test_repeated_rows_null_ids_and_no_rows(spark):
    got, n = run(spark, [(7, "same text here now", 1, "a"), (7, "same text here now", 1, "a"), (None, "same text here now", 2, None)])
    assert n == 3 and {c for *_, c in got} == {7}
    assert run(spark, [(None, None, None, None)])[0] == {(None, 0, None)}
    assert run(spark, []) == (set(), 0)


@pytest.mark.parametrize(("run_size", "distance"), [(4, 3), (1024, 3), (4, 4)])
def test_links_connect_exactly_what_is_near(spark, run_size, distance, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for c in centres for _ in range(40)]
    prints = sorted({*near, *(int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)), 0, 2**64 - 1})
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    monkeypatch.setattr(simhash.keyed, "__defaults__", (distance, run_size))
    roots = {r.node: r.root for r in components(simhash.links(df, distance)).collect()}
    groups = plain_groups(prints, distance)
    got = {}
    for i, p in enumerate(signed):
        got.setdefault(roots.get(p, p), set()).add(i)
    want = {}
    for i, g in enumerate(groups):
        want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    want = {(d.doc_id, f"{p:016x}", docs[g].doc_id) for d, p, g in zip(docs, prints, plain_groups(prints), strict=True)}
    got = QUERIES["op9_simhash"](spark, folder).select("doc_id", "fingerprint", "component_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)


def test_components_of_a_long_chain(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    edges = list(zip(ids, ids[1:], strict=False)) + [(1000, 1001), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in ids}) == 1 and got[1000] == got[1001] != got[0]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).agg(F.count("*")).first()[0] == 0
