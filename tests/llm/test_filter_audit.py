import re
from itertools import permutations
from math import factorial

import duckdb

from check import rows_of
from tractline.llm import filter_audit
from tractline.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, source string, part string, failed int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def failures(docs):
    """Sets of failed filters, row by row, as the contract words them."""
    out = []
    for doc_id, text, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 50:
            failed.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        if doc_id is not None and any((t or "") == text and i is not None and i < doc_id for i, t, *_ in docs):
            failed.add("E")
        out.append(failed)
    return out


def plain(docs, labels):
    """Every order is walked document by document."""
    failed, rows = failures(docs), []
    good = {i for i, q, *_ in labels if q == 1}
    toxic = {i for i, _, t, *_ in labels if t == 1}
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, failed, strict=True) if (d[2] or "") == part]
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                fails = [f for _, f in mine if letter in f]
                lost = [sum(i is not None and i in marked for i, _ in gone) for marked in (good, toxic)]
                steps.append(("".join(order), step, letter, len(left), len(gone), len(fails) - len(gone), sum(len(f) == 1 for f in fails), *lost))
        for order, step, letter, *figures in steps:
            rows.append((part, order, step, *figures, sum(s[4] for s in steps if s[2] == letter)))
    return sorted(rows)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_edge_cases_against_walking_every_order(spark):
    long = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", " \n\t", long, long, long + " #", long.upper(), "a " * 80, "a " * 80 + "$", "É" * 100, "\x1f" * 3, "x y" * 5000]
    docs = [(i, t, [None, "", "web", "books"][i % 4], "p", 3) for i, t in enumerate(texts)]
    docs += [(3, long, "web", "p", 3), (None, long, "web", "p", 3), (None, None, None, "p", 3), (-1, "lone", "only", "p", 3)]
    labels = [(0, 1, 1, "t"), (4, 1, 0, "t"), (4, 0, 1, "t"), (6, None, None, "t"), (None, 1, 1, "t"), (99, 1, 1, "t"), (-1, 1, 1, "t")]
    got = filter_audit.audit_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert rows(got) == plain(docs, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert filter_audit.audit_documents(docs, spark.createDataFrame([], LABELS)).collect() == []
    one = spark.createDataFrame([(1, "x", None, None, None)], DOCS)
    got = filter_audit.audit_documents(one, spark.createDataFrame([], LABELS))
    assert got.count() == 600 and rows(got) == plain([(1, "x", None)], [])


def test_orders_through_the_lattice():
    for n in range(1, 6):
        edges = filter_audit.lattice(n)
        assert len(edges) == n << n - 1
        for f in range(n):
            assert sum(w for _, g, w in edges if g == f) == factorial(n)
        counted = {}
        for order in permutations(range(n)):
            state = 0
            for f in order:
                counted[state, f] = counted.get((state, f), 0) + 1
                state |= 1 << f
        assert counted == {(s, f): w for s, f, w in edges}


def test_other_filters(spark):
    """Three filters without labels; the Shapley sums of a part add up to what all orders remove."""
    masks = spark.createDataFrame([("p", m) for m in (0, 1, 1, 3, 5, 6, 7)] + [("q", 0)], "part string, failed int")
    got = filter_audit.audit(masks, "xyz").collect()
    assert len(got) == 2 * 18
    assert sum(r.shapley for r in got if r.part == "p" and r.filter_order == "xyz") == 6 * factorial(3)
    assert {(r.kept, r.removed) for r in got if r.part == "q"} == {(1, 0)}
    assert [(r.kept, r.removed, r.redundant, r.unique_fails) for r in got if r.filter_order == "zxy" and r.step == 2 and r.part == "p"] == [(1, 3, 2, 2)]


def test_query_against_sql_and_against_walking(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op12_filter_audit"](spark, folder)
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cursor = db.execute(filter_audit.SQL)
    assert rows_of(got.columns, got.collect()) == rows_of([c[0] for c in cursor.description], cursor.fetchall())
    docs = db.execute("SELECT doc_id, text, source FROM documents").fetchall()
    assert rows(got) == plain(docs, db.execute("SELECT doc_id, quality, toxic FROM labels").fetchall())
