import random

import pandas as pd

from tractline.llm import packing
from tractline.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, source string, bin int"


def plain_best_fit(items, capacity):
    """(bin, offset) per item in the packing order; every bin is looked at for every item."""
    bins, out = [], []
    for words, source, cluster in items:
        fits = [
            (capacity - sum(w for w, *_ in b), i)
            for i, b in enumerate(bins)
            if capacity - sum(w for w, *_ in b) >= words
            and all((source is None or s != source) and c != cluster for _, s, c in b)
        ]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append([])
        out.append((at, sum(w for w, *_ in bins[at])))
        bins[at].append((words, source, cluster))
    return out


def test_a_group_against_trying_every_bin():
    rng = random.Random(2)
    for case in range(8):
        rows = [
            (i, 0, rng.choice([1, 5, 9, 30, 64, rng.randint(1, 64)]), rng.choice([None, "hot", "hot", f"s{rng.randint(0, 9)}"]), rng.randint(0, 400 if case % 2 else 40))
            for i in range(300)
        ]
        frame = pd.DataFrame(rows, columns=["row_id", "piece", "words", "source", "cluster"])
        got = packing.pack_group(3, frame, 64).set_index("row_id")
        order = sorted(rows, key=lambda r: (-r[2], r[4], r[0]))
        want = plain_best_fit([(r[2], r[3], r[4]) for r in order], 64)
        assert [(int(got.bin[r[0]]) - (3 << 32), int(got.offset[r[0]])) for r in order] == want


def check(rows, texts, capacity):
    """Every word is placed once, and no bin is overfull or in conflict."""
    seen, bins = {}, {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append((r.start, r.words))
        if r.words:
            bins.setdefault(r.bin, []).append((r.offset, r.words, r.doc_id))
        else:
            assert r.bin is None and r.offset is None
    for held in bins.values():
        end = 0
        for offset, words, _ in sorted(held):
            assert offset == end
            end += words
        assert end <= capacity
        sources = [texts[d][1] for *_, d in held if texts[d][1] is not None]
        assert len(set(sources)) == len(sources) and len({texts[d][0] for *_, d in held}) == len(held)
    for d, (text, _) in texts.items():
        end = 0
        for start, words in sorted(seen[d]):
            assert start == end
            end += words
        assert end == len((text or "").split())


def test_edge_cases(spark):
    texts = {1: (None, "a"), 2: ("", "a"), 3: (" \n", None), 4: ("w " * 50, "a"), 5: ("w " * 50, "b"), 6: ("x " * 8, None), 7: ("y " * 20, "a"), 8: ("z", None)}
    rows = [(d, t, s, 9) for d, (t, s) in texts.items()]
    check(packing.pack(spark.createDataFrame(rows, SCHEMA), 20).collect(), texts, 20)
    repeated = packing.pack(spark.createDataFrame([rows[5]] * 3 + [(None, "q q", None, None)], SCHEMA), 20).collect()
    assert len(repeated) == 4 and len({r.bin for r in repeated if r.doc_id == 6}) == 3
    assert packing.pack(spark.createDataFrame([], SCHEMA), 20).collect() == []


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(QUERIES["op7_packing"](spark, folder).collect(), {d.doc_id: (d.text, d.source) for d in docs}, packing.CAPACITY)
