import random
import re

import pytest

from tractline.llm import decontamination as d

DOCS = "doc_id bigint, text string, item_id int, words string"
ITEMS = "item_id bigint, text string, seed int"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain(docs, items):
    """Every item is laid on every document in every way."""
    out = set()
    for doc, text in docs:
        t = words(text)
        for item, passage in items:
            b = words(passage)
            width = min(20, len(b))
            least = width if width < 8 else -(-width * 4 // 5)
            for start in range(1 - len(b), len(t)) if len(b) >= 5 else ():
                equal = [0 <= start + k < len(t) and t[start + k] == w for k, w in enumerate(b)]
                most = max(sum(equal[s : s + width]) for s in range(len(b) - width + 1))
                if most >= least:
                    out.add((doc, item, start, width, most))
    return out


def run(spark, docs, items):
    found = d.find_passages(
        spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS), spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    )
    return {tuple(r)[:5] for r in found.collect()}


def test_against_every_placing(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)] + ["the", "of"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([4, 5, 6, 8, 10, 14, 15, 20, 33, 50])]
    docs = []
    for i in range(80):
        passage = words(rng.choice(items)[1])
        for _ in range(rng.choice([0, 1, 2, 3, 4, len(passage) // 5])):
            passage[rng.randrange(len(passage))] = "other"
        docs.append((i, " ".join([*rng.choices(vocabulary, k=30), *passage, *rng.choices(vocabulary, k=rng.randint(0, 9))]).upper()))
    want = plain(docs, items)
    assert run(spark, docs, items) == want and len(want) > 40


@pytest.mark.parametrize("length", range(8, 21))
def test_no_pattern_of_differing_words_escapes_the_masks(length):
    from itertools import combinations

    seeds = [sum(int(b) << i for i, b in enumerate(m)) << s for m in d.MASKS for s in range(length - len(m) + 1)]
    for places in combinations(range(length), length // 5):
        differing = sum(1 << p for p in places)
        assert any(not differing & s for s in seeds)


def test_edges(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [
        (1, None), (2, ""), (3, "!!"), (None, passage), (4, passage.replace(" ", " | ") + "."), (4, passage), (5, passage[:20]),
        (6, "x " * 100_000 + passage), (7, "two three four five six seven eight nine ten and on"), (8, "clean words only here"),
    ]
    items = [(1, passage), (1, passage), (None, None), (2, ""), (3, "one two three")]
    got = run(spark, docs, items)
    assert got == {(None, 1, 0, 10, 10), (4, 1, 0, 10, 10), (6, 1, 100_000, 10, 10), (7, 1, -1, 10, 9)}
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    left = d.decontaminate(frame, bench)
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 5, 8]
    assert d.decontaminate(frame.filter("false"), bench).count() == 0
    assert d.decontaminate(frame, bench.filter("false")).count() == len(docs)
