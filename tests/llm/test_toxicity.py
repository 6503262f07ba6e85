import itertools
import math
import random
import time

import numpy as np
import pytest

from tractline.llm import toxicity as t
from tractline.llm.queries import QUERIES

CORPUS = "you are an idiot and a stupid clown said the moron whose trash is pathetic but the weather was fine today indeed"


@pytest.fixture(scope="module")
def model():
    counts = np.bincount(t._trigrams(" ".join([CORPUS] * 50)), minlength=28**3)
    return t.log_model(counts.reshape(28, 28, 28))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("1d10t", "idiot"), ("$tup1d", "stupid"), ("s t u p i d", "stupid"), ("m-o-r-o-n", "moron"), ("clooooown", "clown"),
        ("tr@sh", "trash"), ("p4th3t1c", "pathetic"), ("5 t u p 1 d", "stupid"), ("m0r0n", "moron"),
    ],
)
def test_disguises_are_read(model, written, meant):
    assert meant in set(t._restored(f"He is a {written.upper()} today.", model, {}))


def test_plain_words_stay(model):
    assert set(t._restored("The weather, was (fine) today!", model, {})) == {"the", "weather", "was", "fine", "today"}


def test_search_finds_the_best_path(model):
    """Every path through the lattice is tried."""
    for text in ("1d10t", "cl00wn", "a-b1", "$$a", "s t 1"):
        best = -math.inf
        for path in itertools.product(*t._lattice(text)):
            a = b = t._EDGE
            score, word, valid = 0.0, "", True
            for letter, written, cost in path:
                score += cost
                if letter == t._EDGE and b == t._EDGE:
                    valid = False
                if letter >= 0:
                    score += model[a][b][letter]
                    a, b, word = b, letter, word + written
            score += model[a][b][t._EDGE]
            if valid and score > best:
                best, want = score, word
        assert t.restore(text, model) == want


def learnable(rng, n):
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=40)
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["stupid", "idiot", "moron"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_scores_nulls_repeats_and_no_labels(spark):
    rows = learnable(random.Random(1), 400)
    docs = [(i, x, "a", 0.5) for i, x, _ in rows]
    docs += [(1000, None, "a", 1.0), (1001, "", "a", 1.0), (1002, "ban den 1d10t fan", "a", 1.0), (1002, "ban den 1d10t fan", "a", 1.0), (None, "ban s t u p i d", "a", 1.0), (1003, "ban " * 50_000 + "m0ron", "a", 1.0)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, predicted string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (3, None, 1)], "doc_id bigint, toxic int, quality int")
    got = t.score_documents(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r.predicted for r in got}
    assert by_id[1000] == by_id[1001] == 0 and by_id[1002] == by_id[None] == by_id[1003] == 1
    assert sum(by_id[i] == y for i, _, y in rows) >= 398
    kept = t.keep_clean(df, labels)
    assert kept.schema.names == df.schema.names and {r.doc_id for r in kept.collect()} == {d for d, p in by_id.items() if not p}
    assert {r.predicted for r in t.score_documents(df, labels.filter("false")).collect()} == {0}
    assert t.score_documents(df.filter("false"), labels).collect() == []


def test_held_out_accuracy_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op10_toxicity"](spark, folder)
    rows = got.join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    hits = sum(r.toxic and r.predicted for r in rows)
    assert hits >= 0.85 * sum(r.toxic for r in rows) and hits >= 0.9 * sum(r.predicted for r in rows)


def test_rows_of_separators_take_no_time(model):
    for text in ("a" + "." * 10_000 + "12", "Chapter one " + "." * 500 + " 7", "-_." * 5000 + "x", "a. " * 5000 + "word", "_" * 9000):
        began = time.perf_counter()
        list(t._restored(text, model, {}))
        assert time.perf_counter() - began < 15
