import math
from collections import Counter

from tractline.llm import licences
from tractline.llm.queries import QUERIES

SCHEMA = "path string, text string, key bigint, licence string"
MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."
FILES = [
    ("LICENSE", MIT),
    ("a/COPYING", GPL),
    ("a/b/code.py", "nothing to see here"),
    ("a/b/c/deep.py", None),
    ("a/other.py", "words of prose and more words of prose\nLicensed under the Apache License, Version 2.0.\nmore prose"),
    ("z/file.py", ""),
    ("a2/file.py", "not below a"),
    (None, "no path and no licence"),
    (None, MIT + "\nand a text that goes on about many other things for quite a while"),
]


def run(spark, files):
    got = licences.scan_licences(spark.createDataFrame([(p, t, 5, "x") for p, t in files], SCHEMA)).collect()
    return [(r.path, r.text, r.licence, r.origin, r.licensed_by) for r in got]


def test_nearest_directory_counts(spark):
    got = {(p, t): (lic, origin, by) for p, t, lic, origin, by in run(spark, FILES)}
    assert len(got) == len(FILES)
    assert got[FILES[0]] == ("MIT", "own", "LICENSE") and got[FILES[1]] == ("GPL-3.0", "own", "a/COPYING")
    assert got[FILES[2]] == got[FILES[3]] == ("GPL-3.0", "inherited", "a")
    assert got[FILES[4]] == ("Apache-2.0", "own", "a/other.py")
    assert got[FILES[5]] == got[FILES[6]] == ("MIT", "inherited", "")
    assert got[FILES[7]] == (None, None, None) and got[FILES[8]] == ("MIT", "own", None)


def test_repeats_long_texts_and_no_rows(spark):
    long = "prose and more " * 50_000 + "\n" + GPL
    got = run(spark, [("x/long.txt", long)] * 2 + [("x/LICENSE", MIT)] * 2)
    assert sorted((p, lic) for p, _, lic, *_ in got) == [("x/LICENSE", "MIT")] * 2 + [("x/long.txt", "GPL-3.0")] * 2
    assert run(spark, []) == []


def test_telling_terms_lose_nothing():
    weights = {t: 1.0 + i % 7 for i, t in enumerate(licences._VOCABULARY)}
    vectors = licences.template_vectors(weights)
    telling = set(licences.telling_terms(vectors, 0.6))
    for vector in vectors:
        assert math.sqrt(sum(v * v for t, v in vector.items() if t not in telling)) < 0.6


def test_scores_against_a_plain_cosine(spark):
    """Every line of every document is compared with every template."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    terms = {d.doc_id: licences._terms(d.text) for d in docs}
    df = Counter(t for ts in terms.values() for t in set(ts) if t in licences._VOCABULARY)
    idf = lambda t: math.log((1 + len(docs)) / (1 + df.get(t, 0))) + 1
    vectors = [{t: n * idf(t) for t, n in Counter(licences._terms(x)).items()} for _, x in licences.TEMPLATES]

    def cosine(a, b):
        size = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return sum(v * b.get(t, 0) for t, v in a.items()) / size if size else 0

    want = {}
    for d in docs:
        for part in [d.text, *d.text.split("\n")]:
            own = {t: n * idf(t) for t, n in Counter(licences._terms(part)).items()}
            for (name, _), vector in zip(licences.TEMPLATES, vectors, strict=True):
                score = round(cosine(own, vector), 6)
                if score >= licences.SIMILARITY:
                    want[d.doc_id] = min(want.get(d.doc_id, (0, "")), (-score, name))
    got = {r.doc_id: (-r.score, r.licence) for r in QUERIES["op2_licences"](spark, folder).collect() if r.origin == "own"}
    assert got == want and len(want) > 2


def test_columns_of_any_name_pass_through(spark):
    rows = [("a/LICENSE", MIT, 1, "f", "k", "x"), ("a/b/c.py", "code", 2, "g", "l", "y")]
    df = spark.createDataFrame(rows, "path string, text string, above int, folder string, key string, template string")
    got = {r.path: r for r in licences.scan_licences(df).collect()}
    assert got["a/b/c.py"].origin == "inherited" and got["a/b/c.py"].licensed_by == "a"
    assert [tuple(got[r[0]])[:6] for r in rows] == rows
