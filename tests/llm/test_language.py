from collections import Counter

from pyspark.sql import functions as F

from tractline.llm import language
from tractline.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, score int"


def plain_profile(texts, ranks=300):
    counts = Counter()
    for text in texts:
        letters = [ord(c) if c.isalpha() else 0 for c in "\0" + text.lower() + "\0"]
        for i, c in enumerate(letters):
            if c:
                counts[c] += 1
            if i and (c or letters[i - 1]):
                counts[letters[i - 1] << 18 | c | 1 << 60] += 1
            if 0 < i < len(letters) - 1 and c:
                counts[letters[i - 1] << 36 | c << 18 | letters[i + 1] | 1 << 61] += 1
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:ranks]]


def plain_predict(text, profiles, ranks=300):
    if not text or not any(c.isalpha() for c in text) or not profiles:
        return "und", 0.0
    own = plain_profile([text], ranks)
    apart = {
        lang: sum(abs(p.index(g) - i) if g in p else ranks for i, g in enumerate(own)) for lang, p in sorted(profiles.items())
    }
    best = min(apart, key=lambda lang: (apart[lang], lang))
    return best, 1 - apart[best] / (len(own) * ranks)


def test_against_a_plain_version(spark):
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", 1), (2, "Der schnelle braune Fuchs springt über den Hund", "de", 1),
        (3, "Le renard brun saute par-dessus le chien", "fr", 1), (4, None, "en", 1), (5, "", "fr", 1), (6, "123 !!", None, 1),
        (7, "the dog", None, 1), (8, "ÜBER DEN", None, 1), (None, "le chien", None, 1), (9, "x" * 100_000 + " the", None, 1),
        (7, "the dog", None, 1), (10, "日本語のテキスト", None, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    known = {}
    for _, text, lang, _ in rows:
        if text is not None and lang:
            known.setdefault(lang, []).append(text)
    profiles = {lang: plain_profile(texts) for lang, texts in known.items()}
    got = language.identify(df, df).collect()
    want = sorted((str(i), *plain_predict(t, profiles)) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.lang_pred, r.score) for r in got) == want
    nothing = language.identify(df, df.filter("false")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == len(rows)
    assert language.identify(df.filter("false"), df).collect() == []


def test_held_out_accuracy_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_language_id"](spark, folder).join(docs, "doc_id")
    assert got.count() == docs.count() and got.filter("score NOT BETWEEN 0 AND 1").isEmpty()
    held = got.filter("held_out")
    assert held.filter("lang_pred = lang").count() >= 0.98 * held.count() > 100
    assert held.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).isEmpty()
