"""Toxicity of whole texts after a noisy-channel restoration of disguised words.

A word that is written with digits or signs, stretched or spaced out spans a lattice: every sign
offers the letters it may stand for, a repeated letter or a separator may be nothing. A character
trigram model of the whole corpus and Viterbi's search choose the spelling. Words and word beginnings
that labelled toxic documents use far more often than clean ones then make the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import stored

#: Labelled documents per class, picked by a hash of the id, that the word weights are learned from.
SAMPLE = 10_000
_CACHE = 400_000

# What a sign may stand for.
_SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "*": "aeiou",
}
# Letters a to z are 1 to 26; a word's edge is 0 and any other letter 27.
_EDGE, _OTHER, _SIZE = 0, 27, 28
_NOTHING, _REPEAT, _SPLIT, _SIGN = -0.2, -0.4, -3.0, -1.0
_ODD = re.compile(r"[^\W\d_][^\w\s'’]+\w|[^\W\d_]\d|\d[^\W\d_]|[@$!|+€£¡][^\W_]|[^\W_][$@!|+€£¡]{1,2}$|([^\W\d_])\1\1|_")
# A letter is no separator, so a row of separators can be read in one way only.
_SPACED = re.compile(r"(?<!\S)(?:[^\s.\-_][ \t.\-_]{1,3}){2,}[^\s](?!\S)")
_DOUBLE = re.compile(r"(.)\1+")
_EDGES = ".,;:?\"'`’“”()[]{}<>«»#%&*~^=/\\-_"


def _index(text: str) -> np.ndarray:
    """Every character of lower-case text as a letter of the model; what is no letter is an edge."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    plain = (codes >= 97) & (codes <= 122)
    letters = np.where(plain, codes - 96, np.where(codes >= 0xC0, _OTHER, _EDGE))
    return letters.astype(np.int64)


def _trigrams(text: str) -> np.ndarray:
    x = np.concatenate([[_EDGE, _EDGE], _index(text), [_EDGE]])
    return (x[:-2] * _SIZE + x[1:-1]) * _SIZE + x[2:]


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each trigram of the model's letters stands in all texts; 28 x 28 x 28 numbers at most."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    total += np.bincount(_trigrams(text.as_py().lower()), minlength=_SIZE**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(scan, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(_SIZE**3)
    for row in rows.collect():
        counts[row["gram"]] = row["n"]
    return counts.reshape(_SIZE, _SIZE, _SIZE)


def log_model(counts: np.ndarray) -> list:
    """Log probability of a letter after two others, trigrams mixed with bigrams and single letters."""
    single = counts.sum((0, 1)) + 1
    pair = counts.sum(0)
    low = single / single.sum()
    mid = (pair + 5 * low) / (pair.sum(1, keepdims=True) + 5)
    high = (counts + 5 * mid) / (counts.sum(2, keepdims=True) + 5)
    return np.log(high).tolist()


def _lattice(text: str) -> list[list[tuple[int, str, float]]]:
    """The choices at each character: the model's letter (-1: nothing), what is written, the cost."""
    steps, last = [], ""
    for c in text:
        if c == last and c.isalpha():
            steps.append([(-1, "", _REPEAT), (_letter(c), c, 0.0)])
        elif c.isalpha():
            steps.append([(_letter(c), c, 0.0)])
        elif c in _SIGNS:
            choices = [(_letter(x), x, _SIGN) for x in _SIGNS[c]]
            steps.append(choices + [(-1, "", _SPLIT)] if c == "*" or c == last else choices)
        else:
            steps.append([(-1, "", _NOTHING), (_EDGE, " ", _SPLIT)])
        last = c
    return steps


def _letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER


def restore(text: str, model: list) -> str:
    """The likeliest spelling of a disguised word or of letters with gaps (lower case)."""
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(_EDGE, _EDGE): (0.0, ())}
    for choices in _lattice(text):
        further: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, spelled) in paths.items():
            for letter, written, cost in choices:
                if letter < 0:
                    state, value, path = (a, b), score + cost, spelled
                elif letter == _EDGE and b == _EDGE:
                    continue
                else:
                    state, value, path = (b, letter), score + cost + model[a][b][letter], (spelled, written)
                if state not in further or value > further[state][0]:
                    further[state] = (value, path)
        paths = further or paths
    _, path = max((score + model[a][b][_EDGE], i, path) for i, ((a, b), (score, path)) in enumerate(paths.items()))[1:]
    letters = []
    while path:
        path, written = path
        letters.append(written)
    return "".join(reversed(letters))


def _words(token: str, model: list) -> Iterable[str]:
    """The words that a token without white space stands for."""
    core = token.strip(_EDGES)
    # Three or more equal signs at an end are decoration.
    core = re.sub(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$", "", core).strip(_EDGES)
    if not core:
        return ()
    core = core.rstrip("!")
    return {core, *restore(core, model).split()} if _ODD.search(core) else (core,)


def _features(word: str) -> Iterator[str]:
    word = _DOUBLE.sub(r"\1", word.strip("!|+@$€£¡"))
    if len(word) > 2:
        yield word
        for size in (4, 5, 6, 7, 8):
            if len(word) > size:
                yield word[:size] + "-"


def _restored(text: str, model: list, known: dict[str, tuple[str, ...]]) -> Iterator[str]:
    """Distinct restored words of a text; ``known`` keeps what single tokens stand for."""
    lowered = text.lower()
    if len(known) > _CACHE:
        known.clear()
    for token in set(lowered.split()):
        words = known.get(token)
        if words is None:
            words = known[token] = tuple(_words(token, model))
        yield from words
    for run in _SPACED.finditer(lowered):
        # A word of one letter may stand right before or behind.
        for spaced in (run[0], run[0][1:].strip(" \t.-_"), run[0][:-1].strip(" \t.-_")):
            yield from restore(spaced, model).split()


def _family(text: str) -> int:
    """Near copies of a text mostly share this: the least hash of its three-word runs."""
    words = text.lower().split()
    runs = zip(words, words[1:] or [""], words[2:] or [""], strict=False)
    return min((xxhash.xxh64_intdigest(" ".join(r)) for r in runs), default=0) >> 1


def lexicon(docs: DataFrame, labels: DataFrame, model: list, sample: int = SAMPLE) -> dict[str, float]:
    """Words and beginnings with the probability that a document with them is toxic, where over a half.

    ``labels`` are the rows to learn from. About ``sample`` documents of each class are used, families
    of near copies once. A document with several labels is toxic if one says so.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
    part = F.when(F.col("toxic") == 1, sample / n_toxic).otherwise(sample / n_clean)
    picked = docs.select("doc_id", "text").filter("text IS NOT NULL")
    picked = picked.join(F.broadcast(known.filter(drawn < part * 1_000_000)), "doc_id")

    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([_family(t.as_py()) for t in batch.column(0)], pa.int64())
            yield pa.record_batch([*batch.columns, names], names=["text", "toxic", "family"])

    rows = picked.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(families, "text string, toxic int, family bigint")
    rows = stored(rows.dropDuplicates(["toxic", "family"]), "toxic-sample")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[str, ...]] = {}
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            numbers = [pa.array([c[k] for k in keys], pa.int64()) for c in counts]
            return pa.record_batch([pa.array(keys, pa.string()), *numbers], names=["feature", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                found = {f for w in _restored(text.as_py(), model, seen) for f in _features(w)}
                counts[toxic.as_py() == 1].update(found)
                if len(counts[0]) > _CACHE:
                    yield out()
                    counts[0].clear(), counts[1].clear()
        yield out()

    used = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    counted = rows.select("text", "toxic").mapInArrow(features, "feature string, clean bigint, toxic bigint")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Both rates are moved by two standard errors to the clean side.
    rate = (F.col("toxic") - 2 * F.sqrt("toxic")) / used.get(1, 1) * (n_toxic / (n_toxic + n_clean))
    other = (F.col("clean") + 2 * F.sqrt(F.col("clean") + 1)) / used.get(0, 1) * (n_clean / (n_toxic + n_clean))
    weighed = counted.filter("toxic > 4").select("feature", "toxic", (rate / (rate + other)).alias("p")).filter("p > 0.5")
    # The sample bounds how many words there are.
    best = weighed.collect()
    # A beginning counts only where no single word stands behind most of its documents.
    most: dict[str, int] = {}
    for row in best:
        for start in _features(row["feature"]) if not row["feature"].endswith("-") else ():
            most[start] = max(most.get(start, 0), row["toxic"])
    alone = {r["feature"] for r in best if r["feature"].endswith("-") and most.get(r["feature"], 0) > 0.7 * r["toxic"]}
    return {r["feature"]: r["p"] for r in best if r["feature"] not in alone}


def score_text(text: str | None, model: list, words: dict[str, float], base: float, known: dict, values: dict) -> float:
    """One less the chance that no word of the text is toxic; ``base`` where no word is known as toxic."""
    clean, hit = 1.0, False
    for word in set(_restored(text, model, known)) if text else ():
        p = values.get(word)
        if p is None:
            if len(values) > _CACHE:
                values.clear()
            p = values[word] = max((words.get(f, 0.0) for f in _features(word)), default=0.0)
        if p:
            clean, hit = clean * (1 - p), True
    return 1 - clean if hit else base


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list, dict[str, float]]:
    """The character model of all texts and the word weights."""
    model = log_model(character_counts(docs))
    return model, lexicon(docs, labels, model, sample)


_BASE = 0.05


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` (1 from a score of 0.5 on) of every row of ``docs``.

    Scores come from the text alone; ``labels`` (``doc_id``, ``toxic``) only make the word weights. Null
    and empty texts, and texts without a known toxic word, have the score 0.05. Without labels of both
    classes no word is known. Repeated rows have equal results. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    model, words = fit(docs, labels, sample)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        values: dict[str, float] = {}
        for batch in batches:
            scores = [score_text(t.as_py(), model, words, _BASE, known, values) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(scan, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more; all columns stay."""
    model, words = fit(docs, labels, sample)
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        values: dict[str, float] = {}
        for batch in batches:
            clean = [score_text(t.as_py(), model, words, _BASE, known, values) < 0.5 for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
