"""Language of whole texts by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of one to three letters by rank. A text gets the language
from whose profile its own list is least out of place: each n-gram adds the difference of its ranks, or
the greatest difference if the language does not list it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractline.llm.common import share, stored

#: N-grams in a profile.
RANKS = 300
#: Only this many languages, the most frequent ones, have a profile.
LANGUAGES = 1000
_SALTS = 32
_CHUNK = 1_000_000
_UNKNOWN = "und"
#: No letter of Unicode lies beyond its first four planes.
_BITS = 18


def _letters(text: str) -> np.ndarray:
    """Code points of lower-case letters; 0 stands for anything between words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    distinct, at = np.unique(codes, return_inverse=True)
    kept = np.array([c if c < 1 << _BITS and chr(c).isalpha() else 0 for c in distinct.tolist()], dtype=np.int64)
    return np.concatenate([[0], kept[at], [0]]) if len(codes) else np.zeros(2, np.int64)


def grams(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three, as numbers, and their counts. A word's edges count as a letter."""
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    single = b[b > 0]
    pairs = (letters[:-1] << _BITS | letters[1:])[(letters[:-1] > 0) | (letters[1:] > 0)]
    triples = (a << 2 * _BITS | b << _BITS | c)[b > 0]
    return np.unique(np.concatenate([single, pairs | 1 << 60, triples | 1 << 61]), return_counts=True)


def ranking(values: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent n-grams in order, smaller numbers first where counts are equal."""
    return values[np.lexsort((values, -counts))[:ranks]]


def profiles(docs: DataFrame, ranks: int = RANKS) -> dict[str, np.ndarray]:
    """The profile of each language in ``docs`` (``text``, ``lang``), counted over all its texts.

    To the driver come at most ``ranks`` x 32 n-grams for each of at most 1000 languages.
    """
    docs = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> None:
            values, counts = grams(np.concatenate(waiting.pop(lang)))
            if lang in totals:
                values = np.concatenate([totals[lang][0], values])
                counts = np.concatenate([totals[lang][1], counts])
                values, at = np.unique(values, return_inverse=True)
                counts = np.bincount(at, weights=counts).astype(np.int64)
            totals[lang], sizes[lang] = (values, counts), 0

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                name, letters = lang.as_py(), _letters(text.as_py())
                waiting.setdefault(name, []).append(letters)
                sizes[name] = sizes.get(name, 0) + len(letters)
                if sizes[name] > _CHUNK:
                    flush(name)
        for name in list(waiting):
            flush(name)
        for name, (values, counts) in totals.items():
            yield pa.record_batch([pa.array([name] * len(values), pa.string()), values, counts], names=["lang", "gram", "n"])

    frequent = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    counted = docs.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stored(counted.join(F.broadcast(frequent), "lang"), "language-grams").withColumn("salt", share("gram", of=_SALTS))
    best = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "gram"))
    rows = counted.withColumn("rank", best).filter(F.col("rank") <= ranks).select("lang", "gram", "n").toPandas()
    return {
        lang: ranking(group["gram"].to_numpy(), group["n"].to_numpy(), ranks)
        for lang, group in rows.groupby("lang", sort=True)
    }


def predict(text: str | None, known: list[tuple[str, np.ndarray, np.ndarray]], ranks: int = RANKS) -> tuple[str, float]:
    """Language and score: one less the distance over the greatest distance there can be."""
    letters = _letters(text) if text else np.zeros(2, np.int64)
    if not letters.any() or not known:
        return _UNKNOWN, 0.0
    own = ranking(*grams(letters), ranks)
    rank = np.arange(len(own))
    best = (_UNKNOWN, len(own) * ranks + 1)
    for lang, values, places in known:
        at = np.minimum(np.searchsorted(values, own), len(values) - 1)
        apart = np.where(values[at] == own, np.abs(places[at] - rank), ranks)
        if apart.sum() < best[1]:
            best = (lang, int(apart.sum()))
    return best[0], 1 - best[1] / (len(own) * ranks)


def identify(docs: DataFrame, learn: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row of ``docs``, from its whole text alone.

    ``learn`` has ``text`` and ``lang``; rows with a null in either are not used. Equal distances give the
    first language by name. A text that is null or has no letter is ``und`` with score 0, and so is every
    text if there is nothing to learn from. Repeated rows have equal results; other columns are not read.
    """
    known = []
    for lang, values in sorted(profiles(learn, ranks).items()):
        order = np.argsort(values)
        known.append((lang, values[order], order))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(text.as_py(), known, ranks) for text in batch.column(1)]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.record_batch([batch.column(0), langs, scores], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, lang_pred string, score double")
