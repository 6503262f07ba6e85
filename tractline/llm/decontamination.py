"""Documents that hold passages of benchmark items, found through spaced seeds.

A seed is the hash of the words under a mask of fixed places; the places a mask ignores may differ. The
masks together meet every pattern of differing words up to a fifth of a window, so the join of document
seeds with item seeds misses nothing; each hit fixes how item and document lie on each other, and the
words around it are then counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import stored
from tractline.session import broadcast_within

#: With these, no placing of floor(L / 5) differing words in any window of L = 8 to 20 words avoids a hit.
MASKS = ("111011", "11001011", "11111")
WINDOW = 20
SIMILARITY = 0.8
#: Items of fewer words are never searched for; items of up to 7 words must be found unchanged.
MIN_WORDS, WHOLE = 5, 8
_BROADCAST_SEEDS = 1_000_000
_SPAN = max(map(len, MASKS))


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ``at`` and ``seed`` for every place and mask of the column ``words``."""
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    held = rows.select(*keep, hashes.alias("h")).withColumn("h", F.concat("h", F.array(F.lit(None).cast("bigint"))))
    shifted = [F.slice("h", i + 1, F.greatest(F.size("h") - i, F.lit(0))).alias(f"w{i}") for i in range(_SPAN)]
    places = held.select(*keep, *shifted)
    places = places.select(*keep, F.posexplode(F.arrays_zip(*[f"w{i}" for i in range(_SPAN)])).alias("at", "w"))
    seeds = []
    for number, mask in enumerate(MASKS):
        chosen = [F.col("w")[f"w{i}"] for i, bit in enumerate(mask) if bit == "1"]
        seeds.append(F.when(chosen[-1].isNotNull(), F.xxhash64(F.lit(number), *chosen)))
    return places.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed")).filter("seed IS NOT NULL")


def _best_window(words: Column, item: Column, start: Column) -> Column:
    """The most equal words in any window of the item laid on the document at ``start``."""
    n = F.size(item)
    width = F.least(n, F.lit(WINDOW))
    equal = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda k: F.when((start + k >= 0) & (F.get(words, start + k) == F.get(item, k)), F.lit(1)).otherwise(F.lit(0)),
    )
    sums = F.transform(
        F.sequence(F.lit(1), n - width + 1),
        lambda s: F.aggregate(F.slice(equal, s, width), F.lit(0), lambda a, x: a + x),
    )
    return F.array_max(sums)


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document, item and way the item lies in the document, where they agree.

    Columns: ``doc_id``, ``item_id``, ``start`` (the document word, from 0, under the item's first word;
    negative if the document begins inside the item), ``window`` (words compared: 20, or the whole of a
    shorter item), ``matches`` (equal words in the best window) and ``similarity``, 0.8 or more. Words are
    lower-case runs of letters and digits. Null and empty texts and items match nothing. Rows that repeat
    a ``doc_id`` or ``item_id`` are one document or item, whose best match counts. Null ids are kept as ids.
    Other columns are not read.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") >= MIN_WORDS)
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "leak-items")
    item_seeds = stored(_seeds(items, "item").select("item", F.col("at").alias("k"), "seed"), "leak-seeds")
    if item_seeds.count() <= _BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    hits = _seeds(texts, "doc_id").join(item_seeds, "seed")
    hits = hits.select("doc_id", "item", (F.col("at") - F.col("k")).alias("start")).distinct()

    hits = stored(hits, "leak-hits").join(items.withColumnRenamed("words", "item_words"), "item")
    placed = F.struct("item_id", "start", "item_words")
    by_doc = hits.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(placed).alias("hits"))
    # Few documents have hits; while their ids are few enough to be sent around, no other text is shuffled.
    asked = broadcast_within(hits.select(F.col("doc_id").alias("_hit")).distinct())
    held = docs.select("doc_id", "text").join(asked, F.col("doc_id").eqNullSafe(F.col("_hit")), "left_semi")
    held = held.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_doc")))
    held = held.select("doc_id", "hits", words_of(F.col("text")).alias("words"))
    scored = F.transform(
        "hits",
        lambda h: F.struct(
            h.item_id.alias("item_id"),
            h.start.alias("start"),
            F.least(F.size(h.item_words), F.lit(WINDOW)).alias("window"),
            _best_window(F.col("words"), h.item_words, h.start).alias("matches"),
        ),
    )
    found = held.select("doc_id", F.inline(scored))
    least = F.when(F.col("window") < WHOLE, F.col("window")).otherwise(F.ceil(F.col("window") * SIMILARITY))
    found = found.filter(F.col("matches") >= least)
    found = found.groupBy("doc_id", "item_id", "start", "window").agg(F.max("matches").alias("matches"))
    return found.withColumn("similarity", F.col("matches") / F.col("window"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of ``benchmark``; all their columns stay."""
    leaks = broadcast_within(find_passages(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct())
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")


SQL = r"""
WITH doc_words AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS p
    FROM (SELECT doc_id, [w FOR w IN string_split_regex(lower(text), '[^\p{L}\p{N}]+') IF w <> ''] AS words FROM documents)),
items AS (
    SELECT item_id, words, len(words) AS n, least(len(words), 20) AS width
    FROM (SELECT item_id, [w FOR w IN string_split_regex(lower(text), '[^\p{L}\p{N}]+') IF w <> ''] AS words FROM benchmark)
    WHERE len(words) >= 5),
item_words AS (SELECT item_id, width, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS k FROM items),
equal AS (
    SELECT doc_id, item_id, width, p - k AS start, k
    FROM doc_words JOIN item_words USING (w)),
enough AS (
    SELECT doc_id, item_id, start FROM equal GROUP BY doc_id, item_id, start, width HAVING count(*) >= 0.8 * width),
windows AS (
    SELECT doc_id, item_id, start, width,
           count(*) OVER (PARTITION BY doc_id, item_id, start ORDER BY k RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS c
    FROM equal JOIN enough USING (doc_id, item_id, start))
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(width AS INTEGER) AS window,
       CAST(max(c) AS INTEGER) AS matches, max(c) / width AS similarity
FROM windows GROUP BY doc_id, item_id, start, width
HAVING max(c) >= CASE WHEN width < 8 THEN width ELSE ceil(width * 0.8) END
"""
