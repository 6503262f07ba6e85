"""How filters act on each other: what each removes in every order they can be applied in.

The states of the work are the subsets of filters already applied, and an edge of their lattice applies one
more. What an edge removes does not depend on the order in which its state was reached. So the edges are
measured once, from the counts of rows per set of failed filters; counting the orders that reach an edge's
lower state (forward) and leave its upper one (backward) gives its weight in the Shapley sums, and the steps of
every order are read from the same edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.llm.common import stored
from tractline.session import spread_unless

_SEPARATORS = "[\\x20\\x09-\\x0D]+"
#: Rows that fail each filter but E: these are fixed values of the audit.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 50, 65, 5, "[#$%&*|]"
LETTERS = "ABCDE"


def text_failures(text: Column) -> list[Column]:
    """Whether a text (not null) has too few words, too few distinct ones, too many capitals, or odd marks."""
    words = F.array_remove(F.split(text, _SEPARATORS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        n < MIN_WORDS,
        distinct.cast("bigint") * 100 < n.cast("bigint") * DISTINCT_PERCENT,
        capitals.cast("bigint") * 100 > F.char_length(text).cast("bigint") * CAPITAL_PERCENT,
        text.rlike(MARKS),
    ]


def failed_filters(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part`` and ``failed`` (a bit per filter, A the lowest) of every row of ``docs``.

    A null ``text`` or ``source`` is the empty string. E is failed by a row whose text a smaller ``doc_id`` has
    anywhere in ``docs``; rows of equal id and text do not fail it for each other, and null ids neither fail it
    nor make others fail. Texts are compared by SHA-256, so only digests are shuffled, and groups of equal
    texts are pre-aggregated.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text))]
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("failed"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    rows = stored(rows, "audit-rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    failed = F.col("failed") + F.when(later, 1 << 4).otherwise(0)
    return rows.join(firsts, "digest", "left").select("doc_id", "part", failed.alias("failed"))


def lattice(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders through it) for every edge of the lattice of ``n`` filters; 2**n states."""
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for state in range(1, 1 << n):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in reversed(range((1 << n) - 1)):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return [
        (state, f, forward[state] * backward[state | 1 << f])
        for state in range(1 << n)
        for f in range(n)
        if not state >> f & 1
    ]


def _edges(spark: SparkSession, n: int) -> DataFrame:
    """The edges at whose lower state a row with these failed filters is still there; 2 x n x 3**(n-1) rows."""
    rows = [
        (failed, state, f, failed >> f & 1, orders)
        for failed in range(1 << n)
        for state, f, orders in lattice(n)
        if not failed & state
    ]
    return spark.createDataFrame(rows, "failed int, state int, filter int, fails int, orders bigint")


def _steps(spark: SparkSession, letters: str) -> DataFrame:
    """The edge that each step of each order takes; orders are numbered from 0."""
    rows = [
        (number, "".join(letters[f] for f in order), step + 1, sum(1 << f for f in order[:step]), f)
        for number, order in enumerate(permutations(range(len(letters))))
        for step, f in enumerate(order)
    ]
    return spark.createDataFrame(rows, "number int, filter_order string, step int, state int, filter int")


def audit(rows: DataFrame, letters: str = LETTERS, lost: Sequence[str] = ()) -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``rows`` has ``part``, ``failed`` (a bit per letter) and the boolean columns named in ``lost``; it is
    reduced to counts per part and set of failed filters before anything else. There is one result row per
    part, order and step, zeros included: ``kept``, ``removed``, ``redundant``, ``unique_fails``, for each of
    ``lost`` the removed rows for which it is true, and ``shapley``, the filter's ``removed`` summed over all
    orders. Orders number ``len(letters)`` factorial, so filters must be few (seven give 5,040 orders).
    """
    spark, n = rows.sparkSession, len(letters)
    flags = [F.sum(F.when(F.col(c), 1).otherwise(0)).alias(c) for c in lost]
    sets = stored(rows.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), *flags), "audit-sets")
    met = sets.join(F.broadcast(_edges(spark, n)), "failed")
    edges = met.groupBy("part", "state", "filter", "orders").agg(
        F.sum("n").alias("there"), *[F.sum(F.col(c) * F.col("fails")).alias(c) for c in ("n", *lost)]
    )
    edges = stored(edges.withColumnRenamed("n", "removed"), "audit-edges")
    bits = F.sequence(F.lit(0), F.lit(n - 1))
    own = sets.select("part", "failed", "n", F.explode(bits).alias("filter"))
    own = own.withColumn("bit", F.call_function("shiftleft", F.lit(1), F.col("filter")))
    own = own.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) > 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    )
    weighed = edges.groupBy("part", "filter").agg(F.sum(F.col("orders") * F.col("removed")).alias("shapley"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("number")
    steps = sets.select("part").distinct().select("part", numbers).join(F.broadcast(_steps(spark, letters)), "number")
    found = (
        steps.join(edges, ["part", "state", "filter"], "left")
        .join(own, ["part", "filter"])
        .join(weighed, ["part", "filter"])
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return found.select(
        "part",
        "filter_order",
        "step",
        (zero("there") - zero("removed")).alias("kept"),
        zero("removed").alias("removed"),
        (F.col("fails") - zero("removed")).alias("redundant"),
        "unique_fails",
        *[zero(c).alias(c) for c in lost],
        "shapley",
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters on ``docs`` (``doc_id``, ``text``, ``source``), with good and toxic rows lost.

    A document is good or toxic if any row of ``labels`` (``doc_id``, ``quality``, ``toxic``) with its id says 1;
    null ids have no label. Repeated rows count as rows of their own. No documents, no parts: an empty result.
    Other columns are not read.
    """
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good_lost"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic_lost"),
    )
    rows = failed_filters(docs)
    rows = rows.withColumn("_spread", spread_unless(F.col("doc_id").isNotNull(), rows))
    rows = rows.join(marks.withColumn("_spread", F.lit(0)), ["doc_id", "_spread"], "left")
    return audit(rows, LETTERS, ["good_lost", "toxic_lost"])


SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), failures AS (
    SELECT part, [
        len(w) < 50,
        100 * len(list_distinct(w)) < 65 * len(w),
        100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > first_id, false)
    ] AS fails, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
    FROM words LEFT JOIN marks USING (doc_id)
), sets AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failures GROUP BY part, fails
), orders AS (
    SELECT [a, b, c, d, e] AS o
    FROM range(1, 6) t1(a), range(1, 6) t2(b), range(1, 6) t3(c), range(1, 6) t4(d), range(1, 6) t5(e)
    WHERE len(list_distinct([a, b, c, d, e])) = 5
), steps AS (
    SELECT array_to_string([substr('ABCDE', x::INT, 1) FOR x IN o], '') AS filter_order, s::INT AS step, o[s] AS f, o[1:s - 1] AS before
    FROM orders, range(1, 6) t(s)
), taken AS (
    SELECT part, filter_order, step, f,
        fails[f] AS hit,
        len([x FOR x IN before IF fails[x]]) = 0 AS there,
        len([x FOR x IN [1, 2, 3, 4, 5] IF fails[x]]) AS all_fails, n, good, bad
    FROM sets, steps
), counted AS (
    SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (there AND NOT hit), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (there AND hit), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (NOT there AND hit), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (hit AND all_fails = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (there AND hit), 0)::BIGINT AS good_lost,
        coalesce(sum(bad) FILTER (there AND hit), 0)::BIGINT AS toxic_lost
    FROM taken GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
