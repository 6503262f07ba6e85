"""Lines within one word edit of an earlier line, found through their deletion neighbourhoods.

A line's neighbourhood is the line itself and every line that lacks one of its words. Two lines within
one edit share a member of it. Members are first emitted as hashed keys that cost one subtraction each
(the sum of the word hashes less one of them), so a long line costs no more per word than a short one;
keys that only one line has go, and the members left are built and compared word for word. Lines that
share neither half with any other line cannot have such a partner and emit nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import discard, stored

#: Shorter lines must be equal: one edit is then more than a fifth of the line.
MIN_WORDS = 5
SPACE = "[\\x20\\x09-\\x0D]+"
_HASH_MASK = (1 << 40) - 1


_BLANKS = " \t\n\x0b\x0c\r"


def plain(line: Column) -> Column:
    """The words of a line with one space between them."""
    return F.regexp_replace(F.btrim(line, F.lit(_BLANKS)), SPACE, " ")


def _code(position: Column, line_hash: Column) -> Column:
    """A line of a document by its place and words."""
    return F.xxhash64(position.cast("bigint"), line_hash)


def _halves(words: Column, n: Column) -> Column:
    """Keys of both halves, for a partner that has as many words or more, and for a shorter one.

    One edit leaves one half of the shorter line as it is, and at its end of the longer line.
    """

    def key(side: int, shorter: Column) -> Column:
        half = F.floor(shorter / 2).cast("int")
        start = F.lit(1) if side == 0 else n - half + 1
        return F.xxhash64(F.lit(side), shorter, F.slice(words, start, half))

    return F.array(*[key(side, n - less) for side in (0, 1) for less in (0, 1)])


def distinct_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per distinct line that is not blank: its first place and, from ``min_words`` words on, its half keys."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc_id", "pos", plain(F.col("line")).alias("line")).filter("line <> ''")
    lines = lines.withColumn("words", F.split("line", " ")).withColumn("n", F.size("words"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos")
    halves = F.when(F.col("n") >= min_words, _halves(F.col("words"), F.col("n")))
    first = lines.groupBy(F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), "n").agg(
        F.min(place).alias("place"), F.first(halves).alias("halves")
    )
    return first.select("n", "h1", "place", "halves", F.monotonically_increasing_id().alias("line_id"))


def _with_partner(lines: DataFrame) -> DataFrame:
    """``line_id``, ``place``, ``n``, ``h1`` of the lines that share a half with another one."""
    halves = lines.select("line_id", F.explode("halves").alias("half"))
    shared = stored(halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("half"), "lines-halves")
    found = halves.join(shared, "half").select("line_id").distinct()
    found = stored(found.join(lines.select("line_id", "place", "n", "h1"), "line_id"), "lines-partners")
    discard(shared)
    return found


def _texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``lines`` with their ``words``, taken from the documents they first stand in."""
    held = F.collect_list(F.struct("line_id", "place", "n", "h1"))
    wanted = lines.groupBy(F.col("place.doc_id").alias("_doc")).agg(held.alias("wanted"))
    held = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")))
    all_lines = F.split("text", "\n")
    picked = F.inline(
        F.transform("wanted", lambda w: F.struct(w.line_id, w.place, w.n, w.h1, F.get("_lines", w.place.pos).alias("line")))
    )
    found = held.select("wanted", all_lines.alias("_lines")).select(picked)
    found = found.withColumn("line", plain(F.col("line")))
    # Of rows that repeat a doc_id, only those that hold the line itself can give it.
    found = found.filter(F.xxhash64("line") == F.col("h1")).dropDuplicates(["line_id"])
    return found.select("line_id", "place", "n", F.split("line", " ").alias("words"))


def _neighbourhood(lines: DataFrame) -> DataFrame:
    """``line_id``, ``i``, ``key``: the line itself at 0 and each line without its i-th word."""
    hashes = F.transform("words", lambda w: F.xxhash64(w).bitwiseAND(F.lit(_HASH_MASK)))
    held = lines.select("line_id", "n", hashes.alias("h"))
    total = F.aggregate("h", F.lit(0).cast("bigint"), lambda a, x: a + x)
    held = held.select("line_id", "n", "h", total.alias("total"))
    members = held.select("line_id", "n", "total", F.posexplode(F.concat(F.array(F.lit(0).cast("bigint")), "h")).alias("i", "x"))
    size = F.when(F.col("i") == 0, F.col("n")).otherwise(F.col("n") - 1)
    return members.select("line_id", "i", F.xxhash64(F.col("total") - F.col("x"), size).alias("key"))


def near_duplicates(lines: DataFrame) -> DataFrame:
    """``line_id`` of the lines (stored; ``line_id``, ``place``, ``n``, ``words``) one word edit from an earlier one."""
    members = _neighbourhood(lines)
    several = F.min("line_id") != F.max("line_id")
    shared = stored(members.groupBy("key").agg(several.alias("several")).filter("several").select("key"), "lines-keys")
    kept = members.join(shared, "key").groupBy("line_id").agg(F.collect_list("i").alias("kept"))

    def without(i: Column) -> Column:
        words, n = F.col("words"), F.col("n")
        rest = F.concat(F.slice(words, F.lit(1), F.greatest(i - 1, F.lit(0))), F.slice(words, i + 1, n))
        return F.unhex(F.md5(F.array_join(rest, " ").cast("binary")))

    whole = lines.join(kept, "line_id").select(
        "line_id", "place", "n", F.inline(F.transform("kept", lambda i: F.struct(i.alias("i"), without(i).alias("rest"))))
    )
    whole = stored(whole, "lines-members")
    lacking = whole.filter("i > 0")
    # The same words but for the one at the same place: one substitution.
    groups = lacking.groupBy("n", "i", "rest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c"))
    groups = stored(groups.filter("c > 1").drop("c"), "lines-groups")
    replaced = lacking.join(groups, ["n", "i", "rest"]).filter(F.col("place") > F.col("first")).select("line_id")
    # One line is the other without a word: the later of the two goes.
    longer = lacking.select("rest", F.col("line_id").alias("id1"), F.col("place").alias("place1"))
    shorter = whole.filter("i = 0").select("rest", F.col("line_id").alias("id2"), F.col("place").alias("place2"))
    later = F.when(F.col("place1") > F.col("place2"), F.col("id1")).otherwise(F.col("id2"))
    inserted = longer.join(shorter, "rest").select(later.alias("line_id"))
    found = stored(replaced.unionByName(inserted).distinct(), "lines-dropped")
    discard(shared, whole, groups)
    return found


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every line gone that equals, or is one word edit from, an earlier line; plus ``lines_removed``.

    An edit inserts, drops or replaces one word; words end at ASCII white space. Earlier means a smaller
    ``doc_id`` (null last), then an earlier line of the text; whether the earlier line itself stays does not
    matter. Lines of fewer than ``min_words`` words go only if their words are equal to an earlier line's; lines
    without a word stay. Rows are never dropped: a text may become empty. A null text stays null and removes
    0 lines. Rows with the same ``doc_id`` count as one document, whose lines at the same place are never earlier
    than each other, so repeated rows keep the same lines. Other columns pass through, but for one called
    ``lines_removed``.
    """
    lines = stored(distinct_lines(docs, min_words), "lines-distinct")
    partners = _with_partner(lines)
    candidates = stored(_texts(docs, partners), "lines-texts")
    dropped = near_duplicates(candidates)
    kept = lines.select("line_id", "place", "h1").join(dropped, "line_id", "left_anti")
    codes = F.collect_list(_code(F.col("place.pos"), F.col("h1"))).alias("_kept")
    kept = stored(kept.groupBy(F.col("place.doc_id").alias("_doc")).agg(codes), "lines-kept")
    discard(lines, partners, candidates, dropped)
    held = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").withColumn("_all", F.split("text", "\n"))

    def code(line: Column, at: Column) -> Column:
        return F.when(line != "", _code(at, F.xxhash64(line)))

    # Each step is named, as functions of an array's elements do not share work.
    held = held.withColumn("_plain", F.transform("_all", plain)).withColumn("_codes", F.transform("_plain", code))
    stay = lambda _, i: F.coalesce(F.array_contains("_kept", F.get("_codes", i)), F.get("_codes", i).isNull())
    held = held.withColumn("_left", F.filter("_all", stay))
    removed = F.coalesce(F.size("_all") - F.size("_left"), F.lit(0))
    text = F.when(F.col("text").isNotNull(), F.array_join("_left", "\n"))
    kept_columns = [c for c in docs.columns if c != "lines_removed"]
    return held.select(*[text.alias("text") if c == "text" else c for c in kept_columns], removed.alias("lines_removed"))


SQL = r"""
WITH lines AS (
    SELECT doc_id, pos, line, [w FOR w IN string_split_regex(line, '[\x20\x09-\x0D]+') IF w <> ''] AS words
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
firsts AS (
    SELECT words, len(words) AS n, min({'d': doc_id, 'p': pos}) AS place
    FROM lines WHERE len(words) > 0 GROUP BY words),
members AS (
    SELECT words, n, place, i,
           array_to_string(list_concat(words[1:greatest(i - 1, 0)], words[i + 1:]), ' ') AS rest
    FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM firsts WHERE n >= 5)),
substituted AS (
    SELECT words FROM (SELECT words, place, min(place) OVER (PARTITION BY n, i, rest) AS first FROM members WHERE i > 0)
    WHERE place > first),
inserted AS (
    SELECT CASE WHEN a.place > b.place THEN a.words ELSE b.words END AS words
    FROM members a JOIN members b ON a.rest = b.rest AND a.i > 0 AND b.i = 0 AND a.n = b.n + 1),
kept AS (
    SELECT place.d AS doc_id, place.p AS pos FROM firsts
    WHERE words NOT IN (SELECT words FROM substituted UNION SELECT words FROM inserted)),
marked AS (
    SELECT l.doc_id, l.pos, l.line, len(l.words) = 0 OR k.pos IS NOT NULL AS stays
    FROM lines l LEFT JOIN kept k ON l.doc_id = k.doc_id AND l.pos = k.pos)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '') AS text,
       CAST(count(*) FILTER (NOT stays) AS INTEGER) AS lines_removed
FROM marked GROUP BY doc_id
"""
