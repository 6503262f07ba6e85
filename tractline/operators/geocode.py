"""Addresses to coordinates: a blocked fuzzy join with the caller's address points.

The rules are ours. An address can only match a point of the same region (ZIP code, or whole city and
state where the ZIP is blank) whose text begins with the same house number and holds the same
numbers: another numbered street is no misspelling. Units are left out on both sides. The score is one
minus the edit distance over the longer length, and scores under the threshold are rejected. Nothing else
keeps a pair apart, so the threshold alone decides what is too far off. In crowded blocks only pairs with an
equal segment are compared, which loses none that could win.

A whole address in one column does not mark where its city begins. Without a ZIP, its city and state are
the longest of the points' own city and state names that it ends with.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.functions.text import (
    compose_multi,
    compose_single,
    is_blank,
    match_form,
    null_to_blank,
    without_unit,
    zip5,
    zip_before_dot,
)
from tractline.operators.near_streets import CROWDED, FEW_EDITS, budget, nothing_better, pairs_within
from tractline.schemas import ADDRESS_PARTS, ADDRESS_POINTS, require
from tractline.session import broadcast_within, computed_once, no_spread, shuffled, spread_unless, stored

DEFAULT_THRESHOLD = 0.7
#: Below this threshold crowded blocks are compared pair by pair too.
LEAST_INDEXED = 0.5
_ANSWER = (
    "latitude",
    "longitude",
    "matched_street",
    "matched_city",
    "matched_state",
    "matched_zip",
    "score",
    "precision",
)


def _known(part: Column) -> Column:
    """Match form of an address part, blank when the part stands for a missing value."""
    return F.when(is_blank(part), "").otherwise(match_form(null_to_blank(part)))


def _street(part: Column) -> Column:
    return F.when(is_blank(part), "").otherwise(match_form(without_unit(null_to_blank(part))))


def _zip5(zip_code: Column) -> Column:
    return zip5(_known(zip_before_dot(zip_code)))


def _numbers(text: Column) -> Column:
    """The numbers of a text that begins with a house number, else NULL."""
    return F.when(text.rlike(r"^\d+\b"), F.array_join(F.regexp_extract_all(text, F.lit(r"(\d+)")), " "))


def _zip_region(zip_code: Column) -> Column:
    return F.concat(F.lit("z:"), zip_code)


def _place(city: Column, state: Column) -> Column:
    return F.concat(city, F.lit(" "), state)


def _city_region(place: Column) -> Column:
    return F.concat(F.lit("c:"), place)


def gazetteer(address_points: DataFrame) -> DataFrame:
    """``place``: every city and state that address points lie in, in match form, once."""
    named = address_points.select(_known(F.col("city")).alias("_city"), _known(F.col("state")).alias("_state"))
    named = named.where((F.col("_city") != "") & (F.col("_state") != ""))
    return named.select(_place(F.col("_city"), F.col("_state")).alias("place")).distinct()


def places_at_end(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``_text`` and ``_place`` of each distinct ``_text`` that ends with a known place: the longest one.

    Every run of last words a text has, up to the length of the longest known name, meets the names by an
    equal join; a text is more than its place.
    """
    words = places.agg(F.coalesce(F.max(F.size(F.split("place", " "))), F.lit(0))).first()[0]
    if words == 0:
        return texts.select("_text", F.lit(None).cast("string").alias("_place")).where(F.lit(False))
    lengths = F.sequence(F.lit(2), F.lit(max(words, 2)))
    ends = texts.select("_text").distinct().withColumn("_words", F.split("_text", " "))
    ends = ends.withColumn("_n", F.explode(lengths)).where(F.col("_n") < F.size("_words"))
    ends = ends.select("_text", F.call_function("substring_index", "_text", F.lit(" "), -F.col("_n")).alias("place"))
    found = shuffled(ends).join(broadcast_within(places), "place").groupBy("_text")
    return found.agg(F.max_by("place", F.length("place")).alias("_place"))


def query_keys(asked: DataFrame, n_columns: int, places: DataFrame | None = None) -> DataFrame:
    """Region, numbers and comparison texts of raw addresses in ``_k0``, ``_k1``, ...

    Four columns are street, city, state and ZIP, one is a whole address, which needs the ``gazetteer``.
    Addresses with nothing to look up by have no row. Each step is named before it is used more than once.
    """
    if n_columns == 1:
        zip_end = r" (\d{3,5})( \d{4})?$"
        staged = asked.withColumn("_whole", match_form(compose_single(without_unit(F.col("_k0"))))).withColumns(
            {
                "_zip": zip5(F.regexp_extract("_whole", zip_end, 1)),
                "_text": F.regexp_replace("_whole", zip_end, ""),
                "_street": F.lit(""),
            }
        )
        staged = computed_once(staged.drop("_whole"), {c: F.col(c) for c in ("_zip", "_text")})
        # Texts with a ZIP, or that do not begin with a number, have no use for a place.
        open_ = (F.col("_zip") == "") & _numbers(F.col("_text")).isNotNull()
        ends = places_at_end(staged.where(open_), places).withColumn("_spread", no_spread("_text"))
        staged = staged.withColumn("_spread", spread_unless(open_, asked)).join(ends, ["_text", "_spread"], "left")
        place, numbered = _city_region(F.col("_place")), F.col("_text")
    else:
        street, city, state, zip_code = (F.col(f"_k{i}") for i in range(4))
        staged = asked.withColumns(
            {
                "_street": _street(street),
                "_city": _known(city),
                "_state": _known(state),
                "_zip": _zip5(zip_code),
                "_text": F.lit(""),
            }
        )
        has_city = (F.col("_city") != "") & (F.col("_state") != "")
        place, numbered = F.when(has_city, _city_region(_place(F.col("_city"), F.col("_state")))), F.col("_street")
    keys = {
        "_region": F.when(F.col("_zip") != "", _zip_region(F.col("_zip"))).otherwise(place),
        "_numbers": _numbers(numbered),
        "_text": F.col("_text"),
        "_street": F.col("_street"),
    }
    return (
        computed_once(staged, keys)
        .where(F.col("_region").isNotNull() & F.col("_numbers").isNotNull())
        .select(*asked.columns, "_region", "_numbers", "_text", "_street")
    )


def _point_keys(points: DataFrame, n_columns: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each address point under both of its regions.

    Copies of a point keep the smallest id. ``carry`` names further point columns to keep.
    """
    require(points.columns, ADDRESS_POINTS.names, "address points")
    keyed = points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumns(
        {
            "_p_street": _street(F.col("street")),
            "_city": _known(F.col("city")),
            "_state": _known(F.col("state")),
            "_zip": _zip5(F.col("zip")),
        }
    )
    keyed = keyed.withColumn("_p_tail", F.concat_ws(" ", F.lit(""), "_city", "_state"))
    numbers = _numbers(F.concat("_p_street", "_p_tail") if n_columns == 1 else F.col("_p_street"))
    has_city = (F.col("_city") != "") & (F.col("_state") != "")
    place = F.when(has_city, _city_region(_place(F.col("_city"), F.col("_state"))))
    regions = F.array(F.when(F.col("_zip") != "", _zip_region(F.col("_zip"))), place)
    keyed = computed_once(keyed, {"_numbers": numbers, "_regions": F.array_compact(regions)})
    return (
        keyed.withColumn("_region", F.explode(F.when(F.col("_numbers").isNotNull(), F.col("_regions"))))
        .groupBy("_region", "_numbers", "_p_street", "_p_tail")
        .agg(F.min(F.struct("point_id", "latitude", "longitude", *ADDRESS_PARTS, *carry)).alias("_point"))
        .withColumn("_whole", F.trim(F.concat("_p_street", "_p_tail")) if n_columns == 1 else F.col("_p_street"))
    )


def score_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Add ``score`` to query-point pairs and keep those that reach ``threshold``.

    The street is compared on its own when the query has one, or when its text ends with the
    point's city and state; otherwise the whole texts are compared. The edit distance stops as
    soon as it is too large to reach the threshold.
    """
    tail_matches = F.endswith("_text", "_p_tail")
    own = (
        F.when(F.col("_street") != "", F.col("_street"))
        .when(tail_matches, F.expr("left(_text, length(_text) - length(_p_tail))"))
        .otherwise(F.col("_text"))
    )
    other = F.when((F.col("_street") != "") | tail_matches, F.col("_p_street")).otherwise(
        F.trim(F.concat("_p_street", "_p_tail"))
    )
    sides = computed_once(pairs, {"_a": own, "_b": other})
    longest = F.greatest(F.length("_a"), F.length("_b"))
    near = sides.withColumn("_budget", budget(longest, threshold)).where(F.abs(F.length("_a") - F.length("_b")) <= F.col("_budget"))
    edits = F.when(F.col("_a") == F.col("_b"), 0).otherwise(F.expr("levenshtein(_a, _b, _budget)"))
    scored = computed_once(near, {"_edits": edits}).where(F.col("_edits") >= 0)
    return scored.withColumn("score", F.lit(1.0) - F.col("_edits") / longest).where(F.col("score") >= threshold)


def _best(scored: DataFrame, names: list[str]) -> DataFrame:
    """The point of the highest score of each address; of equal scores the smallest point id."""
    rank = F.struct(F.col("score"), -F.col("_point.point_id"))
    return scored.groupBy(*names).agg(F.max_by(F.struct("_point", "score"), rank).alias("_best"))


def crowded_best(asked: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """The best point of each address in crowded blocks, without comparing all pairs of a block.

    ``asked`` (its text as ``_asked``) and ``points`` (theirs as ``_whole``) are stored. Equal texts settle an
    address at once, and a score that no more distant pair can reach settles it after a round of
    ``FEW_EDITS``; what is left is searched within the whole budget.
    """
    names = [c for c in asked.columns if c.startswith("_k")]
    equal = asked.join(shuffled(points.withColumnRenamed("_whole", "_asked")), ["_region", "_numbers", "_asked"])
    equal = _best(score_pairs(equal, threshold), names)
    settled = [equal]
    left = stored(asked.join(shuffled(equal.select(*names)), names, "left_anti"), "addresses-left")
    for edits in FEW_EDITS:
        near = _best(score_pairs(pairs_within(left, points, threshold, edits), threshold), [*names, "_asked"])
        near = stored(near.where(nothing_better(F.col("_best.score"), F.col("_asked"), edits)).drop("_asked"), "addresses-near")
        settled.append(near)
        left = stored(left.join(shuffled(near.select(*names)), names, "left_anti"), "addresses-left")
    settled.append(_best(score_pairs(pairs_within(left, points, threshold), threshold), names))
    return reduce(DataFrame.unionByName, settled)


def best_points(asked: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """``_best`` (point and score) of each address of ``query_keys`` that has one among ``_point_keys``.

    Where no block is crowded, every pair of a block is compared in one join. Else the crowded ones go their
    own way. A threshold under ``LEAST_INDEXED`` lets so many edits pass that segments tell nothing.
    """
    names, by = [c for c in asked.columns if c.startswith("_k")], ["_region", "_numbers"]
    crowds = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWDED).select(*by)
    if threshold < LEAST_INDEXED or crowds.isEmpty():
        return _best(score_pairs(asked.join(shuffled(points), by), threshold), names)
    crowds = broadcast_within(crowds)
    asked = stored(asked, "addresses")
    plain = _best(score_pairs(shuffled(asked).join(crowds, by, "left_anti").join(shuffled(points), by), threshold), names)
    text = F.when(F.col("_street") != "", F.col("_street")).otherwise(F.col("_text"))
    crowded = stored(shuffled(asked).join(crowds, by, "left_semi").withColumn("_asked", text), "addresses-crowded")
    return plain.unionByName(crowded_best(crowded, stored(shuffled(points).join(crowds, by, "left_semi"), "points-crowded"), threshold))


def geocode(
    df: DataFrame,
    address_points: DataFrame,
    columns: tuple[str, ...] = ADDRESS_PARTS,
    threshold: float = DEFAULT_THRESHOLD,
    needed: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Add the best matching point's coordinates, address parts, score and precision to every row.

    ``columns`` is (street, city, state, zip) or one whole-address column. Each distinct address,
    as written, is cleaned and looked up once: copies collapse on the map side before anything is
    shuffled and the answers are joined back, so one address shared by very many rows is one row
    of work. A small job finds out whether any block is crowded. Of equal scores the smallest point id wins. Rows where ``needed`` is false get none.
    ``carry`` names further columns of the points that the rows should receive.
    """
    names = [f"_k{i}" for i in range(len(columns))]
    given = [c for c in df.columns if c not in _ANSWER]
    rows = df.select(*given, *[null_to_blank(F.col(c)).alias(k) for c, k in zip(columns, names)])
    # Rows with nothing to look up match nothing; spreading them keeps them out of one partition.
    asks = F.concat(*names) != ""
    if needed is not None:
        asks = asks & F.coalesce(needed, F.lit(False))
    spread = spread_unless(asks, df.select(*given))

    places = gazetteer(address_points) if len(columns) == 1 else None
    asked = query_keys(rows.where(asks).select(*names).distinct(), len(columns), places)
    best = (
        best_points(asked, _point_keys(address_points, len(columns), carry), threshold)
        .select(
            *names,
            no_spread(*names).alias("_spread"),
            F.col("_best._point.latitude").alias("latitude"),
            F.col("_best._point.longitude").alias("longitude"),
            *[F.col(f"_best._point.{c}").alias(f"matched_{c}") for c in ADDRESS_PARTS],
            F.col("_best.score").alias("score"),
            F.when(F.col("_best.score") == 1.0, "exact").otherwise("close").alias("precision"),
            *[F.col(f"_best._point.{c}").alias(c) for c in carry],
        )
    )
    return rows.withColumn("_spread", spread).join(best, [*names, "_spread"], "left").select(*given, *_ANSWER, *carry)


def address_text(columns: tuple[str, ...] = ADDRESS_PARTS) -> Column:
    """The composed address of a row, as it is handed to a geocoder."""
    if len(columns) == 1:
        return compose_single(F.col(columns[0]))
    return compose_multi(*[F.col(c) for c in columns])
