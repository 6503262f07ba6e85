"""Candidate pairs of alike addresses inside crowded blocks, found by equal segments.

Two texts within ``e`` edits keep at least one of any ``e + 1`` disjoint segments of one of them, moved by
no more than the edits before it. So every point of a block is filed under the segments of its text, and an
address probes the places where each segment may have moved to. Budgets rise: equal texts first, then few
edits with long and telling segments, and only addresses that are still in doubt get the threshold's budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.session import shuffled

#: Blocks of more points than this are searched by segments; below, each pair is compared.
CROWDED = 256
#: The edits of the rounds between equal texts and the threshold's whole budget.
FEW_EDITS = (1, 2)
#: A text's last segment is this much longer, where it can be: it holds the kind of street and tells little.
_ENDING = 4


def budget(length: Column, threshold: float) -> Column:
    """The most edits that texts, of which the longer has ``length``, may be apart."""
    return F.floor(length * F.lit(1.0 - threshold) + F.lit(1e-9)).cast("int")


def _most(length: Column, threshold: float) -> Column:
    """The same for the longest text that can still be near one of ``length``."""
    return budget(F.ceil(length / F.lit(threshold)) + 1, threshold)


def _begin(length: Column, edits: Column, i: Column) -> Column:
    """Where segment ``i`` of ``edits`` + 1 begins, from 0; the segment after the last begins at the end."""
    even = F.when(length >= edits + 1 + _ENDING, length - _ENDING).otherwise(length)
    return F.when(i > edits, length).otherwise(F.floor(even * i / (edits + 1))).cast("int")


def _key(edits: Column, length: Column, i: Column, segment: Column) -> Column:
    return F.concat_ws(":", edits, length, i, segment)


def _rest(text: Column) -> Column:
    """A text without its house number, which is the same all over a block."""
    return F.regexp_replace(text, r"^\d+", "")


def _filed(points: DataFrame, threshold: float, edits: int | None) -> DataFrame:
    """Points (``_whole``) under the segments of every budget an address of any length may ask with."""
    full = F.length("_whole")
    budgets = F.array(F.lit(edits)) if edits is not None else F.sequence(budget(full, threshold), _most(full, threshold))
    filed = points.withColumns({"_rest": _rest(F.col("_whole")), "_edits": F.explode(budgets)})
    filed = filed.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_edits"))))
    length, begin = F.length("_rest"), lambda i: _begin(F.length("_rest"), F.col("_edits"), i)
    segment = F.substring(F.col("_rest"), begin(F.col("_i")) + 1, begin(F.col("_i") + 1) - begin(F.col("_i")))
    key = _key(F.col("_edits"), length, F.col("_i"), segment)
    return filed.withColumn("_segment", key).drop("_rest", "_edits", "_i", "_whole")


def _probes(asked: DataFrame, threshold: float, edits: int | None) -> DataFrame:
    """Addresses (``_asked``) with every segment they may hold of a point in reach."""
    full, columns = F.length("_asked"), asked.columns
    probes = asked.withColumn("_rest", _rest(F.col("_asked"))).withColumn("_n", F.length("_rest"))
    reach = (F.lit(edits), F.lit(edits)) if edits is not None else (budget(full, threshold), _most(full, threshold))
    lengths = F.sequence(F.greatest(F.col("_n") - reach[0], F.lit(0)), F.col("_n") + reach[1])
    probes = probes.withColumn("_length", F.explode(lengths))
    longer = full + F.greatest(F.col("_length") - F.col("_n"), F.lit(0))
    probes = probes.withColumn("_edits", F.lit(edits) if edits is not None else budget(longer, threshold))
    apart = F.col("_n") - F.col("_length")
    probes = probes.where(F.abs(apart) <= F.col("_edits"))
    probes = probes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_edits"))))
    # Edits before the segment move it, those after it make up the rest of the difference in length.
    probes = probes.withColumn("_moved", F.explode(F.sequence(-F.col("_edits"), F.col("_edits"))))
    probes = probes.where(F.abs("_moved") + F.abs(apart - F.col("_moved")) <= F.col("_edits"))
    begin = lambda i: _begin(F.col("_length"), F.col("_edits"), i)
    at, size = begin(F.col("_i")) + F.col("_moved"), begin(F.col("_i") + 1) - begin(F.col("_i"))
    probes = probes.withColumns({"_at": at, "_size": size}).where((F.col("_at") >= 0) & (F.col("_at") + F.col("_size") <= F.col("_n")))
    segment = F.substring(F.col("_rest"), F.col("_at") + 1, F.col("_size"))
    return probes.select(*columns, _key(F.col("_edits"), F.col("_length"), F.col("_i"), segment).alias("_segment"))


def pairs_within(asked: DataFrame, points: DataFrame, threshold: float, edits: int | None = None) -> DataFrame:
    """Every pair of one block within ``edits`` edits, or within the threshold's budget, and some more; each once.

    Both sides have ``_region``, ``_numbers``; addresses their text as ``_asked`` and points theirs as ``_whole``.
    """
    by = ["_region", "_numbers", "_segment"]
    found = _probes(asked, threshold, edits).join(shuffled(_filed(points, threshold, edits)), by)
    mine = [c for c in asked.columns if c.startswith("_k")]
    return found.drop("_segment").dropDuplicates([*mine, "_p_street", "_p_tail"])


def nothing_better(score: Column, asked: Column, edits: int) -> Column:
    """Whether no pair of more than ``edits`` edits can reach ``score``: at best it has one more, in a text as long as can be."""
    return score > 1.0 - F.lit(edits + 1) / (F.length(asked) + edits + 1)
