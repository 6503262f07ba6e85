"""Exact positions in a total order, worked out by all tasks together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractline.session import broadcast_within, stored

#: Bits of a generated id below its partition's number.
_IN_PARTITION = 33


def ranked_in_order(
    df: DataFrame, order: Sequence[str], rank: str, groups: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """``df`` with ``rank``: the row's place from 0 in ``order`` within its ``groups``, gapless.

    Rows are dealt to ranges of (groups, order) and sorted there, so a group lies in neighbouring partitions
    and in one run of each. One pass counts the runs, a running sum over the partitions says where each run
    starts, and a row's place follows from its place in the run: nothing is shuffled again and no group meets
    in one task. ``order`` should tell all rows apart that a caller tells apart; NULLs come first.
    """
    by = [*groups, *order]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *by).sortWithinPartitions(*by)
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    names = [f"_g{i}" for i in range(len(groups))]
    part = F.shiftright("_at", _IN_PARTITION).alias("_part")
    runs = ranged.groupBy(*[F.col(g).alias(n) for g, n in zip(groups, names)], part).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from")
    )
    before = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as groups lie in a partition, over all partitions.
    starts = runs.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = F.shiftright(F.col("_at"), _IN_PARTITION) == F.col("_part")
    for group, name in zip(groups, names):
        same = same & F.col(group).eqNullSafe(F.col(name))
    placed = ranged.join(broadcast_within(starts), same)
    return placed.select(*df.columns, (F.col("_start") + F.col("_at") - F.col("_from")).alias(rank))


def paged(
    df: DataFrame, order: Sequence[str], rows: int, groups: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """``df`` with ``page``, from 0 within its ``groups``: every page but a group's last has exactly ``rows`` rows."""
    if rows < 1:
        raise ValueError("a page needs at least one row")
    ranked = ranked_in_order(df, order, "_rank", groups, partitions)
    return ranked.withColumn("page", F.floor(F.col("_rank") / rows).cast("bigint")).drop("_rank")
