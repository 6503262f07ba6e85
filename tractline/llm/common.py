"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractline.session import discard, stored

__all__ = ["discard", "ranked", "share", "stored"]


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[str], rank: str, buckets: int = 256) -> DataFrame:
    """``df`` with ``rank``: gapless from 0 within ``groups``, without one task per group.

    Rows are numbered inside ``buckets`` hash buckets of each group, and every bucket starts where
    the bucket before it ends. ``order`` must identify a row and ``df`` must be stored. The bucket
    starts are at most groups x ``buckets`` rows, so groups must be few; they are broadcast.
    """
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (
        bucketed.withColumn("_row", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), same)
        .withColumn(rank, (F.col("_start") + F.col("_row")).cast("bigint"))
        .select(*df.columns, rank)
    )


def share(*columns: str | Column, of: int) -> Column:
    """A whole number below ``of`` that depends on ``columns`` alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(of)).cast("int")
