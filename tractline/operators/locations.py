"""The LOCATION table: which rows need coordinates, and rebuilding it from linked rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractline.functions.text import strip
from tractline.functions.values import has_coordinates
from tractline.operators.ranks import ranked_in_order
from tractline.schemas import LOCATION_COLUMNS, require_location


def needs_geocoding(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Row by row: there is no usable coordinate pair yet."""
    return ~has_coordinates(F.col(latitude), F.col(longitude))


def union_vintages(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column missing from one of them is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication; NULLs compare equal."""
    return df.dropDuplicates()


def trim_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def distinct_location(*frames: DataFrame) -> DataFrame:
    """Distinct LOCATION rows of every frame that has all the LOCATION columns.

    Every frame is reduced to distinct rows on the map side before anything is shuffled.
    """
    complete = [f.select(*LOCATION_COLUMNS) for f in frames if set(LOCATION_COLUMNS) <= set(f.columns)]
    if not complete:
        require_location([])
    return distinct_rows(trim_text(union_vintages(*complete)))


def build_location(*frames: DataFrame) -> DataFrame:
    """:func:`distinct_location` by location id. For one table over many deliveries see ``sinks.location_store``."""
    return distinct_location(*frames).orderBy("location_id", *LOCATION_COLUMNS[1:])


def in_row_order(df: DataFrame, row_id: str) -> DataFrame:
    """Restore the caller's row order; the key is the caller's and travels with the row."""
    return df.orderBy(row_id)


def in_visit_order(df: DataFrame) -> DataFrame:
    """By person, then visit start, then visit: a total order for visits."""
    return df.orderBy("person_id", "visit_start_date", "visit_occurrence_id")


def page(df: DataFrame, order: tuple[str, ...], offset: int, rows: int = 100_000) -> DataFrame:
    """One page of ``df`` in a total order: ``rows`` rows after the first ``offset``.

    Rows are counted through by ranges in all tasks, so the rows before a page, however many, are neither
    sorted nor skipped in one task. :func:`tractline.operators.ranks.paged` gives all pages at once.
    """
    ranked = ranked_in_order(df, order, "_rank")
    return ranked.where((F.col("_rank") >= offset) & (F.col("_rank") < offset + rows)).orderBy("_rank").drop("_rank")
