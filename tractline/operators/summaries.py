"""Whole-column reductions and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractline.schemas import VINTAGES


def all_null(df: DataFrame, *names: str) -> DataFrame:
    """One row with a boolean per column: the column holds no value at all."""
    return df.agg(*[(F.count(name) == 0).alias(name) for name in names])


def vintages_present(df: DataFrame, vintage: str = "year_for_fips") -> DataFrame:
    """The supported vintages that occur, one per row."""
    return df.select(vintage).where(F.col(vintage).isin(*VINTAGES)).distinct()


def row_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, ``n_rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def supported_vintages(df: DataFrame, vintage: str = "year_for_fips") -> DataFrame:
    """Rows of the two supported vintages; rows of any other vintage have no tracts to match."""
    return df.where(F.col(vintage).isin(*VINTAGES))
